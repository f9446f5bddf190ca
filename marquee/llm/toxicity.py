"""Toxicity scores of restored text.

Character trigrams are counted over all documents and make the language model that restores disguised words
(see ``deobfuscate``). On the restored text of a bounded sample of labelled documents, a grouped aggregation
counts in how many toxic and clean documents each word and word beginning occurs; those that are significantly
more frequent in toxic ones get their log odds as weight. Copies of a text are learned from once. A document's evidence is the sum of its strongest
distinct words, and a logistic curve fitted on the sample turns it into a score.

Labels are used for learning alone, and only of rows outside the held-out fold: every fifth by
``crc32(doc_id) mod 5``. A score depends on the text and on nothing else of its row.

Defined cases: a null text counts as empty, and a text without evidence gets the curve's lowest score; labels
without id or value are not used, and of several labels of a document the largest counts; repeated documents are
scored each. With no labels of one of the two kinds all scores are 0. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import in_parts, ready, whole_text
from marquee.llm.deobfuscate import (
    SYMBOLS, joined_pieces, log_probabilities, readings, restore, restore_spaced, spaced_words, tokens_of, trigram_counts,
)
from marquee.session import materialise

FOLDS = 5
#: Longer tokens are read again each time: they hardly come twice, and a table of them has no bound.
LONGEST_KEPT = 64


@dataclass(frozen=True)
class ToxicPolicy:
    """``sample_rows`` bounds the labelled rows to learn from, and so the table sent to every task. ``strongest`` words
    count for a text, or all without it."""

    sample_rows: int = 20_000
    beginnings: tuple[int, ...] = (4, 5, 6)
    least_documents: int = 4
    least_odds: float = 1.2  # of the log odds, two standard errors down
    strongest: int | None = 5
    cache: int = 300_000


def held_out(doc_id: Column) -> Column:
    """Is the row in the fold that nothing is learned from? A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def language_model(docs: DataFrame) -> np.ndarray:
    """Trigram log probabilities over all texts; each task sends its own counts, a fixed table."""
    ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for text in in_parts(batch.column(0)):
                total += trigram_counts(text)
        keys = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(total[keys])], ["gram", "n"])

    counted = docs.select(whole_text().alias("text")).mapInArrow(count, "gram int, n long")
    counts = np.zeros(SYMBOLS**3, dtype=np.int64)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    return log_probabilities(counts)


def restored_words(tokens: set[str], listed: list[str], model: np.ndarray) -> Iterator[tuple[str, list[str]]]:
    """(token, its words) for the distinct tokens of a text, and for what is written letter by letter in it."""
    for token in tokens:
        yield token, readings(token, model)
    for run in spaced_words(listed):
        yield run, list(dict.fromkeys([restore(run, model), *restore_spaced(run, model)]))


def features(words: list[str], policy: ToxicPolicy) -> list[str]:
    """The words, and their beginnings marked with a hyphen."""
    return [f for word in words for f in (word, *(word[:n] + "-" for n in policy.beginnings if len(word) > n))]


def _labelled(labels: DataFrame, policy: ToxicPolicy) -> DataFrame:
    """A bounded sample of (doc_id, toxic) outside the held-out fold, by the order of a hash."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(policy.sample_rows)


def learn_weights(texts: DataFrame, model, policy: ToxicPolicy) -> dict[str, float]:
    """Log odds, less a standard error, of features (text, toxic) significantly more frequent in toxic texts."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def found(batch: pa.Array) -> pa.Array:
        rows, known, long_ones = [], {}, set()
        for text in in_parts(batch):
            listed = tokens_of(text)
            own = set()
            tokens = set(listed)
            for token, words in restored_words(tokens.difference(known), listed, model.value):
                found_here = features(words, policy)
                own.update(found_here)
                if token in tokens:
                    known[token] = found_here
            long_ones.update(token for token in tokens if len(token) > LONGEST_KEPT)
            for token in tokens:
                own.update(known.get(token, ()))
            rows.append(list(own))
            while long_ones:
                known.pop(long_ones.pop(), None)
        return pa.array(rows, pa.list_(pa.string()))

    totals = texts.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all")).first()
    bad, good = totals["bad"] or 0, (totals["all"] or 0) - (totals["bad"] or 0)
    if not bad or not good:
        return {}
    # The outer kind: for the other, Spark would look for features twice, first to leave out texts that have none.
    listed = texts.select("toxic", F.explode_outer(found("text")).alias("feature")).where("feature is not null")
    counted = listed.groupBy("feature").agg(
        F.sum("toxic").alias("x"), F.count(F.lit(1)).alias("n")
    ).where(F.col("x") >= policy.least_documents)
    clean = F.col("n") - F.col("x")
    odds = F.log((F.col("x") + 0.5) / F.lit(bad + 1.0)) - F.log((clean + 0.5) / F.lit(good + 1.0))
    error = F.sqrt(1 / (F.col("x") + 0.5) + 1 / (clean + 0.5))
    rows = counted.select("feature", (odds - error).alias("weight"), (odds - 2 * error).alias("sure")).where(F.col("sure") >= policy.least_odds)
    # As many as the bounded sample has words in ``least_documents`` of its texts, and most of those are in clean ones too.
    return {row["feature"]: row["weight"] for row in rows.collect()}


def _evidence_udf(model, weights, policy: ToxicPolicy):
    @F.arrow_udf(T.DoubleType())
    def evidence(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table, grams, known = weights.value, model.value, {}
        whole = frozenset(word for word in table if not word.endswith("-") and len(word) > 2)
        beginnings = frozenset(word[:n] for word in whole for n in range(1, len(word)))

        def strongest(words: list[str]) -> tuple[float, str] | None:
            own = [(table[f], word) for word in words for f in features([word], policy) if f in table]
            return max(own, default=None)

        for batch in texts:
            sums = []
            for text in in_parts(batch):
                listed = tokens_of(text)
                tokens = set(listed)
                spaced = [strongest([word]) for word in joined_pieces(listed, whole, beginnings, grams)]
                for token, words in restored_words(tokens.difference(known), listed, grams):
                    if token in tokens:
                        known[token] = strongest(words)
                    else:
                        spaced += [strongest([word]) for word in words]
                hits = dict(
                    (word, weight) for weight, word in
                    filter(None, [*map(known.get, tokens), *spaced])
                )
                for token in tokens:
                    if len(token) > LONGEST_KEPT:
                        known.pop(token, None)
                sums.append(sum(sorted(hits.values(), reverse=True)[: policy.strongest], 0.0))
                if len(known) > policy.cache:
                    known = {}
            yield pa.array(sums, pa.float64())

    return evidence


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps with a little ridge."""
    x = np.column_stack([evidence, np.ones_like(evidence)])
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (toxic - p) - 1e-2 * beta
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, policy: ToxicPolicy = ToxicPolicy()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the evidence behind the score."""
    context = docs.sparkSession.sparkContext
    model = context.broadcast(language_model(docs))
    rows = docs.select("doc_id", whole_text().alias("text"))
    # The sample is bounded by ``sample_rows``, so the texts are filtered where they lie.
    sample = _labelled(labels, policy)
    labelled = rows.join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    labelled = materialise(labelled, "labelled")
    weights = context.broadcast(learn_weights(labelled, model, policy))
    evidence = _evidence_udf(model, weights, policy)
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), evidence("text").alias("evidence"))
    score = F.lit(0.0)
    if weights.value:
        known = labelled.select(evidence("text").alias("x"), F.col("toxic").cast("double").alias("y"))
        # Equal evidence is summed up before it comes to the driver.
        table = known.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).toPandas()
        slope, offset = fit_curve(
            np.repeat(table["x"].to_numpy(), table["n"]), np.repeat(table["y"].to_numpy(), table["n"])
        )
        score = 1 / (1 + F.exp(-(F.lit(max(0.0, slope)) * F.col("evidence") + F.lit(offset))))
    scored = scored.withColumn("score", score)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"
    )
