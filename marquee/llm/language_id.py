"""Language identification by Bayesian fusion of evidence.

The text speaks through character trigrams: per language a distribution over hashed trigrams, learned from a
bounded sample of labelled rows that is spread over all labelled languages, against a blend of the product of single-character frequencies and of all
trigrams alike, which stands for text in none of the languages ("und"). What the text alone says about all rows is then summed up by grouped aggregation
into three kinds of further evidence: how often each declared markup language and each address suffix goes with a
language, and how languages are spread over a host, smoothed towards its domain, which is smoothed towards the
whole table. A row's own share is left out of its host's counts. The posterior adds all logarithms up.

A row is accepted if a language, not "und", has the largest posterior and at least ``least_probability``.

Defined cases: evidence that is null (declaration, address, host) says nothing; a null or empty text, or one
without letters, is "und" and not accepted; ties go to the first language in order of names; repeated rows are
judged each. Further columns are not read. Without any labelled row everything is "und". An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import SkewPolicy
from marquee.llm.common import ROW, addressable, in_parts, ready, whole_text, with_row_key
from marquee.operators.skew import join_counted
from marquee.session import materialise

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguagePolicy:
    """``sample_rows`` bounds the labelled rows learned from (in expectation, and but for the first row of each
    language, which is always in), ``buckets`` the trigram table of a language."""

    sample_rows: int = 20_000
    buckets: int = 1 << 15
    tempering: float = 1 / 3  # neighbouring trigrams share letters
    smoothing: float = 0.05
    unknown_prior: float = 0.01
    host_weight: float = 20.0
    link_weight: float = 5.0
    least_probability: float = 0.5


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, runs of anything else as one 0, with a 0 at either end."""
    lowered = text.lower()
    codes = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    plain = ((codes >= 97) & (codes <= 122)) | (codes >= 0xC0)
    codes[~plain | (codes == 0xD7) | (codes == 0xF7) | ((codes >= 0x2000) & (codes <= 0x2BFF))] = 0
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint32)
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def trigram_buckets(codes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around each letter, and the hashed characters they are made of (three per trigram)."""
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 3), dtype=np.int64)
    a, b, c = (codes[i: len(codes) - 2 + i].astype(np.uint64) for i in range(3))
    keys = (a * np.uint64(0x9E3779B1) + b) * np.uint64(0x85EBCA77) + c * np.uint64(0xC2B2AE3D)
    keys ^= keys >> np.uint64(17)
    middle = b != 0
    singles = np.column_stack([a, b, c])[middle] % np.uint64(buckets)
    return (keys[middle] % np.uint64(buckets)).astype(np.int64), singles.astype(np.int64)


@dataclass
class TextModel:
    """Log probabilities of hashed trigrams per language, and of hashed single characters."""

    languages: list[str]
    trigrams: np.ndarray
    singles: np.ndarray

    def log_likelihoods(self, text: str) -> list[float] | None:
        grams, singles = trigram_buckets(letters_of(text), self.trigrams.shape[1])
        if not len(grams):
            return None
        apart = np.logaddexp(self.singles[singles].sum(axis=1), -np.log(len(self.singles))) - np.log(2)
        return [*(table[grams].sum() for table in self.trigrams), apart.sum()]


HASHES = 1 << 30
#: What is left of a sum of shares once its only row is taken away, and more than rounding leaves.
NO_ONE = 1e-12

#: Trigram tables that a task holds at a time: of more languages, it hands on what it has counted.
TABLES_AT_ONCE = 64


def spread(rows: dict[str, int], most: int) -> dict[str, int]:
    """Rows to take of each language: small ones whole, and of what is left the same for each, one at least."""
    taken, left = {}, most
    for i, (lang, n) in enumerate(sorted(rows.items(), key=lambda entry: (entry[1], entry[0]))):
        taken[lang] = min(n, max(1, left // (len(rows) - i)))
        left -= taken[lang]
    return taken


def sample_languages(labelled: DataFrame, policy: LanguagePolicy) -> tuple[list[str], DataFrame]:
    """All languages in order, and the sampled rows (text, lang): the first of each by a hash of the text."""
    place = F.pmod(F.xxhash64("text"), F.lit(HASHES))
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).collect()
    taken = spread({row["lang"]: row["n"] for row in counted}, policy.sample_rows)
    limits = [
        (row["lang"], max(row["first"] + 1, int(taken[row["lang"]] / row["n"] * HASHES))) for row in counted
    ]
    # Built from literals: a table of Python rows would start workers of another kind beside those that read texts.
    listed = F.array(*(F.struct(F.lit(lang).alias("lang"), F.lit(n).cast("long").alias("places")) for lang, n in limits))
    known = labelled.sparkSession.range(1 if limits else 0).select(F.inline(listed if limits else F.expr("array(struct('' as lang, 0L as places))")))
    return sorted(taken), labelled.join(F.broadcast(known), "lang").where(place < F.col("places")).select("text", "lang")


def learn_text_model(labelled: DataFrame, policy: LanguagePolicy) -> TextModel:
    """From (text, lang): counts per task, summed up per language and bucket; a fixed number of rows a language come back."""
    ready(labelled.sparkSession)
    languages, sample = sample_languages(labelled, policy)
    numbers = {lang: i for i, lang in enumerate(languages)}

    def counts_of(tables: dict[int, np.ndarray]) -> pa.RecordBatch:
        found = [(kind, np.flatnonzero(table)) for kind, table in tables.items()]
        kinds = [np.full(len(own), kind) for kind, own in found]
        columns = [(kinds, pa.int32()), ([own for _, own in found], pa.int32()), ([tables[kind][own] for kind, own in found], pa.int64())]
        none = np.zeros(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *c]), t) for c, t in columns], ["kind", "bucket", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[int, np.ndarray] = {}
        singles = np.zeros(policy.buckets, dtype=np.int64)
        for batch in batches:
            for text, lang in zip(in_parts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found, characters = trigram_buckets(letters_of(text), policy.buckets)
                kind = numbers[lang]
                if kind not in grams:
                    if len(grams) == TABLES_AT_ONCE:
                        yield counts_of(grams)
                        grams = {}
                    grams[kind] = np.zeros(policy.buckets, dtype=np.int64)
                grams[kind] += np.bincount(found, minlength=policy.buckets)
                singles += np.bincount(characters[:, 1], minlength=policy.buckets)
        yield counts_of({**grams, len(numbers): singles})

    counts = sample.mapInArrow(count, "kind int, bucket int, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.toPandas().sort_values("kind")
    kinds, buckets, n = (rows[c].to_numpy() for c in ("kind", "bucket", "n"))
    bounds = np.searchsorted(kinds, np.arange(len(languages) + 2))
    logs = np.empty((len(languages) + 1, policy.buckets), dtype=np.float32)
    for kind, (begin, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
        table = np.full(policy.buckets, policy.smoothing)
        table[buckets[begin:end]] += n[begin:end]
        logs[kind] = np.log(table / table.sum())
    return TextModel(languages, logs[:-1], logs[-1])


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, also where it is used for every entry of an array."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _total(logs: Column) -> Column:
    return F.aggregate(logs, F.lit(0.0), lambda s, y: s + y)


def _softmax(logs: Column) -> Column:
    def shares(raised: Column) -> Column:
        return _let(_total(raised), lambda total: F.transform(raised, lambda x: x / total))

    def above(own: Column) -> Column:
        return _let(F.array_max(own), lambda top: _let(F.transform(own, lambda x: F.exp(x - top)), shares))

    return _let(logs, above)


def _shares(rows: DataFrame, key: str, width: int, name: str) -> DataFrame:
    """Summed text posteriors per value of ``key``: partial sums, so a hot host is a row per task."""
    sums = [F.sum(F.get("posterior", F.lit(i))).alias(f"s{i}") for i in range(width)]
    found = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*sums)
    return found.select(key, F.array(*(f"s{i}" for i in range(width))).alias(name))


def fuse(rows: DataFrame, model: TextModel, policy: LanguagePolicy = LanguagePolicy()) -> DataFrame:
    """Language, probability and acceptance of rows (any ids, text, declared, suffix, domain, host)."""
    spark = rows.sparkSession
    ready(spark)
    sent = spark.sparkContext.broadcast(model)
    names = [*model.languages, UNKNOWN]
    width = len(names)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def likelihoods(texts: pa.Array) -> pa.Array:
        return pa.array([sent.value.log_likelihoods(text) for text in in_parts(texts)], pa.list_(pa.float64()))

    ids = [c for c in rows.columns if c not in ("text", "declared", "suffix", "domain", "host")]
    logs = F.transform(likelihoods(whole_text()), lambda x: x * policy.tempering)
    read = materialise(
        rows.select(*ids, F.lower("declared").alias("declared"), F.lower("suffix").alias("suffix"),
                    F.lower("domain").alias("domain"), F.lower("host").alias("host"), logs.alias("text_logs")),
        "text_evidence",
    )
    start = np.log([*[(1 - policy.unknown_prior) / max(1, width - 1)] * (width - 1), policy.unknown_prior])
    first = F.transform("text_logs", lambda x, i: x + F.get(F.array(*map(F.lit, start.tolist())), i))
    read = read.withColumn("posterior", _softmax(first))
    whole = read.agg(*(F.sum(F.get("posterior", F.lit(i))) for i in range(width))).first()
    whole = np.array([x or 0.0 for x in whole]) + 1e-6
    overall = F.array(*map(F.lit, (whole / whole.sum()).tolist()))
    totals = F.array(*map(F.lit, whole.tolist()))

    joined = read
    for key in ("declared", "suffix", "domain", "host"):
        table = materialise(_shares(read, key, width, f"{key}_sums"), f"{key}_sums")
        joined = join_counted(joined, table, key, "left", table.count(), SkewPolicy())

    def smoothed(sums: str, below: Column) -> Column:
        """Shares of the counts without the row itself, drawn towards the level below."""
        own, k = F.col("posterior"), F.lit(policy.host_weight)
        rest = F.greatest(_total(F.col(sums)) - 1, F.lit(0.0))
        share = _let(rest, lambda others: F.transform(
            below, lambda x, i: (F.greatest(F.get(sums, i) - F.get(own, i), F.lit(0.0)) + k * x) / (others + k)
        ))
        return F.when(F.col(sums).isNull() | own.isNull(), below).otherwise(share)

    def link(sums: str) -> Column:
        """log P(value | language) for a value that goes with languages as ``sums``, the row itself left out.

        0 where there is no value, or no other row with it.
        """
        a, own = F.lit(policy.link_weight), F.col("posterior")
        others = F.transform(sums, lambda x, i: F.greatest(x - F.coalesce(F.get(own, i), F.lit(0.0)), F.lit(0.0)))
        likely = _let(others, lambda left: _let(a * _total(left) / F.lit(float(whole.sum())), lambda little: F.transform(
            left, lambda x, i: F.when(little > NO_ONE, F.log((x + little) / (F.get(totals, i) + a))).otherwise(F.lit(0.0))
        )))
        return F.coalesce(likely, F.array_repeat(F.lit(0.0), width))

    joined = joined.withColumn("host_prior", smoothed("host_sums", smoothed("domain_sums", overall)))
    joined = joined.withColumn("declared_logs", link("declared_sums")).withColumn("suffix_logs", link("suffix_sums"))
    evidence = F.struct("host_prior", "declared_logs", "suffix_logs")
    posterior = _softmax(_let(evidence, lambda known: F.transform(
        "text_logs",
        lambda x, i: x + F.log(F.get(known["host_prior"], i)) + F.get(known["declared_logs"], i) + F.get(known["suffix_logs"], i),
    )))
    judged = joined.withColumn("fused", posterior)
    best = F.array_max("fused")
    place = F.array_position("fused", best).cast("int")
    judged = judged.withColumn("lang", F.coalesce(F.element_at(F.array(*map(F.lit, names)), place), F.lit(UNKNOWN)))
    judged = judged.withColumn("probability", F.coalesce(best, F.lit(0.0)))
    kept = (F.col("lang") != UNKNOWN) & (F.col("probability") >= policy.least_probability)
    return judged.select(*ids, "lang", "probability", kept.alias("kept"))


def _key_of(rows: DataFrame) -> list[str]:
    return [ROW] if ROW in rows.columns else []


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows to judge: a source is a host, and nothing is declared. Their labels are not read."""
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id", *_key_of(docs), whole_text().alias("text"), none.alias("declared"), none.alias("suffix"), none.alias("domain"),
        F.col("source").alias("host"),
    )


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as rows to judge: visible text, ``lang`` of the root element, and the parts of the address."""
    html = F.coalesce("html", F.lit(""))
    hidden = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    declared = F.regexp_extract(html, r"""(?i)<html[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1)
    given = lambda c: F.when(c != "", c)
    return pages.select(
        "page_id", *_key_of(pages), F.regexp_replace(html, hidden, " ").alias("text"), given(declared).alias("declared"),
        given(F.regexp_extract(host, r"\.([a-z]{2,})$", 1)).alias("suffix"),
        given(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"), given(host).alias("host"),
    )


def labelled_documents(docs: DataFrame) -> DataFrame:
    """(text, lang) of documents outside the held-out fold, every fifth by ``crc32(doc_id) mod 5``."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    known = docs.where(F.col("lang").isNotNull() & (F.col("lang") != "") & (fold != 0))
    return known.select(whole_text().alias("text"), "lang")


def identify(docs: DataFrame | None, pages: DataFrame | None, model: TextModel, policy: LanguagePolicy = LanguagePolicy()) -> DataFrame:
    """Language, probability and acceptance of documents and pages, judged together: (doc_id, page_id, row key, ..)."""
    none = F.lit(None).cast("long")
    parts = []
    if docs is not None:
        parts.append(of_documents(with_row_key(addressable(docs.select("doc_id", "text", "source")))).withColumn("page_id", none))
    if pages is not None:
        parts.append(of_pages(with_row_key(addressable(pages.select("page_id", "url", "html")))).withColumn("doc_id", none))
    return fuse(reduce(DataFrame.unionByName, parts), model, policy)
