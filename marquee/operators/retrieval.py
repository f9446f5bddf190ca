"""Vector scoring: history vectors, top-k, rank counting and in-batch loss.

Scoring every query against every candidate is a product of two tables, and no row pair of it ever becomes
a Spark row: tasks multiply matrices and hand on a top-k or a count per query.

* Queries are stored in the shared folder and read there by the tasks, in batches of at most ``lookup_bytes``.
  Candidates are scored where they lie in one pass, so neither side is shuffled, copied or sent to the driver, and
  each task answers once per query.
* ``operators.pruned_index`` keeps candidates in an order that spares most of them the scoring.

Scores are rounded to ``DECIMALS`` places before they are compared, so results do not depend on the
order of additions; ties go to the smaller candidate id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import pyarrow.dataset
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import dot, unpad
from marquee.operators.batches import regroup
from marquee.operators.lookup import LOOKUP_BYTES, broadcast_small, check_unique
from marquee.operators.stored import full_batches, stored_batches
from marquee.session import store

DECIMALS = 6
BLOCK_ROWS = 50_000
CHUNK_SCORES = 5_000_000
#: Answers held in a task before they are handed on.
ANSWER_ROWS = 2_000_000


def lookup_vectors(
    df: DataFrame, vectors: DataFrame, into: str = "query", width: int | None = None
) -> DataFrame:
    """Add the item vector of each row's ``movie_id``.

    Rows of movies without one drop out, or get a vector of ``width`` zeros when that is given.
    """
    named = vectors.select("movie_id", F.col("vector").alias(into))
    if width is None:
        return df.join(named, "movie_id")
    zeros = F.array_repeat(F.lit(0.0).cast(named.schema[into].dataType.elementType), width)
    return df.join(named, "movie_id", "left").withColumn(into, F.coalesce(into, zeros))


def history_vectors(
    df: DataFrame,
    vectors: DataFrame,
    row_key: Sequence[str],
    width: int,
    carry: Sequence[str] = (),
    recency: float = 1.0,
    pad_side: str = "post",
    lookup_bytes: int = LOOKUP_BYTES,
    with_query: bool = False,
) -> DataFrame:
    """(row key, carry, vector): the mean of the item vectors in each row's history, pads left out.

    ``with_query`` adds the vector of a carried ``movie_id`` as ``query``, zeros where it has none. A small table of item
    vectors gives it in the same pass.

    With ``recency`` below 1 an entry counts ``recency`` times as much as the one after it. Ids without a
    vector count for nothing, and a history without any known id gives zeros.

    ``vectors`` has one row per movie; repeated row keys stay apart.
    Item vectors of at most ``lookup_bytes`` go to every task, and rows are encoded where they are, without
    a shuffle. Larger tables are joined to the exploded histories.
    """
    items = broadcast_small(vectors, "movie_id", "vector", 8 * width, lookup_bytes)
    if items is None:
        joined = _joined_history_vectors(df, vectors, row_key, width, carry, recency, pad_side)
        return lookup_vectors(joined, vectors, width=width) if with_query else joined
    kind = vectors.schema["vector"].dataType
    exact = np.float32 if kind.elementType == T.FloatType() else np.float64

    def encode(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = items.value
        for rows in chunks:
            if rows.empty:
                continue
            ids = np.stack(rows["previous_movie_ids"].to_numpy()).astype(np.int64)
            n, length = rows["history_len"].to_numpy()[:, None], ids.shape[1]
            at = np.arange(length)[None, :] - (length - n if pad_side == "pre" else 0)
            place, known = table.find(ids)
            weights = np.where(known & (at >= 0) & (at < n), recency ** np.maximum(n - 1.0 - at, 0), 0.0)
            means = np.zeros((len(rows), width))
            if known.any():
                sums = np.einsum("rl,rld->rd", weights, table.values[place])
                total = weights.sum(axis=1, keepdims=True)
                np.divide(sums, total, out=means, where=total > 0)
            found = rows[[*row_key, *carry]].assign(vector=list(means))
            if with_query:
                place, known = table.find(rows["movie_id"].to_numpy())
                queries = np.zeros((len(rows), width), dtype=exact)
                if known.any():
                    queries[known] = table.values[place[known]]
                found = found.assign(query=list(queries))
            yield found

    kept = T.StructType([df.schema[name] for name in (*row_key, *carry)])
    schema = T.StructType([*kept.fields, T.StructField("vector", T.ArrayType(T.DoubleType()))])
    schema = schema.add("query", kind) if with_query else schema
    return df.select(*row_key, *carry, "previous_movie_ids", "history_len").mapInPandas(encode, schema)


def _joined_history_vectors(
    df: DataFrame, vectors: DataFrame, row_key, width: int, carry, recency: float, pad_side: str
) -> DataFrame:
    ids = unpad(F.col("previous_movie_ids"), F.col("history_len"), pad_side)
    # Rows get a key of their own, as row keys may repeat.
    row = F.monotonically_increasing_id().alias("_row")
    placed = df.select(row, *row_key, *carry, F.col("history_len").alias("_n"), ids.alias("_ids"))
    entries = placed.select("_row", *row_key, *carry, "_n", F.posexplode_outer("_ids").alias("_at", "_id"))
    named = check_unique(vectors, "movie_id").select(F.col("movie_id").alias("_id"), "vector")
    known = entries.withColumn("_id", F.col("_id").cast("long")).join(named, "_id", "left")
    weight = F.pow(F.lit(float(recency)), F.col("_n") - 1 - F.col("_at"))
    term = F.when(F.col("vector").isNotNull(), F.struct("_at", weight.alias("w"), "vector"))
    grouped = known.groupBy("_row", *row_key, *carry).agg(F.sort_array(F.collect_list(term)).alias("_terms"))
    kept = [grouped.schema[name] for name in (*row_key, *carry)]
    schema = T.StructType([*kept, T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A row has up to a history of vectors, so few rows are unpacked at a time.
            for start in range(0, batch.num_rows, ROWS_OF_TERMS):
                part = batch.slice(start, ROWS_OF_TERMS)
                means = _means(part.column(part.num_columns - 1), width)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], means], schema.names)

    return grouped.select(*row_key, *carry, "_terms").mapInArrow(average, schema)


#: Rows whose vectors are averaged together.
ROWS_OF_TERMS = 2_000


def _means(terms: pa.ListArray, width: int) -> pa.ListArray:
    """The weighted mean of each row's terms (_at, w, vector), added up in their order; zeros where there is none."""
    counts = pa.compute.list_value_length(terms).to_numpy()
    flat = terms.flatten()
    means = np.zeros((len(terms), width))
    if len(flat):
        weights = flat.field("w").to_numpy()
        values = flat.field("vector").flatten().to_numpy().reshape(-1, width) * weights[:, None]
        some, firsts = counts > 0, np.cumsum(counts) - counts
        totals = np.add.reduceat(weights, firsts[some])
        means[some] = np.add.reduceat(values, firsts[some], axis=0) / totals[:, None]
    ends = np.arange(0, (len(terms) + 1) * width, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(means.ravel()))


def score(query: str = "query", candidate: str = "vector") -> Column:
    return F.round(dot(F.col(query), F.col(candidate)), DECIMALS)


def top_k(
    queries: DataFrame,
    index: DataFrame,
    k: int,
    block_rows: int = BLOCK_ROWS,
    lookup_bytes: int = LOOKUP_BYTES,
) -> DataFrame:
    """(movie_id, rank, user_id, score): the best ``k`` index rows for each query (movie_id, query).

    Queries have one row per movie. An index row is (user_id, vector); a user may have several, and each
    competes by itself.
    """

    def keep_best(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["movie_id", "score", "user_id"], ascending=[True, False, True])
        return found.groupby("movie_id", sort=False).head(k)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids, movies, parts = right["user_id"].to_numpy(), left["movie_id"].to_numpy(), []
        for at, scores in _score_chunks(left["query"], right["vector"]):
            worst = scores.shape[1] - min(k, scores.shape[1])
            bar = np.partition(scores, worst, axis=1)[:, worst]
            row, col = np.nonzero(scores >= bar[:, None])
            found = {"movie_id": movies[at + row], "user_id": ids[col], "score": scores[row, col]}
            parts.append(keep_best(pd.DataFrame(found)))
        return pd.concat(parts, ignore_index=True)

    def merge(so_far: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        return keep_best(pd.concat([so_far, more], ignore_index=True))

    local = _against(
        queries.select("movie_id", "query"), index.select("user_id", "vector"), best, merge,
        "movie_id long, user_id long, score double", block_rows, lookup_bytes,
    )
    order = Window.partitionBy("movie_id").orderBy(F.desc("score"), "user_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("movie_id", F.col("rank").cast("long").alias("rank"), "user_id", "score")


def true_pair_ranks(
    queries: DataFrame,
    candidates: DataFrame,
    key: Sequence[str],
    block_rows: int = BLOCK_ROWS,
    lookup_bytes: int = LOOKUP_BYTES,
) -> DataFrame:
    """(key, rank): 1 + the candidates that score higher with the row's query than its own history does.

    ``queries`` are (key, movie_id, query, score) and ``candidates`` (vector). A row's own vector is among the
    candidates and never counts, since it does not score above itself.
    """

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        # Rows of one movie share their query, so each movie is scored once per block.
        first = left.drop_duplicates("movie_id")
        by_movie = left.groupby("movie_id", sort=False).indices
        own, movies = left["score"].to_numpy(), first["movie_id"].to_numpy()
        higher = np.zeros(len(left), dtype=np.int64)
        for at, scores in _score_chunks(first["query"], right["vector"]):
            scores.sort(axis=1)
            for offset, row in enumerate(scores):
                rows = by_movie[movies[at + offset]]
                higher[rows] = len(row) - np.searchsorted(row, own[rows], side="right")
        return left[list(key)].assign(higher=higher)

    def merge(so_far: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        return so_far.assign(higher=so_far["higher"] + more["higher"])

    schema = ", ".join(f"{name} long" for name in key) + ", higher long"
    counted = _against(
        queries.select(*key, "movie_id", "query", "score"), candidates.select("vector"), count, merge, schema,
        block_rows, lookup_bytes,
    )
    return counted.groupBy(*key).agg((F.sum("higher") + 1).alias("rank"))


def top_k_accuracy(ranks: DataFrame, k: int) -> DataFrame:
    """One row: the share of rows whose true pair ranks at or above ``k``, and how many rows there were."""
    hit = (F.col("rank") <= k).cast("double")
    return ranks.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def softmax_losses(
    rows: DataFrame, batch_size: int, position: str = "position", block_rows: int = BLOCK_ROWS, lookup_bytes: int = LOOKUP_BYTES
) -> DataFrame:
    """(batch_id, rows, loss): summed cross-entropy of each row's own history among those of its batch.

    Rows carry ``position`` (unique), ``query`` and ``vector``; a batch is ``batch_size`` consecutive positions. A batch
    may be as large as the table: its vectors are scored block by block, each block by every query of the batch, which a
    task reads from the shared folder. A block leaves a maximum and a scaled sum of exponentials for each query, and
    those of several blocks are merged.
    """
    spark = rows.sparkSession
    batched = rows.select(
        F.floor(F.col(position) / batch_size).cast("long").alias("batch_id"), F.col(position).cast("long").alias("position"),
        *[F.col(name).cast("array<double>").alias(name) for name in ("query", "vector")],
    )
    path = store(batched.repartitionByRange("batch_id", "position").sortWithinPartitions("batch_id", "position"), "batched")
    stored = spark.read.schema(batched.schema).parquet(path)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in regroup(frames, block_rows):
            for batch_id, own in block.groupby("batch_id"):
                theirs = pyarrow.dataset.field("batch_id") == int(batch_id)
                for queries in QueryBatches(path, lookup_bytes, block_rows, ["position", "query"], theirs):
                    for at, scores in _score_chunks(queries["query"], own["vector"], rounded=False):
                        top = scores.max(axis=1)
                        yield pd.DataFrame({
                            "batch_id": batch_id, "position": queries["position"].to_numpy()[at: at + len(scores)],
                            "top": top, "total": np.exp(scores - top[:, None]).sum(axis=1),
                        })

    parts = stored.select("batch_id", "vector").mapInPandas(partial, "batch_id long, position long, top double, total double")
    merged = parts.groupBy("batch_id", "position").agg(
        F.max("top").alias("top"), F.collect_list(F.struct("top", "total")).alias("parts")
    )
    scaled = F.transform("parts", lambda part: part["total"] * F.exp(part["top"] - F.col("top")))
    total = F.aggregate(scaled, F.lit(0.0), lambda so_far, more: so_far + more)
    own = stored.select("batch_id", "position", dot(F.col("query"), F.col("vector")).alias("own"))
    losses = merged.join(own, ["batch_id", "position"]).select("batch_id", (F.col("top") + F.log(total) - F.col("own")).alias("loss"))
    return losses.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("loss").alias("loss"))


def _against(
    left: DataFrame,
    right: DataFrame,
    fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    block_rows: int,
    lookup_bytes: int,
    answer_rows: int = ANSWER_ROWS,
) -> DataFrame:
    """``fn`` of all queries on the left and all candidates on the right, in parts.

    ``left`` is stored once. Each task reads it there, a batch at a time, for each block of its candidates, so
    ``right`` is read once and nothing passes through the driver. ``merge`` joins the answers of one batch to two
    blocks; answers leave the task at its end, or when ``answer_rows`` of them are held.
    """
    path = store(left, "queries")

    def run(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answers: dict[int, pd.DataFrame] = {}
        batches = QueryBatches(path, lookup_bytes, block_rows)
        for block in regroup(blocks, block_rows):
            for number, queries in enumerate(batches):
                part = fn(queries, block)
                answers[number] = merge(answers[number], part) if number in answers else part
            if sum(map(len, answers.values())) > answer_rows:
                yield from answers.values()
                answers = {}
        yield from answers.values()

    return right.mapInPandas(run, schema)


class QueryBatches:
    """Stored queries in batches of at most ``lookup_bytes``, read again each time unless there is but one."""

    def __init__(
        self, path: str, lookup_bytes: int, least_rows: int, columns: Sequence[str] | None = None,
        where: pyarrow.dataset.Expression | None = None,
    ):
        self.path, self.columns, self.where, self.kept = path, columns, where, None
        first = next(stored_batches(path, 1, ["query"]), None)
        width = len(first["query"][0]) if first is not None else 0
        self.rows = max(1, lookup_bytes // (8 * width + 64) or least_rows)

    def __iter__(self) -> Iterator[pd.DataFrame]:
        if self.kept is not None:
            yield from self.kept
            return
        first, several = None, False
        for batch in full_batches(self.path, self.rows, self.columns, self.where):
            several = first is not None
            first = first if several else batch
            yield batch
        if not several:
            self.kept = [first] if first is not None else []


def _score_chunks(queries: pd.Series, vectors: pd.Series, rounded: bool = True):
    """Yield (offset, scores) for slices of the queries, so that a slice of scores stays small."""
    right = np.stack(vectors.to_numpy()).astype(np.float64).T
    step = max(1, CHUNK_SCORES // max(1, right.shape[1]))
    for at in range(0, len(queries), step):
        scores = np.stack(queries.iloc[at: at + step].to_numpy()).astype(np.float64) @ right
        yield at, np.round(scores, DECIMALS) if rounded else scores
