"""Exact top-k over an index that is kept in blocks of alike directions.

Writing clusters the rows by direction: centres come from a bounded sample, every row goes to the nearest one, and a
cell with more than ``block_rows`` rows is cut into several blocks. A block is a folder of its own and has one row in a
table of blocks: its centre, its radius (the furthest direction from the centre), and its largest and smallest norm.

No row of a block can score above ``bound``, by the inequality of Cauchy and Schwarz. A query is first scored in the
blocks of the highest bounds that hold k rows, its home; the k-th score there is its bar. Blocks whose bound stays below
the bars of all queries are not read, and a block that is read is scored for the queries alone whose bar it may reach.
Nothing else is left out, so answers are those of the whole index, ties and rounding included.

The table of blocks has at most ``most_blocks`` rows: blocks grow beyond ``block_rows`` where the index would need more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.lookup import LOOKUP_BYTES
from marquee.operators.retrieval import BLOCK_ROWS, QueryBatches, _score_chunks
from marquee.operators.split import SEED
from marquee.operators.stored import full_batches
from marquee.session import materialise, store

#: A rounded score may lie this far above its bound, which is computed in another order of additions.
SLACK = 1e-6


@dataclass(frozen=True)
class BlockPolicy:
    block_rows: int = BLOCK_ROWS
    most_blocks: int = 16_384
    most_centres: int = 1_024
    sample_rows: int = 65_536
    iterations: int = 8
    seed: int = SEED


@dataclass(frozen=True)
class PrunedIndex:
    """A stored index: ``rows`` are (user_id, .., vector, block), ``blocks`` is the path of the table of blocks."""

    rows: DataFrame
    blocks: str
    n_blocks: int


@dataclass(frozen=True)
class PrunedAnswer:
    """The best rows, the number of blocks read in each pass, and the share of (query, block) pairs that were scored."""

    best: DataFrame
    blocks: int
    home_blocks: int
    further_blocks: int
    scored_share: float


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((vectors**2).sum(axis=1))
    return vectors / np.where(norms > 0, norms, 1.0)[:, None], norms


def fit_centres(index: DataFrame, wanted: int, policy: BlockPolicy) -> np.ndarray:
    """Unit vectors from a sample of at most ``sample_rows`` rows; the sample decides how much is spared, never a result."""
    rows = index.select("vector").where(F.exists("vector", lambda x: x != 0))
    n = rows.count()
    if n == 0 or wanted < 2:
        first = rows.first()
        return _unit(np.array([first["vector"]], dtype=np.float64))[0] if first else np.zeros((1, 0))
    chosen = F.pmod(F.xxhash64("vector", F.lit(policy.seed)), F.lit(1_000_000)) < 1_200_000 * policy.sample_rows // n
    sample = rows.where(chosen) if n > policy.sample_rows else rows
    sample = sample.limit(policy.sample_rows).select(array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    fit = KMeans(k=wanted, distanceMeasure="cosine", initMode="random", maxIter=policy.iterations, seed=policy.seed)
    return _unit(np.array(fit.fit(materialise(sample, "sample")).clusterCenters()))[0]


def write_pruned_index(index: DataFrame, path: str, policy: BlockPolicy = BlockPolicy()) -> None:
    """Store ``index`` (user_id, .., vector) in blocks. It is read three times: pass a stored table."""
    spark = index.sparkSession
    n = index.count()
    block_rows = max(policy.block_rows, math.ceil(n / max(1, policy.most_blocks // 2)))
    wanted = min(policy.most_centres, math.ceil(n / block_rows))
    centres = spark.sparkContext.broadcast(fit_centres(index, wanted, policy))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            unit, norms = _unit(np.stack(frame["vector"].to_numpy()).astype(np.float64))
            known = centres.value if centres.value.shape[1] else np.zeros((1, unit.shape[1]))
            cell = (unit @ known.T).argmax(axis=1)
            away = np.sqrt(((unit - known[cell]) ** 2).sum(axis=1))
            yield frame.assign(cell=cell, away=away, norm=norms)

    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in index.schema)
    placed = materialise(index.mapInPandas(assign, f"{columns}, cell long, away double, norm double"), "placed")
    cells = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # One row per centre, so the window and the broadcast are bounded.
    cells = cells.withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)))
    part = F.pmod(F.xxhash64("user_id", "vector"), F.col("parts"))
    rows = placed.join(F.broadcast(cells), "cell").withColumn("block", (F.col("first") + part).cast("int"))
    rows.repartition("block").sortWithinPartitions("block").drop("cell", "away", "norm", "parts", "first").write.mode(
        "errorifexists"
    ).partitionBy("block").parquet(f"{path}/rows")
    vectors = spark.createDataFrame(list(enumerate(centres.value.tolist())), "cell long, centre array<double>")
    found = rows.groupBy("block", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"), F.max("norm").alias("largest"), F.min("norm").alias("smallest")
    )
    found.join(F.broadcast(vectors), "cell").drop("cell").coalesce(1).write.mode("errorifexists").parquet(f"{path}/blocks")


def read_pruned_index(spark: SparkSession, path: str) -> PrunedIndex:
    blocks = spark.read.parquet(f"{path}/blocks")
    n = blocks.count()
    if n == 0:
        return PrunedIndex(spark.createDataFrame([], "user_id long, vector array<double>, block int"), f"{path}/blocks", 0)
    return PrunedIndex(spark.read.parquet(f"{path}/rows"), f"{path}/blocks", n)


class Blocks:
    """The table of blocks, in block order."""

    def __init__(self, path: str):
        table = pd.concat([*full_batches(path, 65_536)], ignore_index=True).sort_values("block")
        self.block, self.n = table["block"].to_numpy(), table["n"].to_numpy()
        self.radius, self.largest, self.smallest = (table[name].to_numpy() for name in ("radius", "largest", "smallest"))
        self.centre = np.stack(table["centre"].to_numpy())

    def bound(self, queries: np.ndarray, places: slice | np.ndarray = slice(None)) -> np.ndarray:
        """Highest score that each query may have in each block."""
        if self.centre.shape[1] == 0:  # zero vectors alone
            return np.zeros((len(queries), len(self.block[places])))
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        best = queries @ self.centre[places].T + length * self.radius[places] * (1 + 1e-9)
        best = np.minimum(best, length)
        reach = best * np.where(best > 0, self.largest[places], self.smallest[places])
        return reach + SLACK + 1e-9 * np.abs(reach)


def _matrix(queries: pd.DataFrame) -> np.ndarray:
    return np.stack(queries["query"].to_numpy()).astype(np.float64)


#: Bounds worked out together.
BOUNDS_AT_ONCE = 4_000_000


def _slices(frames: Iterator[pd.DataFrame], blocks: Blocks) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    step = max(1, BOUNDS_AT_ONCE // len(blocks.block))
    for frame in frames:
        for at in range(0, len(frame), step):
            part = frame.iloc[at: at + step]
            yield part, blocks.bound(_matrix(part))


def with_homes(queries: DataFrame, index: PrunedIndex, k: int) -> DataFrame:
    """Queries with the blocks of the highest bounds that hold ``k`` rows together."""
    path = index.blocks

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = Blocks(path)
        for part, bounds in _slices(frames, blocks):
            order = np.argsort(-bounds, axis=1, kind="stable")
            enough = (np.cumsum(blocks.n[order], axis=1) < k).sum(axis=1) + 1
            homes = [blocks.block[own[:n]].tolist() for own, n in zip(order, enough, strict=True)]
            yield part[["movie_id", "query"]].assign(home=homes)

    typed = queries.select("movie_id", F.col("query").cast("array<double>").alias("query"))
    return typed.mapInPandas(choose, "movie_id long, query array<double>, home array<int>")


def further_blocks(queries: DataFrame, index: PrunedIndex) -> DataFrame:
    """(block, queries) of the blocks that some query's bar does not rule out, its home apart, partial for each task."""
    path = index.blocks

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = Blocks(path)
        counts = np.zeros(len(blocks.block), dtype=np.int64)
        for part, bounds in _slices(frames, blocks):
            open_ = bounds >= part["bar"].fillna(-np.inf).to_numpy()[:, None]
            for row, home in enumerate(part["home"]):
                open_[row, np.searchsorted(blocks.block, home)] = False
            counts += open_.sum(axis=0)
        yield pd.DataFrame({"block": blocks.block, "queries": counts})[counts > 0]

    return queries.mapInPandas(find, "block int, queries long")


def _scan(index: PrunedIndex, wanted: list[int], path: str, k: int, further: bool, block_rows: int, lookup_bytes: int) -> DataFrame:
    """(movie_id, user_id, score) of rows in the wanted blocks, the best ``k`` per query, block and task.

    In the first pass a query meets its home; in the further one the blocks whose bound reaches its bar, and scores
    below the bar are dropped.
    """
    table = index.blocks

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = Blocks(table)
        batches = QueryBatches(path, lookup_bytes, block_rows)
        for block, rows in _by_block(frames, block_rows):
            place = np.searchsorted(blocks.block, [block])
            for queries in batches:
                mine = np.array([block in home for home in queries["home"]], dtype=bool)
                if further:
                    bars = queries["bar"].fillna(-np.inf).to_numpy()
                    mine = ~mine & (blocks.bound(_matrix(queries), place)[:, 0] >= bars)
                asked = queries[mine]
                for at, scores in _score_chunks(asked["query"], rows["vector"]) if len(asked) else ():
                    worst = scores.shape[1] - min(k, scores.shape[1])
                    bar = np.partition(scores, worst, axis=1)[:, worst]
                    if further:
                        bar = np.maximum(bar, bars[mine][at: at + len(scores)])
                    row, col = np.nonzero(scores >= bar[:, None])
                    if len(row):
                        yield pd.DataFrame({
                            "movie_id": asked["movie_id"].to_numpy()[at + row], "user_id": rows["user_id"].to_numpy()[col],
                            "score": scores[row, col],
                        })

    rows = index.rows.where(F.col("block").isin(wanted)).select("user_id", "vector", "block")
    return rows.mapInPandas(run, "movie_id long, user_id long, score double")


def _by_block(frames: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[int, pd.DataFrame]]:
    """Consecutive rows of one block, at most ``most`` of them together."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        ids = frame["block"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1), len(frame)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            part = frame.iloc[start:stop]
            if held and (held[0]["block"].iloc[0] != ids[start] or sum(map(len, held)) + len(part) > most):
                yield int(held[0]["block"].iloc[0]), pd.concat(held, ignore_index=True)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield int(held[0]["block"].iloc[0]), pd.concat(held, ignore_index=True)


def top_k_pruned(
    queries: DataFrame, index: PrunedIndex, k: int, block_rows: int = BLOCK_ROWS, lookup_bytes: int = LOOKUP_BYTES
) -> PrunedAnswer:
    """(movie_id, rank, user_id, score): what ``top_k`` gives on the whole index. Queries have one row per movie."""
    spark = queries.sparkSession
    order = Window.partitionBy("movie_id").orderBy(F.desc("score"), "user_id")

    def ranked(found: DataFrame) -> DataFrame:
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return best.select("movie_id", F.col("rank").cast("long").alias("rank"), "user_id", "score")

    if index.n_blocks == 0:
        empty = spark.createDataFrame([], "movie_id long, user_id long, score double")
        return PrunedAnswer(ranked(empty), 0, 0, 0, 0.0)
    path = store(with_homes(queries, index, k), "queries_with_homes")
    homed = spark.read.parquet(path)
    # Numbers of blocks are all that reaches the driver: at most ``most_blocks``.
    homes = homed.select(F.explode("home").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("queries")).collect()
    found = materialise(ranked(_scan(index, [r["block"] for r in homes], path, k, False, block_rows, lookup_bytes)), "home_scores")
    bars = found.where(F.col("rank") == k).select("movie_id", F.col("score").alias("bar"))
    path = store(homed.join(bars, "movie_id", "left"), "queries_with_bars")
    asked = spark.read.parquet(path)
    more = further_blocks(asked, index).groupBy("block").agg(F.sum("queries").alias("queries")).collect()
    further = _scan(index, [r["block"] for r in more], path, k, True, block_rows, lookup_bytes)
    best = ranked(found.select("movie_id", "user_id", "score").unionByName(further))
    scored = sum(r["queries"] for r in homes) + sum(r["queries"] for r in more)
    pairs = asked.count() * index.n_blocks
    return PrunedAnswer(best, index.n_blocks, len(homes), len(more), scored / pairs if pairs else 0.0)
