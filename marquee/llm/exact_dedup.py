"""Exact deduplication by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes says so, so equal passages give equal chunks wherever
they stand. Chunks are named by a 64-bit hash, and the names are verified: an aggregation moves each distinct
chunk once per map task and finds every hash that stands for two different chunks (their bytes are compared).
Such chunks get a variant number; all others are known by the hash alone. A text is then the ordered list of
its chunk identifiers, a few bytes per kilobyte, and only these lists are grouped and joined.

Defined cases: a null text counts as empty, and all empty texts are equal (their list is empty). Of equal
texts the row with the largest ``doc_id`` stays, a null id counting as smallest; rows that also share the id
are told apart by their place in the table, so exactly one row of a group stays. Further columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, addressable, ready, shuffle_partitions, utf8, whole_text, with_row_key
from marquee.session import materialise

WINDOW = 32
BLOCK = 1 << 20


@dataclass(frozen=True)
class ChunkPolicy:
    """Chunk sizes in bytes, and the bits kept of a chunk's hash (fewer only to provoke collisions in tests)."""

    least: int = 256
    mean_bits: int = 11
    most: int = 16_384
    hash_bits: int = 64

    def __post_init__(self):
        if self.least < WINDOW or self.most < self.least or not 1 <= self.mean_bits <= 31:
            raise ValueError("chunk sizes do not fit the rolling hash")


def _byte_values() -> np.ndarray:
    """One 32-bit number per byte value, by a multiplicative mixing rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


BYTE_VALUES = _byte_values()


def rolling_hits(data: np.ndarray, mean_bits: int) -> np.ndarray:
    """Positions just after which the hash of the last 32 bytes is a hit, by doubling the window five times."""
    hits = []
    for start in range(0, len(data), BLOCK):
        first = max(0, start - WINDOW + 1)
        hashes = BYTE_VALUES[data[first: start + BLOCK]]
        for shift in (1, 2, 4, 8, 16):
            hashes[shift:] = hashes[shift:] + (hashes[:-shift] << np.uint32(shift))
        found = np.flatnonzero(hashes >> np.uint32(32 - mean_bits) == 0) + first + 1
        hits.append(found[found > start])
    return np.concatenate(hits) if hits else np.zeros(0, dtype=np.int64)


def chunk_ends(texts: pa.Array, policy: ChunkPolicy) -> pa.Array:
    """For each text the ends of its chunks in bytes; an empty text has none."""
    data, bounds = utf8(texts)
    hits = rolling_hits(data, policy.mean_bits).tolist()
    ends, sizes = [], [0]
    for begin, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        at = begin
        while at < stop:
            # The least size exceeds the hash window, so no cut depends on the text before.
            place = bisect_left(hits, at + policy.least)
            limit = min(stop, at + policy.most)
            at = hits[place] if place < len(hits) and hits[place] < limit else limit
            ends.append(at - begin)
        sizes.append(len(ends))
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(ends, pa.int32()))


def _with_chunks(docs: DataFrame, policy: ChunkPolicy) -> DataFrame:
    """Row key, id, text and its chunks as bytes, cut out on the JVM side from the ends found in Python."""
    ready(docs.sparkSession)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ends(texts: pa.Array) -> pa.Array:
        return chunk_ends(texts, policy)

    rows = with_row_key(addressable(docs.select("doc_id", "text"))).select(ROW, "doc_id", whole_text().alias("_text"))
    rows = rows.withColumn("_ends", ends("_text"))
    data = F.col("_text").cast("binary")

    def chunk(end: Column, i: Column) -> Column:
        begin = F.coalesce(F.get("_ends", i - 1), F.lit(0))
        return F.substring(data, begin + 1, end - begin)

    return rows.select(ROW, "doc_id", "_text", F.transform("_ends", chunk).alias("_chunks"))


def _name(chunk: Column, policy: ChunkPolicy) -> Column:
    hashed = F.xxhash64(chunk)
    return hashed if policy.hash_bits == 64 else F.pmod(hashed, F.lit(2**policy.hash_bits))


def colliding_names(chunked: DataFrame, policy: ChunkPolicy) -> DataFrame:
    """Names that stand for at least two different chunks: the smallest and the largest chunk differ."""
    # The outer kind: for the other, Spark would find the chunks twice, first to leave out rows that have none.
    chunks = chunked.select(F.explode_outer("_chunks").alias("chunk")).where("chunk is not null")
    found = chunks.groupBy(_name(F.col("chunk"), policy).alias("name")).agg(
        F.min("chunk").alias("low"), F.max("chunk").alias("high")
    )
    return found.where(F.col("low") != F.col("high")).select("name")


def _variants(chunked: DataFrame, colliding: DataFrame, policy: ChunkPolicy) -> DataFrame:
    """Per row the numbers, in text order, that tell apart its chunks of colliding names."""
    chunks = chunked.select(ROW, F.posexplode_outer("_chunks").alias("pos", "chunk")).where("chunk is not null")
    chunks = chunks.withColumn("name", _name(F.col("chunk"), policy)).join(colliding, "name", "left_semi")
    order = Window.partitionBy("name").orderBy("chunk")
    numbers = chunks.select("name", "chunk").distinct().withColumn("variant", F.row_number().over(order))
    listed = chunks.join(numbers, ["name", "chunk"]).groupBy(ROW).agg(
        F.sort_array(F.collect_list(F.struct("pos", "variant"))).alias("found")
    )
    return listed.select(ROW, F.col("found.variant").alias("variants"))


def recipes(docs: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """One stored row per document: key, id, SHA-256 of the text, and the ordered list of chunk identifiers."""
    chunked = _with_chunks(docs, policy)
    names = F.transform("_chunks", lambda chunk: _name(chunk, policy))
    listed = materialise(
        chunked.select(ROW, "doc_id", F.sha2("_text", 256).alias("text_sha256"), names.alias("names")), "recipes"
    )
    colliding = materialise(colliding_names(chunked, policy), "colliding_names")
    if colliding.isEmpty():
        variants = F.array().cast("array<int>")
        return listed.withColumn("variants", variants)
    joined = listed.join(_variants(chunked, colliding, policy), ROW, "left")
    return joined.withColumn("variants", F.coalesce("variants", F.array().cast("array<int>")))


def exact_groups(docs: DataFrame, policy: ChunkPolicy = ChunkPolicy()) -> DataFrame:
    """Per document: the id that stays, the size of its group, whether it is the row that stays, and its SHA-256.

    Groups are first aggregated per list and salt, so a group that holds a third of all rows meets in as many
    rows as there are salts, and its result goes back to its members by the same salted key.
    """
    salts = shuffle_partitions(docs.sparkSession)
    listed = recipes(docs, policy).withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(salts)).cast("int"))
    parts = listed.groupBy("names", "variants", "salt").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", ROW)).alias("last")
    )
    groups = parts.groupBy("names", "variants").agg(
        F.sum("n").alias("group_size"), F.max("last").alias("keep"), F.collect_list("salt").alias("salts")
    )
    answers = groups.select("names", "variants", "group_size", "keep", F.explode("salts").alias("salt"))
    joined = listed.join(answers, ["names", "variants", "salt"])
    return joined.select(
        ROW, "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col(ROW) == F.col(f"keep.{ROW}")).alias("kept"), "text_sha256",
    )
