"""Seeded order and exact hold-out, both from a hash of the row key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.config import SkewPolicy
from marquee.functions import hash_order
from marquee.operators.skew import with_positions

SEED = 42
HASH_BITS = 48
LEVEL_BITS = 12
FEW_ROWS = 10_000


def shuffled(df: DataFrame, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """All rows in one seeded order, the same for any partitioning of the input."""
    return df.orderBy(hash_order(keys, seed), *keys)


def with_shuffle_position(
    df: DataFrame, keys: Sequence[str], seed: int = SEED, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """The place of each row in the seeded order, from 0."""
    hashed = df.withColumn("shuffle_hash", hash_order(keys, seed))
    order = ("shuffle_hash", *keys)
    return with_positions(hashed, (), order, policy, hashed.count(), name="shuffle_position")


@dataclass(frozen=True)
class Cut:
    """The last row, in seeded order, of the held-out part. None holds out nothing."""

    keys: tuple[str, ...]
    seed: int
    last: tuple | None

    @property
    def held_out(self) -> Column:
        if self.last is None:
            return F.lit(False)
        row = F.struct(hash_order(self.keys, self.seed).alias("h"), *self.keys)
        names = ("h", *self.keys)
        last = F.struct(*[F.lit(value).cast("long").alias(n) for n, value in zip(names, self.last)])
        return row <= last


def find_cut(df: DataFrame, keys: Sequence[str], n: int, seed: int = SEED) -> Cut:
    """Where the first ``n`` rows of the seeded order end. ``keys`` are long columns that identify a row.

    The place is narrowed by counting rows per leading digits of the hash, 4096 counts at a time, until
    the digits leave few rows; only those are sorted. Splitting is then a filter, without a sort or join.
    """
    rows = df.select(hash_order(keys, seed).alias("h"), *keys)
    wanted, shift = n, HASH_BITS
    while wanted > 0:
        shift -= LEVEL_BITS
        counts = rows.groupBy(F.shiftright("h", shift).alias("digits")).agg(F.count(F.lit(1)).alias("n"))
        found = None
        for level in sorted(counts.collect()):  # at most 4096 rows
            if wanted <= level["n"]:
                found = level
                break
            wanted -= level["n"]
        if found is None:  # fewer than n rows: all are held out
            last = (2**HASH_BITS, *[0 for _ in keys])
            return Cut(tuple(keys), seed, last)
        rows = rows.where(F.shiftright("h", shift) == found["digits"])
        if found["n"] <= FEW_ROWS or shift == 0:
            break
    if wanted <= 0:
        return Cut(tuple(keys), seed, None)
    last = rows.orderBy("h", *keys).offset(wanted - 1).limit(1).first()
    return Cut(tuple(keys), seed, tuple(last))


def hold_out(
    df: DataFrame, keys: Sequence[str], n: int, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(rest, held out): exactly ``n`` rows are held out, or all when there are fewer.

    ``df`` is read several times, so pass a stored dataset rather than a long plan.
    """
    cut = find_cut(df, keys, n, seed)
    return df.where(~cut.held_out), df.where(cut.held_out)


def shuffled_within(buffers: DataFrame, buffer_rows: int, keys: Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows with ``shuffle_position``: a seeded order within buffers of consecutive rows, which stay one after another.

    ``buffers`` are batches by place of ``buffer_rows`` rows (``sources.batches.read_batches``), whole ones in a partition.
    Every buffer is sorted where it is read and nothing is exchanged, so this costs no more than a read of the table;
    ``shuffled`` is the order over all rows.
    """
    # Of this number the lower 33 bits count the rows of a partition.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = buffers.withColumn("_first", F.col("place") - within)  # the same for all rows of a partition
    buffer = F.floor(F.col("place") / F.lit(buffer_rows))
    ordered = first.withColumn("_hash", hash_order(keys, seed)).sortWithinPartitions(buffer, "_hash", *keys)
    placed = ordered.withColumn("shuffle_position", F.col("_first") + within)
    return placed.drop("_first", "_hash", "batch_id", "place")
