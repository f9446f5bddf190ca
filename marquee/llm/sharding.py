"""Sharding by weighted rendezvous hashing, in DataFrame functions alone.

Every shard draws a number from (0, 1) for a record's key, weighs it, and the record goes to the shard with the
best draw. A shard added later takes exactly the records whose best draw is its own; no other record moves.
Keys and shard numbers alone decide, so a record's shard is the same in any table and at any time.

Defined cases: a null key is a key of its own (all rows with it share a shard); a null text has size 1 and the
checksum of an empty text; equal draws go to the smaller shard number; repeated rows share a shard and get slots
of their own, in table order. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.config import SkewPolicy
from marquee.llm.common import ROW, whole_text, with_pass_key
from marquee.operators.skew import with_positions
from marquee.session import materialise

#: Hexadecimal digits of a draw: 52 bits, which a double holds exactly.
DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """A shard's number for a key, inside (0, 1)."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(shard))))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return (number + 0.5) / F.lit(float(16**DIGITS))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the largest ``-weight / ln(draw)``: each gets its weight's share of the keys."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    scores = [
        F.struct((F.lit(-float(weight)) / F.log(draw(key, shard))).alias("score"), F.lit(-shard).alias("shard"))
        for shard, weight in enumerate(weights)
    ]
    return (-F.array_max(F.array(*scores))["shard"]).cast("int")


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """The table with each record's shard: no shuffle, the draws are computed where the record lies."""
    return df.withColumn(name, rendezvous(F.col(key), weights))


def shard_slots(
    docs: DataFrame, weights: Sequence[float], added_weight: float, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Size, checksum, shard and slot of every document, and its shard once one more of ``added_weight`` exists.

    Slots number a shard's records from 0 by ``doc_id``. The numbering runs along a range-partitioned sort that
    may cut a shard, or one repeated id, anywhere; only narrow rows are shuffled, never texts.
    """
    rows = docs.select(
        "doc_id",
        (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).cast("long").alias("text_crc32"),
    )
    rows = assign_shards(rows, "doc_id", weights)
    rows = assign_shards(rows, "doc_id", [*weights, added_weight], "grown_shard")
    narrow = materialise(with_pass_key(rows), "shards")
    total = narrow.count()
    return with_positions(narrow, ["shard"], ["doc_id", ROW], policy, total, len(weights), "slot")
