"""Hashes that any engine with md5 can repeat, for samples and seeded orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The time-keyed sample keeps these of 100 buckets, about 4 % of the rows.
SAMPLE_BUCKETS = (10, 20, 30, 40)
SAMPLE_MODULUS = 100


def _leading_bits(text: Column, hex_digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("long")


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def sample_bucket(ts: Column) -> Column:
    """Bucket 0..99 of a time; equal times share a bucket."""
    return _leading_bits(time_text(ts), 8) % SAMPLE_MODULUS


def in_hash_sample(ts: Column, buckets: Sequence[int] = SAMPLE_BUCKETS) -> Column:
    return sample_bucket(ts).isin(*buckets)


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """A 48-bit number per key that orders rows as a seeded shuffle would."""
    parts = [F.col(k).cast("string") for k in keys]
    return _leading_bits(F.concat_ws(":", *parts, F.lit(str(seed))), 12)
