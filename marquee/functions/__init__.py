from marquee.functions.arrays import newest, pad, unpad
from marquee.functions.dates import day_gap
from marquee.functions.hashing import hash_order, in_hash_sample, sample_bucket
from marquee.functions.vectors import dot

__all__ = [
    "newest", "pad", "unpad", "day_gap", "hash_order", "in_hash_sample", "sample_bucket", "dot",
]
