"""Fixed-length arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def newest(values: Column, n: int) -> Column:
    """The last ``n`` entries; shorter and empty arrays pass unchanged."""
    return F.slice(values, F.greatest(F.lit(1), F.size(values) - F.lit(n - 1)), F.lit(n))


def pad(values: Column, n: int, fill: Column, side: str = "post") -> Column:
    """Up to ``n`` entries made exactly ``n`` with ``fill`` on one side. Cut longer ones with ``newest`` first."""
    fills = F.array_repeat(fill, F.lit(n) - F.size(values))
    return F.concat(values, fills) if side == "post" else F.concat(fills, values)


def unpad(values: Column, length: Column, side: str = "post") -> Column:
    """The ``length`` real entries of a padded array."""
    start = F.lit(1) if side == "post" else F.size(values) - length + 1
    return F.slice(values, start, length)
