"""Day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_gap(later: Column, earlier: Column, unit: str = "calendar") -> Column:
    """Days between two times: calendar boundaries crossed, or whole 24-hour spans elapsed."""
    if unit == "calendar":
        return F.datediff(later, earlier).cast("long")
    return F.timestamp_diff("DAY", earlier, later).cast("long")
