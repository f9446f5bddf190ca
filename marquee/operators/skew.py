"""Groups too large for one task: finding them, numbering their rows and cutting them into segments.

A window runs each group in one task, so a user who holds a large share of all ratings would stall it.
Such users are found by a pre-aggregated count, their rows are numbered along a range-partitioned sort
(which may split a user anywhere), and windows then run per fixed-size segment. Each segment also gets
the last rows of the one before it, as many as the window frame reaches back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import SkewPolicy
from marquee.session import materialise


@dataclass(frozen=True)
class HotKeys:
    """Keys of the oversized groups, with their count and the rows they hold."""

    frame: DataFrame
    keys: int
    rows: int


def find_hot_keys(rows: DataFrame, key: str, policy: SkewPolicy) -> HotKeys | None:
    """Keys with more than ``max_group_rows`` rows, or None when no group is that large."""
    return find_groups(rows, key, policy)[1]


def find_groups(rows: DataFrame, key: str, policy: SkewPolicy) -> tuple[int, HotKeys | None]:
    """The rows of ordinary groups, counted, and the keys of those with more than ``max_group_rows`` rows, if any."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    is_hot = F.col("n") > policy.max_group_rows
    found = counts.agg(
        F.count_if(is_hot).alias("keys"), F.sum(F.when(is_hot, F.col("n"))).alias("rows"),
        F.coalesce(F.sum(F.when(~is_hot, F.col("n"))), F.lit(0)).alias("ordinary"),
    ).first()
    if found["keys"] == 0:
        return found["ordinary"], None
    hot = HotKeys(materialise(counts.where(is_hot).select(key), "hot_keys"), found["keys"], found["rows"])
    return found["ordinary"], hot


def dealt(rows: DataFrame, n_rows: int, policy: SkewPolicy, *keys: str) -> DataFrame:
    """``rows`` by ``keys`` in as many partitions as hold ``task_rows`` of the ``n_rows`` each.

    A partition count that does not follow the rows would let tasks grow with the table; and partitions merged by their
    stored size hold many times that size once windows have gathered their arrays.
    """
    fewest = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(fewest, math.ceil(n_rows / policy.task_rows)), *keys)


def join_counted(left: DataFrame, right: DataFrame, on, how: str, right_rows: int, policy: SkewPolicy):
    """Broadcast ``right`` while its counted rows allow it; otherwise a shuffle join with skew splitting."""
    return left.join(F.broadcast(right) if right_rows <= policy.broadcast_rows else right, on, how)


def split_hot(rows: DataFrame, key: str, hot: HotKeys, policy: SkewPolicy) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary groups and rows of oversized ones; together they are all rows."""
    return (
        join_counted(rows, hot.frame, key, "left_anti", hot.keys, policy),
        join_counted(rows, hot.frame, key, "left_semi", hot.keys, policy),
    )


def with_positions(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    policy: SkewPolicy,
    n_rows: int,
    n_keys: int = 1,
    name: str = "position",
) -> DataFrame:
    """Number the rows of each key from 0 along ``order`` without gathering any key in one task.

    With no keys, the whole table gets one dense numbering. ``order`` has to be unique within a key.
    The sorted rows are written once, so the numbering stays the same when tasks are run again.
    """
    partitions = max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(n_rows / policy.range_rows),
    )
    ordered = (
        rows.repartitionByRange(partitions, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    stored = materialise(ordered, "ordered").withColumn("_part", F.shiftright("_row", 33))
    runs = stored.groupBy(*keys, "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *keys, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # A run is one key in one partition: at most one more per partition than there are keys.
    numbered = join_counted(stored, offsets, [*keys, "_part"], "inner", n_keys + partitions, policy)
    return numbered.withColumn(name, F.col("_before") + F.col("_row") - F.col("_first")).select(
        *rows.columns, name
    )


def segment_of(position: str, policy: SkewPolicy) -> Column:
    return F.floor(F.col(position) / policy.segment_rows).cast("long")


def with_segments(
    rows: DataFrame, position: str, policy: SkewPolicy, reach: int, name: str = "segment"
) -> DataFrame:
    """Put each row into its segment, and the last ``reach`` rows of a segment into the next one too."""
    own = segment_of(position, policy)
    near_end = F.col(position) % policy.segment_rows >= policy.segment_rows - reach
    segments = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return rows.withColumn(name, F.explode(segments))


def without_lent_rows(rows: DataFrame, position: str, policy: SkewPolicy, name: str = "segment") -> DataFrame:
    """Drop the copies lent to a following segment, once the windows that needed them are done."""
    return rows.where(F.col(name) == segment_of(position, policy))
