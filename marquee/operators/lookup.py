"""Tables small enough to sit in every task, for looking up arrays of ids without exploding them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOOKUP_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class SmallTable:
    ids: np.ndarray  # sorted
    values: np.ndarray

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each wanted id, and whether it is there at all."""
        if len(self.ids) == 0:
            return np.zeros(wanted.shape, dtype=np.int64), np.zeros(wanted.shape, dtype=bool)
        row = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        return row, self.ids[row] == wanted


def broadcast_small(
    df: DataFrame, key: str, value: str, value_bytes: int, limit: int = LOOKUP_BYTES
) -> Broadcast[SmallTable] | None:
    """The (key, value) table for all tasks, or None when its rows would exceed ``limit`` bytes.

    One row more than fits is asked for, so the table is computed once. Keys have to be unique.
    """
    most = limit // (8 + value_bytes)
    rows = df.select(key, value).where(df[key].isNotNull()).limit(most + 1).toPandas()
    if len(rows) > most:
        return None
    rows = rows.sort_values(key)
    if rows[key].duplicated().any():
        raise ValueError(f"{key} is not unique")
    values = rows[value].to_numpy()
    if len(values) and isinstance(values[0], (np.ndarray, list)):
        values = np.stack(values).astype(np.float64)
    table = SmallTable(rows[key].to_numpy(dtype=np.int64), values)
    return df.sparkSession.sparkContext.broadcast(table)


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """The table, once it is known that no key repeats: a lookup by join would repeat rows otherwise."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{key} is not unique")
    return df
