"""Batches of a stored dataset."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def regroup(chunks: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The same rows in frames of exactly ``size``, the last one smaller."""
    waiting: list[pd.DataFrame] = []
    held = 0
    for chunk in chunks:
        while len(chunk):
            part, chunk = chunk.iloc[: size - held], chunk.iloc[size - held:]
            waiting.append(part)
            held += len(part)
            if held == size:
                yield pd.concat(waiting, ignore_index=True)
                waiting, held = [], 0
    if held:
        yield pd.concat(waiting, ignore_index=True)


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str, batch_size: int
) -> DataFrame:
    """Apply ``fn`` to batches of at most ``batch_size`` rows, where the rows are.

    Only the last batch of a partition is smaller, and no more than one batch is held at a time.
    """

    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in regroup(chunks, batch_size):
            yield fn(batch)

    return df.mapInPandas(run, schema)


def take_batches(df: DataFrame, batch_size: int, batches: int) -> DataFrame:
    """As many rows as ``batches`` batches hold."""
    return df.limit(batch_size * batches)
