"""Tables in the shared folder that tasks read for themselves, batch by batch.

For the one side of a product of two tables that every task needs and that may be too large to send: it is written
once and read where it is needed, with one batch of it in memory. The folder has to be one that Arrow reaches by its
path or address, as it is for executors of any Spark cluster with a shared file system or object store.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs


def stored_batches(
    path: str, rows: int, columns: Sequence[str] | None = None, where: pa.dataset.Expression | None = None
) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows; ``where`` leaves out row groups by their statistics, and rows."""
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    table = pyarrow.dataset.dataset(place, filesystem=system, format="parquet")
    if not table.files:
        return
    scanner = table.scanner(
        columns=columns, filter=where, batch_size=rows, batch_readahead=1, fragment_readahead=1, use_threads=False
    )
    for batch in scanner.to_batches():
        if batch.num_rows:
            yield batch


def full_batches(
    path: str, rows: int, columns: Sequence[str] | None = None, where: pa.dataset.Expression | None = None
) -> Iterator[pd.DataFrame]:
    """Frames of exactly ``rows`` rows, the last one smaller, whatever the files hold each."""
    waiting, held = [], 0
    for batch in stored_batches(path, rows, columns, where):
        while batch.num_rows:
            part, batch = batch.slice(0, rows - held), batch.slice(rows - held)
            waiting.append(part)
            held += part.num_rows
            if held == rows:
                yield pa.Table.from_batches(waiting).to_pandas()
                waiting, held = [], 0
    if held:
        yield pa.Table.from_batches(waiting).to_pandas()
