"""Batches of a stored table by place: batch i is the same rows at every read, and is read without those before it.

Rows count from 0 through the files in the order of their names. How many each file holds is counted once, from the
footers, and stored; a Python data source then makes one partition of each wanted batch, which opens the files and row
groups that hold it and no others. Of very many batches a partition holds several that follow one another, so that a row
group is read by as many partitions as its rows make up and not once for every batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from marquee.operators.stored import stored_batches
from marquee.session import ship_package, store

NAME = "marquee_batches"
#: Rows handed on together.
ROWS_AT_ONCE = 10_000
#: Up to so many batches have a partition each; beyond, a partition takes several, in all up to so many rows.
PARTITIONS = 256
ROWS_PER_PARTITION = 200_000


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, first): how many rows each file holds, and the place of its first one."""
    # No column is read: the counts come from the footers.
    counted = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    # One row per file, as in any listing of the table.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))


@dataclass
class Batches(InputPartition):
    """Batches that follow one another."""

    first: int
    parts: list[tuple[str, int, int]]  # file, first row there, row after the last


class BatchReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.names = schema.names[:-2]
        self.files, self.size = options["files"], int(options["rows"])
        self.start, self.count = int(options["start"]), int(options["count"])

    def partitions(self) -> list[Batches]:
        found = [row for batch in stored_batches(self.files, 65_536) for row in batch.to_pylist()]
        found.sort(key=lambda row: row["first"])
        files, firsts, rows = ([row[name] for row in found] for name in ("file", "first", "rows"))
        total = sum(rows)
        last = min(self.start + self.count, -(-total // self.size)) if self.count >= 0 else -(-total // self.size)
        together = min(-(-(last - self.start) // PARTITIONS), max(1, ROWS_PER_PARTITION // self.size))
        found = []
        for number in range(self.start, last, max(1, together)):
            begin, end = number * self.size, min(total, min(last, number + together) * self.size)
            place = int(np.searchsorted(firsts, begin, side="right")) - 1
            parts = []
            while place < len(files) and firsts[place] < end:
                parts.append((files[place], max(0, begin - firsts[place]), min(rows[place], end - firsts[place])))
                place += 1
            found.append(Batches(begin, parts))
        return found

    def read(self, partition: Batches | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # how Spark asks where there are no partitions
            return
        place = partition.first
        for path, start, stop in partition.parts:
            for rows in rows_between(path, start, stop, self.names):
                n = rows.num_rows
                places = np.arange(place, place + n)
                place += n
                added = [pa.array(places // self.size), pa.array(places)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], [*rows.schema.names, "batch_id", "place"])


def rows_between(path: str, start: int, stop: int, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows ``start`` to ``stop`` of a file, in parts; row groups outside are not read, nor what follows in the last one."""
    system, place = pyarrow.fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as source:
        file, first = pyarrow.parquet.ParquetFile(source), 0
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            begin, end = max(start, first), min(stop, first + rows)
            if begin < end:
                place = first
                for part in file.iter_batches(ROWS_AT_ONCE, row_groups=[group], columns=list(columns), use_threads=False):
                    ahead = max(0, begin - place)
                    if ahead < part.num_rows:
                        yield part.slice(ahead, min(end - place, part.num_rows) - ahead)
                    place += part.num_rows
                    if place >= end:
                        break
            first += rows


class BatchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> BatchReader:
        return BatchReader(schema, self.options)


def read_batches(
    spark: SparkSession, path: str, batch_rows: int, first: int = 0, batches: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a stored table with their ``batch_id`` and ``place``: all batches from ``first`` on, or so many of them.

    A partition is a batch, or some that follow one another where there are more than ``PARTITIONS``; it never holds a part
    of one. ``columns`` names those to read. The folder has to be one that Arrow reaches by its path.
    """
    if batch_rows < 1 or first < 0:
        raise ValueError("batches have at least one row, and count from 0")
    ship_package(spark)
    spark.dataSource.register(BatchSource)
    stored = spark.read.parquet(path)
    stored = stored.select(*columns) if columns else stored
    if {"batch_id", "place"} & {name.lower() for name in stored.columns}:
        raise ValueError("batch_id and place are names of what is added")
    schema = T.StructType([*stored.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("place", T.LongType())])
    options = {
        "files": store(file_rows(spark, path), "file_rows"), "rows": batch_rows, "start": first,
        "count": -1 if batches is None else batches,
    }
    return spark.read.format(NAME).schema(schema).options(**options).load()


def take_batches(spark: SparkSession, path: str, batch_rows: int, batches: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The first batches of a stored table: the same rows at every read."""
    return read_batches(spark, path, batch_rows, 0, batches, columns)
