"""Commits: a part of a snapshot is there once its manifest is.

A writer first claims the part with a file that only one can make, so of two writers one is refused before it writes. It
then writes its tables, and last the manifest: rows, schema and files of each table. Readers go by the manifest. They
refuse a part without one, and tables whose files are no longer those that were committed. A part whose writer failed
stays unreadable; ``discard`` removes it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.sources import files
from marquee.sources.snapshots import SnapshotLayout, refuse_existing, write_dataset


class NotCommitted(FileNotFoundError):
    """There is no manifest: nothing was written, or its writer did not come to the end."""


class Changed(RuntimeError):
    """The files are not those that were committed."""


def _manifest_path(layout: SnapshotLayout, part: str) -> str:
    return f"{layout.root}/{layout.snapshot}/{part}/manifest.json"


def _claim_path(layout: SnapshotLayout, part: str) -> str:
    return f"{layout.root}/{layout.snapshot}/{part}/_claim"


@dataclass
class Writer:
    spark: SparkSession
    layout: SnapshotLayout
    part: str
    tables: dict[str, str] = field(default_factory=dict)  # path by table
    details: dict = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.layout.root}/{self.layout.snapshot}/{self.part}/{table}/{table}.parquet"

    def write(self, table: str, rows: DataFrame) -> str:
        write_dataset(rows, self.path(table))
        return self.add(table, self.path(table))

    def add(self, table: str, path: str) -> str:
        """Take a table into the commit that was written to its path below the part by other means."""
        self.tables[table] = path
        return path


@contextmanager
def writing(spark: SparkSession, layout: SnapshotLayout, part: str, tables: tuple[str, ...] = ()) -> Iterator[Writer]:
    """A claimed part; leaving the block without an error commits it. ``tables`` must not have been written yet."""
    writer = Writer(spark, layout, part)
    refuse_existing(spark, map(writer.path, tables))
    files.create_new(spark, _claim_path(layout, part), layout.snapshot)
    yield writer
    entries = {}
    for table, path in writer.tables.items():
        stored = spark.read.parquet(path)  # counting reads the footers alone
        entries[table] = {
            "path": path.removeprefix(f"{layout.root}/{layout.snapshot}/"), "rows": stored.count(),
            "schema": json.loads(stored.schema.json()), "files": files.list_files(spark, path),
        }
    content = {"snapshot": layout.snapshot, "part": part, "tables": entries, "details": writer.details}
    files.publish(spark, _manifest_path(layout, part), json.dumps(content, indent=1))


@dataclass(frozen=True)
class Committed:
    """A part as its manifest says it is."""

    spark: SparkSession
    layout: SnapshotLayout
    tables: dict[str, dict]
    details: dict

    def path(self, table: str) -> str:
        return f"{self.layout.root}/{self.layout.snapshot}/{self.tables[table]['path']}"

    def rows(self, table: str) -> int:
        return self.tables[table]["rows"]

    def read(self, table: str) -> DataFrame:
        """The table, once its files are found to be the committed ones."""
        if files.list_files(self.spark, self.path(table)) != self.tables[table]["files"]:
            raise Changed(f"{self.path(table)} holds other files than were committed")
        return self.spark.read.schema(T.StructType.fromJson(self.tables[table]["schema"])).parquet(self.path(table))


def open_part(spark: SparkSession, layout: SnapshotLayout, part: str = "data") -> Committed:
    path = _manifest_path(layout, part)
    if not files.exists(spark, path):
        raise NotCommitted(f"{path}: no such manifest, so the {part} of this snapshot are not whole")
    content = json.loads(files.read_text(spark, path))
    return Committed(spark, layout, content["tables"], content["details"])


def read_snapshot(spark: SparkSession, layout: SnapshotLayout, table: str, part: str = "data") -> DataFrame:
    return open_part(spark, layout, part).read(table)


def discard(spark: SparkSession, layout: SnapshotLayout, part: str = "data") -> None:
    """Remove what a failed writer left. A committed part is kept, and its removal refused."""
    if files.exists(spark, _manifest_path(layout, part)):
        raise FileExistsError(f"{part} of {layout.snapshot} are committed")
    files.delete(spark, f"{layout.root}/{layout.snapshot}/{part}")
