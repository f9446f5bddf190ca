"""Snapshot folders and the tables kept in them. Writing never replaces what is there."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.schemas import INDEX, METRICS


def _now() -> str:
    # Fixed format: snapshots are sorted by name.
    return datetime.datetime.now().strftime("%Y%m%d%H%M%S")


@dataclass(frozen=True)
class SnapshotLayout:
    """``<root>/<snapshot>/data/<kind>/<file>`` and ``<root>/<snapshot>/models/<file>``."""

    root: str
    snapshot: str = field(default_factory=_now)

    def data(self, kind: str, file: str | None = None) -> str:
        return f"{self.root}/{self.snapshot}/data/{kind}/{file or kind + '.parquet'}"

    def model(self, file: str) -> str:
        return f"{self.root}/{self.snapshot}/models/{file}"


def refuse_existing(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise before any work when one of the paths is already there, in whatever store Spark reads."""
    for path in paths:
        try:
            spark.read.text(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            raise FileExistsError(f"{path} already exists")


def write_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def read_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.select("metric", F.col("value").cast("double")).write.mode("errorifexists").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def write_index(index: DataFrame, path: str) -> None:
    write_dataset(index.select([F.col(f.name).cast(f.dataType) for f in INDEX]), path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return read_dataset(spark, path, INDEX)
