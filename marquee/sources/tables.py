"""Source tables, chosen by dataset name at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.sources.schemas import MOVIES, RATINGS, check_schema


def read_table(spark: SparkSession, dataset: str, table: str) -> DataFrame:
    """A catalogue table ``dataset.table``, or the parquet folder ``dataset/table`` when given a path."""
    if "/" in dataset:
        return spark.read.parquet(f"{dataset.rstrip('/')}/{table}")
    return spark.table(f"{dataset}.{table}")


def read_ratings(spark: SparkSession, dataset: str, table: str = "ratings") -> DataFrame:
    return check_schema(read_table(spark, dataset, table), RATINGS, table)


def read_movies(spark: SparkSession, dataset: str, table: str = "movies") -> DataFrame:
    return check_schema(read_table(spark, dataset, table), MOVIES, table)
