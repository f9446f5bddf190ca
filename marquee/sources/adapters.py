"""Ratings and movies as views over the shared test tables (``events``, ``part``, ``embeddings``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.schemas import MOVIES, RATINGS, check_schema


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind, value = F.col("event_type"), F.col("value")

    def flag(true: Column, null: Column) -> Column:
        return F.when(true, True).when(null, None).otherwise(False)

    view = events.select(
        F.col("event_id").alias("rating_id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("movie_id"),
        F.col("ts").alias("rating_timestamp_utc"),
        F.when(kind != "error", (F.col("event_id") % 5 + 1).cast("int")).alias("rating_score"),
        flag(kind == "signup", kind == "error").alias("user_eligible_for_trial"),
        flag(value >= 50, value < 5).alias("user_has_payment_method"),
        flag(kind == "purchase", kind == "view").alias("user_subscriber"),
        flag(kind == "click", kind == "signup").alias("user_trialist"),
    )
    return check_schema(view, RATINGS, "ratings view")


def movies_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    view = part.select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("movie_title"),
        F.when(F.col("p_type") == "PROMO", None).otherwise(F.col("p_size") + 1900).cast("int")
        .alias("movie_release_year"),
        F.when(F.col("p_size") % 2 == 0, F.lit("en")).alias("movie_title_language"),
    )
    return check_schema(view, MOVIES, "movies view")


def vectors_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-made item vectors, one per movie id, for retrieval without a fitted model."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embeddings.select(F.col("vec_id").alias("movie_id"), F.col("embedding").alias("vector"))
