"""Input and output schemas, and the check that inputs carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAGS = ("user_eligible_for_trial", "user_has_payment_method", "user_subscriber", "user_trialist")

RATINGS = T.StructType(
    [
        T.StructField("rating_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("movie_id", T.LongType()),
        T.StructField("rating_timestamp_utc", T.TimestampNTZType()),
        T.StructField("rating_score", T.IntegerType()),
        *[T.StructField(flag, T.BooleanType()) for flag in FLAGS],
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movie_id", T.LongType()),
        T.StructField("movie_title", T.StringType()),
        T.StructField("movie_release_year", T.IntegerType()),
        T.StructField("movie_title_language", T.StringType()),
    ]
)

SEQUENCES = {
    "previous_movie_ids": T.ArrayType(T.IntegerType()),
    "previous_movie_years": T.ArrayType(T.FloatType()),
    "previous_score": T.ArrayType(T.FloatType()),
    "previous_days_since_last_rating": T.ArrayType(T.FloatType()),
}

INDEX = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("rating_id", T.LongType()),
        T.StructField("matched_rating_id", T.LongType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
    ]
)

METRICS = T.StructType([T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())])


def check_schema(df: DataFrame, expected: T.StructType, name: str) -> DataFrame:
    """Raise when a column is missing or has another type; extra columns are dropped.

    Times with a zone become the same instants in UTC without one, whatever the session's zone is.
    """
    have = {field.name: field.dataType for field in df.schema}
    problems = []
    for field in expected:
        if field.name not in have:
            problems.append(f"{field.name} is missing")
        elif have[field.name] != field.dataType and not _both_times(have[field.name], field.dataType):
            problems.append(f"{field.name} is {have[field.name].simpleString()}, "
                            f"not {field.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{name}: " + "; ".join(problems))
    return df.select(*[
        _in_utc(field.name).alias(field.name)
        if isinstance(have[field.name], T.TimestampType) and isinstance(field.dataType, T.TimestampNTZType)
        else field.name
        for field in expected
    ])


def _in_utc(column: str) -> Column:
    seconds = F.unix_micros(column).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    span = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + span


def _both_times(a: T.DataType, b: T.DataType) -> bool:
    times = (T.TimestampType, T.TimestampNTZType)
    return isinstance(a, times) and isinstance(b, times)
