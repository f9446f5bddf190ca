"""Padded feature columns, the shape in which the datasets are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.config import SequenceConfig
from marquee.functions import newest, pad
from marquee.sources.schemas import FLAGS

# Feature, history field, element type, pad value.
SEQUENCE_FEATURES = (
    ("previous_movie_ids", "movie_id", "int", 0),
    ("previous_movie_years", "movie_release_year", "float", 1980.0),
    ("previous_score", "rating_value", "float", 2.5),
    ("previous_days_since_last_rating", "shifted_days", "float", 0.0),
)


def sequence_columns(config: SequenceConfig) -> list[Column]:
    columns = []
    for name, field, kind, fill in SEQUENCE_FEATURES:
        values = F.col(f"history.{field}").cast(f"array<{kind}>")
        if config.frame_len > config.seq_length:
            values = newest(values, config.seq_length)
        columns.append(pad(values, config.seq_length, F.lit(fill).cast(kind), config.pad_side).alias(name))
    columns.append(F.least("history_len", F.lit(config.seq_length)).alias("history_len"))
    return columns


def required_id(name: str) -> Column:
    """An id as long; a null id is an error."""
    value = F.col(name).cast("long")
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"{name} is null"))).alias(name)


def features(rows: DataFrame, config: SequenceConfig, ids: tuple[str, ...]) -> DataFrame:
    """The id columns, the flags as 0 or 1, the padded sequences and the true history length."""
    return rows.select(
        *[required_id(name) for name in ids],
        *[F.col(flag).cast("long").alias(flag) for flag in FLAGS],
        *sequence_columns(config),
    )
