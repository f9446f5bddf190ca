"""The three datasets, and the job that prepares them into one snapshot."""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import SequenceConfig
from marquee.functions import in_hash_sample
from marquee.operators.features import features, required_id
from marquee.operators.ratings import rated_movies, rating_base, usable_ratings
from marquee.operators.sequences import (
    TIME, Sequences, expand, is_latest, rating_sequences, with_min_history,
)
from marquee.session import materialise, scratch_scope
from marquee.sources.commits import writing
from marquee.sources.snapshots import SnapshotLayout

ROW_KEY = ("rating_id", "matched_rating_id")


def sequences_of(
    ratings: DataFrame, movies: DataFrame, config: SequenceConfig, latest_only: bool = False,
    medians: DataFrame | None = None, carry: bool = False,
) -> Sequences:
    base = rating_base(ratings, movies, config.include_unrated, medians)
    return rating_sequences(base, config, latest_only, usable_ratings(ratings, config.include_unrated), carry)


def train_rows(sequences: Sequences) -> DataFrame:
    return with_min_history(expand(sequences, "train"), sequences.config.min_history)


def sampled_train_rows(sequences: Sequences) -> DataFrame:
    """A time-keyed sample in place of the history filter, taken before the fan-out."""
    return expand(sequences, "train", keep=in_hash_sample(F.col(TIME)))


def inference_rows(sequences: Sequences, one_per_user: bool = False) -> DataFrame:
    """History rows at each user's last time; several where times tie or the movie was rated before."""
    rows = expand(sequences, "inference", keep=is_latest(), last_only=one_per_user)
    return with_min_history(rows, sequences.config.min_history)


def train_dataset(
    ratings: DataFrame, movies: DataFrame, config: SequenceConfig = SequenceConfig(), keys: bool = False
) -> DataFrame:
    """Library variant. ``keys`` adds (rating_id, matched_rating_id), which identify a row."""
    ids = (*(ROW_KEY if keys else ()), "movie_id", "user_id")
    return features(train_rows(sequences_of(ratings, movies, config)), config, ids)


def sampled_train_dataset(
    ratings: DataFrame, movies: DataFrame, config: SequenceConfig, keys: bool = False
) -> DataFrame:
    """Hosted variant: sampled rows, and no user id."""
    ids = (*(ROW_KEY if keys else ()), "movie_id")
    return features(sampled_train_rows(sequences_of(ratings, movies, config)), config, ids)


def inference_dataset(
    ratings: DataFrame,
    movies: DataFrame,
    config: SequenceConfig = SequenceConfig(),
    keys: bool = False,
    one_per_user: bool = False,
) -> DataFrame:
    """Both variants: they differ in ``config`` only."""
    rows = inference_rows(sequences_of(ratings, movies, config, latest_only=True), one_per_user)
    return features(rows, config, (*(ROW_KEY if keys else ()), "user_id"))


def movie_catalogue(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    return rated_movies(ratings, movies).select(
        required_id("movie_id"), F.col("movie_title").cast("string").alias("movie_title")
    )


@dataclass(frozen=True)
class Prepared:
    paths: dict[str, str]
    seconds: float


KINDS = ("train", "inference", "movies")


def shared_sequences(
    ratings: DataFrame, movies: DataFrame, config: SequenceConfig, medians: DataFrame | None = None
) -> Sequences:
    """Sequences for both datasets: their base, gaps and contexts are written once, one row per rating.

    Each dataset is then read from that table as it lies. Only (user, movie) pairs of more ratings than a frame has are
    shuffled again, to gather their gaps: rows of shorter ones carry them.
    """
    sequences = sequences_of(ratings, movies, config, medians=medians, carry=True)
    return replace(sequences, ordinary=materialise(sequences.ordinary, "sequences"), stored=True)


def snapshot_rows(sequences: Sequences, config: SequenceConfig, keys: bool) -> dict[str, DataFrame]:
    """The train and the inference dataset of a snapshot."""
    row_key = ROW_KEY if keys else ()
    return {
        "train": features(train_rows(sequences), config, (*row_key, "movie_id", "user_id")),
        "inference": features(inference_rows(sequences), config, (*row_key, "user_id")),
    }


def prepare(
    ratings: DataFrame,
    movies: DataFrame,
    layout: SnapshotLayout,
    config: SequenceConfig = SequenceConfig(),
    keys: bool = False,
) -> Prepared:
    """Write train, inference and movies into one snapshot and commit it; an existing one is an error.

    ``plans.updates`` makes snapshots that can be carried forward.
    """
    start = time.monotonic()
    with writing(ratings.sparkSession, layout, "data", KINDS) as writer, scratch_scope(ratings.sparkSession):
        for kind, dataset in snapshot_rows(shared_sequences(ratings, movies, config), config, keys).items():
            writer.write(kind, dataset)
        writer.write("movies", movie_catalogue(ratings, movies))
    return Prepared(writer.tables, time.monotonic() - start)
