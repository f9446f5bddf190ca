"""Snapshots that are carried forward: new ratings rebuild the users they touch and keep the rows of all others.

Beside its datasets such a snapshot keeps a state: its own ratings, the movies, and how often each movie got each score.
An update reads the state and the new ratings, and finds the users whose rows may change:

* users with a new rating. A shifted gap follows the order of all gaps of its user and a copy stands for each rating of
  a movie, so one rating may change any row of its user, but none of another user;
* users who rated a movie that was added, removed or described anew;
* with ``include_unrated``, users with an unscored rating of a movie whose median moved. Medians come from the counts.

Rows of the other users are copied from the datasets before, without a sort or a join but the filter itself. Each state
holds only what its snapshot added, and names those before it, so ratings are written once.

The ratings of an update are added to those before: corrected ratings need a snapshot of their own.
"""

from __future__ import annotations

import time
from dataclasses import asdict, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.config import SequenceConfig
from marquee.operators.skew import join_counted
from marquee.plans.datasets import KINDS, Prepared, shared_sequences, snapshot_rows
from marquee.session import materialise, scratch_scope
from marquee.sources.commits import Committed, Writer, open_part, writing
from marquee.sources.schemas import MOVIES, RATINGS
from marquee.sources.snapshots import SnapshotLayout, read_dataset

#: Folders of a state's ratings, by a hash of the user.
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).cast("int")


def score_counts(ratings: DataFrame) -> DataFrame:
    """(movie_id, rating_score, n); unscored ratings have a count of their own, so every rated movie is in it."""
    return ratings.groupBy("movie_id", "rating_score").agg(F.count(F.lit(1)).alias("n"))


def medians_of(counts: DataFrame) -> DataFrame:
    """(movie_id, median_score): the discrete median, the first score that half of the ratings do not exceed."""
    scored = counts.where("rating_score is not null")
    movie = Window.partitionBy("movie_id")
    upto = F.sum("n").over(movie.orderBy("rating_score"))
    placed = scored.select("movie_id", "rating_score", upto.alias("upto"), F.sum("n").over(movie).alias("all"))
    reached = placed.where(F.col("upto") * 2 >= F.col("all"))
    return reached.groupBy("movie_id").agg(F.min("rating_score").alias("median_score"))


def rated_lines(counts: DataFrame, movies: DataFrame) -> DataFrame:
    """The lines of movies with a rating, stored: their size, not that of the whole list, says how ratings are joined to them."""
    return materialise(movies.join(counts.select("movie_id").distinct(), "movie_id", "left_semi"), "rated")


def catalogue_of(rated: DataFrame) -> DataFrame:
    listed = rated.select("movie_id", "movie_title").distinct()
    return listed.select("movie_id", F.col("movie_title").cast("string").alias("movie_title"))


def _write_ratings(writer: Writer, added: DataFrame) -> None:
    stored = added.select(*RATINGS.names, _bucket().alias("bucket"))
    if added.isEmpty():  # folders of buckets would leave no schema
        writer.write("ratings", stored)
    else:
        path = writer.add("ratings", writer.path("ratings"))
        ordered = stored.repartition("bucket").sortWithinPartitions("bucket", "user_id")
        ordered.write.mode("errorifexists").partitionBy("bucket").parquet(path)


def _write_state(writer: Writer, movies: DataFrame, counts: DataFrame, before: list[str]) -> None:
    writer.write("movies", movies.select(MOVIES.names))
    writer.write("scores", counts)
    writer.details["ratings"] = [*before, writer.layout.snapshot]


def _details(config: SequenceConfig, keys: bool) -> dict:
    return {"config": asdict(replace(config, skew=SequenceConfig().skew)), "keys": keys}


def prepare_carried(
    ratings: DataFrame, movies: DataFrame, layout: SnapshotLayout, config: SequenceConfig = SequenceConfig(), keys: bool = False
) -> Prepared:
    """As ``plans.datasets.prepare``, with the state that updates need. ``ratings`` are read once: the rest reads the state."""
    start, spark = time.monotonic(), ratings.sparkSession
    with writing(spark, layout, "state", ("ratings", "movies", "scores")) as writer, scratch_scope(spark):
        _write_ratings(writer, ratings)
        _write_state(writer, movies, score_counts(read_dataset(spark, writer.path("ratings"))), [])
    with writing(spark, layout, "data", KINDS) as writer, scratch_scope(spark):
        state = open_part(spark, layout, "state")
        ratings, counts = state.read("ratings").drop("bucket"), state.read("scores")
        medians = materialise(medians_of(counts), "medians") if config.include_unrated else None
        rated = rated_lines(counts, movies)
        for kind, dataset in snapshot_rows(shared_sequences(ratings, rated, config, medians), config, keys).items():
            writer.write(kind, dataset)
        writer.write("movies", catalogue_of(rated))
        writer.details.update(_details(config, keys))
    return Prepared(writer.tables, time.monotonic() - start)


def carried_ratings(spark: SparkSession, layout: SnapshotLayout, state: Committed) -> DataFrame:
    """(.., bucket): all ratings of a snapshot, from its own state and those before it."""
    rows = None
    for name in state.details["ratings"]:
        own = state if name == layout.snapshot else open_part(spark, replace(layout, snapshot=name), "state")
        part = own.read("ratings")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _changed_movies(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids whose lines differ, counting repeated lines. Both lists are grouped once."""
    one, other = (x.select(*MOVIES.names, F.lit(n).alias("n")) for x, n in ((before, 1), (after, -1)))
    lines = one.unionByName(other).groupBy(MOVIES.names).agg(F.sum("n").alias("n"))
    return lines.where("n <> 0").select("movie_id").distinct()


def touched_users(
    ratings: DataFrame, added: DataFrame, changed: DataFrame, moved: DataFrame | None, config: SequenceConfig
) -> DataFrame:
    """(user_id) whose rows may change. ``ratings`` are those before; movies are joined by counted size."""
    users = added.select("user_id")
    for movies, rows in ((changed, ratings), (moved, ratings.where("rating_score is null"))):
        if movies is not None:
            movies = materialise(movies, "movies")
            n = movies.count()
            if n:
                users = users.union(join_counted(rows, movies, "movie_id", "left_semi", n, config.skew).select("user_id"))
    return users.where("user_id is not null").distinct()


def update(
    spark: SparkSession,
    before: SnapshotLayout,
    after: SnapshotLayout,
    added: DataFrame,
    movies: DataFrame,
    config: SequenceConfig = SequenceConfig(),
    keys: bool = False,
) -> Prepared:
    """Commit ``after``: the snapshot of the ratings of ``before`` together with the ``added`` ones, and of ``movies``.

    Both have to be made with the same ``config`` and ``keys``; bounds of the skew policy may differ.
    """
    start = time.monotonic()
    old, state = open_part(spark, before), open_part(spark, before, "state")
    if _details(config, keys) != old.details:
        raise ValueError("a snapshot is carried forward with the settings it was made with")
    with (
        writing(spark, after, "data", KINDS) as writer,  # committed after the state
        writing(spark, after, "state", ("ratings", "movies", "scores")) as new_state,
        scratch_scope(spark),
    ):
        added = materialise(added.select(RATINGS.names), "added")
        old_counts = state.read("scores")
        merged = old_counts.unionByName(score_counts(added)).groupBy("movie_id", "rating_score").agg(F.sum("n").alias("n"))
        counts = materialise(merged, "scores")
        medians = moved = None
        if config.include_unrated:
            medians = materialise(medians_of(counts), "medians")
            was = medians_of(old_counts).withColumnRenamed("median_score", "was")
            both = medians.join(was, "movie_id", "full")
            moved = both.where(~F.col("median_score").eqNullSafe(F.col("was"))).select("movie_id")
        ratings = carried_ratings(spark, before, state)
        users = touched_users(ratings, added, _changed_movies(state.read("movies"), movies), moved, config)
        users = materialise(users, "users")
        n_users = users.count()
        buckets = [row["bucket"] for row in users.select(_bucket().alias("bucket")).distinct().collect()]  # at most BUCKETS
        theirs = join_counted(
            ratings.where(F.col("bucket").isin(buckets)).drop("bucket"), users, "user_id", "left_semi", n_users, config.skew
        )
        rated = rated_lines(counts, movies)
        rebuilt = shared_sequences(theirs.unionByName(added), rated, config, medians)
        for kind, rows in snapshot_rows(rebuilt, config, keys).items():
            kept = join_counted(old.read(kind), users, "user_id", "left_anti", n_users, config.skew)
            writer.write(kind, kept.select(rows.columns).unionByName(rows))
        writer.write("movies", catalogue_of(rated))
        writer.details.update(_details(config, keys))
        _write_ratings(new_state, added)
        _write_state(new_state, movies, counts, state.details["ratings"])
    return Prepared(writer.tables, time.monotonic() - start)
