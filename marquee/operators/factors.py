"""Item vectors from an implicit-feedback factor model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.split import SEED
from marquee.operators.vocabulary import build_vocabulary
from marquee.session import materialise, shared_dir

WIDTH = 32
#: Weight of a vector's length in the loss, times the number of its ratings.
PENALTY = 0.05


def rated_pairs(base: DataFrame) -> DataFrame:
    """(user_id, movie_id, times)"""
    known = base.where(F.col("user_id").isNotNull())
    return known.groupBy("user_id", "movie_id").agg(F.count(F.lit(1)).cast("float").alias("times"))


def fit_item_vectors(
    base: DataFrame, width: int = WIDTH, iterations: int = 10, seed: int = SEED, blocks: int | None = None
) -> DataFrame:
    """(movie_id, vector) for every movie in ``base`` (user_id, movie_id, ..).

    Ratings shrink to one row per (user, movie) with its count before anything else, so a user or movie
    that was rated over and over is no larger than its distinct partners. Ids are numbered densely
    because the model takes 32-bit ids. ``blocks`` defaults to the shuffle partitions, so that the model's
    own partitions grow with the cluster's setting.
    """
    shared_dir(base.sparkSession)  # the model cuts its lineage in the checkpoint folder
    if blocks is None:
        blocks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = materialise(rated_pairs(base), "pairs")
    users, movies = build_vocabulary(pairs, "user_id"), build_vocabulary(pairs, "movie_id")
    numbered = pairs.join(users.withColumnRenamed("index", "user"), "user_id").join(
        movies.withColumnRenamed("index", "item"), "movie_id"
    )
    numbered = numbered.select(F.col("user").cast("int"), F.col("item").cast("int"), "times")
    als = ALS(
        rank=width, maxIter=iterations, implicitPrefs=True, seed=seed, regParam=PENALTY,
        userCol="user", itemCol="item", ratingCol="times", numUserBlocks=blocks, numItemBlocks=blocks,
    )
    factors = als.fit(numbered).itemFactors
    return factors.join(movies, factors["id"] == movies["index"]).select(
        "movie_id", F.col("features").alias("vector")
    )


def implicit_losses(pairs: DataFrame, vectors: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """(users, loss): partial sums of the factor model's loss at these item vectors and the best user vectors for them.

    A user and movie with a rating should score 1, with a weight of 1 plus the times it was rated; all others should
    score 0, with a weight of 1. For given item vectors a user's best vector solves one small system, whose sums are
    gathered while the user's pairs pass in order: a task holds a system, however many pairs a user has.
    """
    width = vectors.select(F.max(F.size("vector"))).first()[0] or 0
    square = sum((np.array(r["sums"]).reshape(width, width) for r in _squares(vectors, width).collect()), np.zeros((width, width)))

    def losses(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        user, users, loss = None, 0, 0.0
        system, right, weight, n = square.copy(), np.zeros(width), 0.0, 0

        def best() -> float:
            x = np.linalg.solve(system + penalty * n * np.eye(width), right)
            return weight - float(right @ x)  # the loss at its minimum

        for frame in frames:
            items = np.stack(frame["vector"].to_numpy()).astype(np.float64) if len(frame) else None
            for own, rows in frame.groupby("user_id", sort=False).indices.items():
                if own != user:
                    if user is not None:
                        users, loss = users + 1, loss + best()
                    user, system, right, weight, n = own, square.copy(), np.zeros(width), 0.0, 0
                times, y = frame["times"].to_numpy()[rows].astype(np.float64), items[rows]
                system += (y * times[:, None]).T @ y
                right = right + ((1 + times)[:, None] * y).sum(axis=0)
                weight, n = weight + float((1 + times).sum()), n + len(rows)
        if user is not None:
            users, loss = users + 1, loss + best()
        yield pd.DataFrame({"users": [users], "loss": [loss]})

    rows = pairs.join(vectors.select("movie_id", "vector"), "movie_id").select("user_id", "times", "vector")
    return rows.repartition("user_id").sortWithinPartitions("user_id").mapInPandas(losses, "users long, loss double")


def _squares(vectors: DataFrame, width: int) -> DataFrame:
    """Sums of outer products, one row for each task."""

    def outer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            if len(frame):
                y = np.stack(frame["vector"].to_numpy()).astype(np.float64)
                total += y.T @ y
        yield pd.DataFrame({"sums": [total.ravel()]})

    return vectors.select("vector").mapInPandas(outer, "sums array<double>")
