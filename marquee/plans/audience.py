"""Audience retrieval: the index of users, the best users for a movie, and how good they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.factors import WIDTH
from marquee.operators.pruned_index import PrunedIndex, top_k_pruned
from marquee.operators.retrieval import (
    history_vectors, lookup_vectors, score, softmax_losses, top_k, top_k_accuracy, true_pair_ranks,
)
from marquee.operators.split import SEED, find_cut, with_shuffle_position
from marquee.plans.datasets import ROW_KEY
from marquee.session import materialise

INDEX_KEY = ("user_id", *ROW_KEY)


def audience_index(
    inference: DataFrame, vectors: DataFrame, width: int = WIDTH, pad_side: str = "post", recency: float = 1.0
) -> DataFrame:
    """(user_id, rating_id, matched_rating_id, vector): one vector per inference row, written with its keys."""
    return history_vectors(inference, vectors, INDEX_KEY, width, recency=recency, pad_side=pad_side)


def best_users(movies: DataFrame, vectors: DataFrame, index: DataFrame | PrunedIndex, k: int = 10) -> DataFrame:
    """(movie_id, rank, user_id, score) for each distinct movie in ``movies`` that has a vector.

    ``unanswered_movies`` lists the others. ``index`` is read once; of one kept in blocks
    (``operators.pruned_index``) only the blocks that matter are.
    """
    queries = lookup_vectors(movies.select("movie_id").distinct(), vectors)
    return top_k_pruned(queries, index, k).best if isinstance(index, PrunedIndex) else top_k(queries, index, k)


def unanswered_movies(movies: DataFrame, vectors: DataFrame) -> DataFrame:
    """The movies that ``best_users`` has no answer for, because the model never saw them."""
    return movies.select("movie_id").distinct().join(vectors.select("movie_id"), "movie_id", "left_anti")


def scored_pairs(
    train: DataFrame, vectors: DataFrame, width: int, pad_side: str = "post", recency: float = 1.0
) -> DataFrame:
    """(row key, movie_id, query, vector, score) per training row: its movie against its own history.

    A movie without a vector scores 0 everywhere, so that no row is lost.
    """
    encoded = history_vectors(train, vectors, ROW_KEY, width, ("movie_id",), recency, pad_side, with_query=True)
    return encoded.select(*ROW_KEY, "movie_id", "query", "vector", score().alias("score"))


def evaluate(
    train: DataFrame,
    vectors: DataFrame,
    n_holdout: int = 10_000,
    k: int = 100,
    batch_size: int = 10_000,
    width: int = WIDTH,
    seed: int = SEED,
    pad_side: str = "post",
) -> DataFrame:
    """(metric, value): top-k accuracy and in-batch loss on the held-out rows.

    ``train`` is a stored training dataset with row keys, ``vectors`` what was learned from its other rows
    (``plans.training.fit_on_rest`` with the same ``n_holdout`` and ``seed``). Candidates are all its rows, held out or not;
    they are encoded and scored in one pass over it, and only the held-out rows are stored with vectors.
    """
    cut = find_cut(train, ROW_KEY, n_holdout, seed)
    held = materialise(scored_pairs(train.where(cut.held_out), vectors, width, pad_side), "held")
    candidates = history_vectors(train, vectors, ROW_KEY, width, pad_side=pad_side)
    accuracy = top_k_accuracy(true_pair_ranks(held, candidates, ROW_KEY), k)
    placed = with_shuffle_position(held, ROW_KEY, seed).withColumnRenamed("shuffle_position", "position")
    loss = softmax_losses(placed, batch_size).agg(
        F.sum("loss").alias("loss"), F.count(F.lit(1)).alias("batches")
    )
    return _as_metrics(accuracy, [(f"top_{k}_accuracy", "accuracy"), ("rows", "rows")]).unionByName(
        _as_metrics(loss, [("loss", "loss"), ("batches", "batches")])
    )


def _as_metrics(one_row: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    entries = [
        F.struct(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))
        for name, column in names
    ]
    return one_row.select(F.inline(F.array(*entries)))
