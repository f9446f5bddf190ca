"""The training job of a snapshot: split, fit on the rest, evaluate on what was held out, store the index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.operators.factors import WIDTH, fit_item_vectors
from marquee.operators.split import SEED, find_cut
from marquee.plans.audience import audience_index, evaluate
from marquee.plans.datasets import ROW_KEY
from marquee.session import materialise, scratch_scope
from marquee.sources.commits import open_part, writing
from marquee.sources.snapshots import (
    SnapshotLayout, read_dataset, read_metrics, refuse_existing, write_dataset, write_index, write_metrics,
)


def fit_on_rest(
    train: DataFrame, n_holdout: int, width: int = WIDTH, iterations: int = 10, seed: int = SEED
) -> DataFrame:
    """Stored item vectors learned from the rows of ``train`` (with row keys) that are not held out.

    What a held-out row says reaches the fit only through other rows: copies of a re-rated movie are rows of
    their own.
    """
    rest = train.where(~find_cut(train, ROW_KEY, n_holdout, seed).held_out)
    return materialise(fit_item_vectors(rest, width, iterations, seed), "vectors")


def evaluate_held_out(
    train: DataFrame, n_holdout: int = 10_000, k: int = 100, batch_size: int = 10_000, width: int = WIDTH,
    iterations: int = 10, seed: int = SEED, pad_side: str = "post",
) -> DataFrame:
    """(metric, value) on held-out rows of a model that did not learn from them."""
    vectors = fit_on_rest(train, n_holdout, width, iterations, seed)
    return evaluate(train, vectors, n_holdout, k, batch_size, width, seed, pad_side)


@dataclass(frozen=True)
class Trained:
    vectors: str
    metrics: str
    index: str


def train_snapshot(
    spark: SparkSession, layout: SnapshotLayout, n_holdout: int = 10_000, k: int = 100, batch_size: int = 10_000,
    width: int = WIDTH, iterations: int = 10, seed: int = SEED, pad_side: str = "post", recency: float = 1.0,
) -> Trained:
    """Fit, evaluate and index a committed snapshot (with row keys) into its ``models`` folder, and commit that."""
    paths = Trained(layout.model("vectors.parquet"), layout.model("metrics.json"), layout.model("index.parquet"))
    data = open_part(spark, layout)
    refuse_existing(spark, (paths.vectors, paths.metrics, paths.index))
    with writing(spark, layout, "models") as writer, scratch_scope(spark):
        train = data.read("train")
        write_dataset(fit_on_rest(train, n_holdout, width, iterations, seed), writer.add("vectors", paths.vectors))
        vectors = read_dataset(spark, paths.vectors)
        write_metrics(evaluate(train, vectors, n_holdout, k, batch_size, width, seed, pad_side), paths.metrics)
        write_index(
            audience_index(data.read("inference"), vectors, width, pad_side, recency), writer.add("index", paths.index)
        )
        writer.details["metrics"] = {row["metric"]: row["value"] for row in read_metrics(spark, paths.metrics).collect()}
    return paths
