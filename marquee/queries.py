"""The queries checked against SQL, by operator. Each takes (spark, folder of the test tables).

Arrays are rendered as text and vectors as integers of a millionth, so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.config import SequenceConfig, hosted_variant
from marquee.functions import dot, in_hash_sample, newest, pad, sample_bucket
from marquee.operators.batches import map_batches
from marquee.operators.factors import WIDTH as WIDTH_FITTED
from marquee.operators.factors import fit_item_vectors, implicit_losses, rated_pairs
from marquee.operators.pruned_index import BlockPolicy, read_pruned_index, top_k_pruned, write_pruned_index
from marquee.operators.ratings import movie_medians, rating_base
from marquee.operators.retrieval import (
    history_vectors, lookup_vectors, score, softmax_losses, top_k, top_k_accuracy, true_pair_ranks,
)
from marquee.operators.sequences import (
    LAST, TIME, Sequences, expand, fanout_report, is_latest, rating_gaps, with_min_history,
)
from marquee.operators.split import find_cut, hold_out, shuffled_within, with_shuffle_position
from marquee.operators.vocabulary import build_vocabulary, encode_history, encode_ids
from marquee.plans import audience, datasets, training, updates
from marquee.plans.datasets import ROW_KEY
from marquee.session import materialise, scratch_path, ship_package, store
from marquee.sources import (
    SnapshotLayout, read_dataset, read_index, read_metrics, read_movies, read_ratings, write_dataset, write_index, write_metrics,
)
from marquee.sources.adapters import movies_view, ratings_view, vectors_view
from marquee.sources.batches import read_batches
from marquee.sources.commits import open_part
from marquee.sources.schemas import FLAGS, SEQUENCES

WIDTH = 64  # of the ready-made vectors
HELD_OUT = 1_000
BATCH = 250
LIBRARY = SequenceConfig()
HOSTED = hosted_variant()
# The road of oversized users, taken by about half of the users in the small tables.
SEGMENTED = LIBRARY.with_skew(max_group_rows=50, segment_rows=30, pair_rows=2)


def text(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def millionths(vector: Column) -> Column:
    return text(F.transform(vector, lambda x: F.round(x * 1e6).cast("long")))


def rendered(df: DataFrame) -> DataFrame:
    """A dataset with its sequences as text."""
    return df.select(
        *[text(F.col(f"`{c}`")).alias(c) if c in SEQUENCES else F.col(c).cast("long").alias(c)
          for c in df.columns]
    )


class Inputs:
    """The views over one folder, read when first asked for, and what several queries build from them."""

    def __init__(self, spark: SparkSession, folder: str):
        ship_package(spark)
        self.spark, self.folder = spark, folder

    @cached_property
    def ratings(self) -> DataFrame:
        return ratings_view(self.spark, self.folder)

    @cached_property
    def movies(self) -> DataFrame:
        return movies_view(self.spark, self.folder)

    @cached_property
    def vectors(self) -> DataFrame:
        return vectors_view(self.spark, self.folder)

    @cached_property
    def repeated_movies(self) -> DataFrame:
        """Every fifth movie listed twice, under another title and year."""
        again = self.movies.where(F.col("movie_id") % 5 == 0).withColumns({
            "movie_title": F.concat("movie_title", F.lit(" again")),
            "movie_release_year": F.col("movie_release_year") + 1,
        })
        return self.movies.unionByName(again)

    def base(self, include_unrated: bool = False) -> DataFrame:
        return rating_base(self.ratings, self.movies, include_unrated)

    def sequences(self, config: SequenceConfig = LIBRARY, latest_only: bool = False) -> Sequences:
        return datasets.sequences_of(self.ratings, self.movies, config, latest_only)

    def histories(self, frame: str, config: SequenceConfig = LIBRARY) -> DataFrame:
        return expand(self.sequences(config), frame)

    def train(self, config: SequenceConfig = LIBRARY) -> DataFrame:
        """The keyed training dataset, stored as it would be in a snapshot."""
        return materialise(datasets.train_dataset(self.ratings, self.movies, config, keys=True), "train")

    def inference(self) -> DataFrame:
        return datasets.inference_dataset(self.ratings, self.movies, LIBRARY, keys=True)

    def index(self) -> DataFrame:
        built = audience.audience_index(self.inference(), self.vectors, WIDTH)
        return materialise(built, "index")

    def queries(self) -> DataFrame:
        return lookup_vectors(datasets.movie_catalogue(self.ratings, self.movies), self.vectors)


def ratings_base(x: Inputs) -> DataFrame:
    return x.base().select(
        "rating_id", "user_id", "movie_id", TIME, F.col("rating_score").cast("long").alias("rating_score"),
        *[F.col(flag).cast("long").alias(flag) for flag in FLAGS],
        "movie_title", F.col("rating_value").cast("long").alias("rating_value"),
        F.col("movie_release_year").cast("long").alias("movie_release_year"), "movie_title_language",
    )


def median_impute(x: Inputs) -> DataFrame:
    return x.base(include_unrated=True).select(
        "rating_id", "movie_id", F.col("rating_value").cast("long").alias("rating_value")
    )


def movie_median(x: Inputs) -> DataFrame:
    return movie_medians(x.ratings).select("movie_id", F.col("median_score").cast("long").alias("median_score"))


def gaps(x: Inputs, config: SequenceConfig, *columns: str) -> DataFrame:
    return rating_gaps(x.sequences(config)).select("rating_id", "user_id", *columns)


def gap_join(x: Inputs, config: SequenceConfig) -> DataFrame:
    return x.histories("train", config).select(
        "rating_id", "matched_rating_id", "user_id", "movie_id", "shifted_days"
    )


def history(rows: DataFrame) -> DataFrame:
    return rows.select(
        "rating_id", "matched_rating_id", "user_id", "movie_id",
        F.col("history_len").cast("long").alias("history_len"),
        text(F.col("history.movie_id")).alias("ids"),
        text(F.col("history.movie_release_year")).alias("years"),
        text(F.col("history.rating_value")).alias("scores"),
        text(F.col("history.shifted_days")).alias("gaps"),
    )


def repeated(x: Inputs, config: SequenceConfig, latest_only: bool = False) -> Sequences:
    return datasets.sequences_of(x.ratings, x.repeated_movies, config, latest_only)


def repeated_latest(x: Inputs, config: SequenceConfig) -> DataFrame:
    return history(expand(repeated(x, config, latest_only=True), "inference", keep=is_latest()))


def history_latest(x: Inputs) -> DataFrame:
    return history(expand(x.sequences(latest_only=True), "inference", keep=is_latest()))


def padded(x: Inputs, side: str, n: int = 10) -> DataFrame:
    rows = x.histories("train")
    ids = newest(F.col("history.movie_id"), n)
    return rows.select(
        *ROW_KEY, text(pad(ids, n, F.lit(0).cast("long"), side).cast("array<int>")).alias("ids")
    )


def hash_sample(x: Inputs) -> DataFrame:
    rows = x.base().where(in_hash_sample(F.col(TIME)))
    return rows.select("rating_id", "user_id", sample_bucket(F.col(TIME)).alias("bucket"))


def seeded_shuffle(x: Inputs) -> DataFrame:
    return with_shuffle_position(x.train().select(*ROW_KEY), ROW_KEY).select(*ROW_KEY, "shuffle_position")


def split_part(x: Inputs, part: int) -> DataFrame:
    return hold_out(x.train(), ROW_KEY, HELD_OUT)[part].select(*ROW_KEY, "movie_id", "user_id")


def dataset_counts(x: Inputs) -> DataFrame:
    parts = {
        "train": datasets.train_dataset(x.ratings, x.movies),
        "inference": datasets.inference_dataset(x.ratings, x.movies),
        "movies": datasets.movie_catalogue(x.ratings, x.movies),
    }
    counts = [df.agg(F.lit(kind).alias("dataset"), F.count(F.lit(1)).alias("n")) for kind, df in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def vocabulary(x: Inputs) -> DataFrame:
    return build_vocabulary(datasets.movie_catalogue(x.ratings, x.movies), "movie_id")


def encoded_ids(x: Inputs) -> DataFrame:
    """Every movie id against the vocabulary of rated ones: the others are unknown."""
    return encode_ids(x.movies.select("movie_id"), vocabulary(x), "movie_id")


def encoded_history(x: Inputs, **bounds: int) -> DataFrame:
    encoded = encode_history(x.train(), vocabulary(x), ROW_KEY, **bounds)
    return encoded.select(*ROW_KEY, text(F.col("previous_movie_ids")).alias("indices"))


def encoded_repeats(x: Inputs, **bounds: int) -> DataFrame:
    """Every row twice: rows that share their key stay two rows."""
    train = x.train()
    encoded = encode_history(train.unionByName(train), vocabulary(x), ROW_KEY, **bounds)
    return encoded.select(*ROW_KEY, text(F.col("previous_movie_ids")).alias("indices"))


def embedding_lookup(x: Inputs) -> DataFrame:
    rated = x.base().select("rating_id", "movie_id")
    return lookup_vectors(rated, x.vectors).select("rating_id", "movie_id", millionths(F.col("query")).alias("vector"))


def history_vector(x: Inputs, **options: float) -> DataFrame:
    encoded = history_vectors(x.train(), x.vectors, ROW_KEY, WIDTH, **options)
    return encoded.select(*ROW_KEY, millionths(F.col("vector")).alias("vector"))


def dot_scores(x: Inputs) -> DataFrame:
    return audience.scored_pairs(x.train(), x.vectors, WIDTH).select(*ROW_KEY, "movie_id", "score")


def topk_users(x: Inputs, **bounds: int) -> DataFrame:
    return top_k(x.queries(), x.index(), 10, **bounds)


def topk_users_pruned(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "pruned")
    write_pruned_index(x.index(), path, BlockPolicy(block_rows=100))
    return top_k_pruned(x.queries(), read_pruned_index(x.spark, path), 10).best


def held_out_pairs(x: Inputs) -> tuple[DataFrame, DataFrame]:
    """All candidates, and the held-out rows with their query and score."""
    train = x.train()
    cut = find_cut(train, ROW_KEY, HELD_OUT)
    held = materialise(audience.scored_pairs(train.where(cut.held_out), x.vectors, WIDTH), "held")
    return history_vectors(train, x.vectors, ROW_KEY, WIDTH), held


def topk_accuracy(x: Inputs) -> DataFrame:
    candidates, held = held_out_pairs(x)
    return top_k_accuracy(true_pair_ranks(held, candidates, ROW_KEY), 100).select(
        F.round("accuracy", 6).alias("accuracy"), "rows"
    )


def pair_ranks(x: Inputs) -> DataFrame:
    candidates, held = held_out_pairs(x)
    return true_pair_ranks(held, candidates, ROW_KEY)


def pair_ranks_blocked(x: Inputs) -> DataFrame:
    candidates, held = held_out_pairs(x)
    return true_pair_ranks(held, candidates, ROW_KEY, block_rows=700, lookup_bytes=0)


def softmax_loss(x: Inputs, batch: int = BATCH, **bounds: int) -> DataFrame:
    _, held = held_out_pairs(x)
    placed = with_shuffle_position(held, ROW_KEY).withColumnRenamed("shuffle_position", "position")
    return softmax_losses(placed, batch, **bounds).select("batch_id", "rows", F.round("loss", 6).alias("loss"))


def als_item_vectors(x: Inputs) -> DataFrame:
    """The fitted vectors, usable when their loss is well below that of the same vectors dealt to other movies.

    Vectors that say nothing about their movies, random ones for instance, lose nothing by being dealt anew.
    """
    fitted, pairs = materialise(fit_item_vectors(x.base()), "fitted"), materialise(rated_pairs(x.base()), "pairs")
    order = Window.orderBy("movie_id")
    dealt = fitted.withColumn("movie_id", F.coalesce(F.lead("movie_id").over(order), F.min("movie_id").over(Window.partitionBy())))
    loss, other = (implicit_losses(pairs, v).agg(F.sum("loss")).first()[0] for v in (fitted, materialise(dealt, "dealt")))
    usable = F.forall("vector", lambda v: ~F.isnan(v) & (F.abs(v) < 1e6)) & F.exists("vector", lambda v: v != 0)
    return fitted.select(
        "movie_id", F.size("vector").cast("long").alias("width"), (usable & F.lit(loss < 0.9 * other)).alias("usable")
    )


def stored_index(x: Inputs) -> tuple[DataFrame, DataFrame]:
    vectors = materialise(fit_item_vectors(x.base()), "vectors")
    path = scratch_path(x.spark, "index")
    write_index(audience.audience_index(x.inference(), vectors), path)
    return vectors, read_index(x.spark, path)


def audience_index(x: Inputs) -> DataFrame:
    """The index, and whether each vector is the mean that a join of histories with item vectors gives."""
    vectors, index = stored_index(x)
    plain = history_vectors(x.inference(), vectors, audience.INDEX_KEY, WIDTH_FITTED, lookup_bytes=0)
    both = index.join(plain.withColumnRenamed("vector", "plain"), list(audience.INDEX_KEY))
    close = F.forall(F.arrays_zip("vector", "plain"), lambda v: F.abs(v["vector"] - v["plain"]) < 1e-5)
    return both.select(*audience.INDEX_KEY, close.alias("agrees"))


def best_users(x: Inputs) -> DataFrame:
    """Ranks, and whether each score is that of an index row of its user and no more rows of the whole index are better.

    The better rows are counted by the road of pair ranks, which does not select any.
    """
    vectors, index = stored_index(x)
    best = materialise(audience.best_users(datasets.movie_catalogue(x.ratings, x.movies), vectors, index), "best")
    asked = lookup_vectors(best, vectors).withColumn("place", F.monotonically_increasing_id())
    asked = materialise(asked, "asked")
    better = true_pair_ranks(asked.drop("rank"), index, ("place",)).withColumnRenamed("rank", "counted")
    own = asked.join(index.select("user_id", "vector"), "user_id").withColumn("again", score())
    owned = own.groupBy("place").agg(F.bool_or(F.abs(F.col("again") - F.col("score")) < 1e-5).alias("owned"))
    return asked.join(better, "place").join(owned, "place").select(
        "movie_id", "rank", (F.col("owned") & (F.col("counted") <= F.col("rank"))).alias("agrees")
    )


def evaluation(x: Inputs) -> DataFrame:
    """Metrics of a model fitted on the rest, and whether counts and both scores come out again by other roads."""
    train = x.train()
    vectors = training.fit_on_rest(train, HELD_OUT)
    found = audience.evaluate(train, vectors, HELD_OUT, 100, BATCH)
    cut = find_cut(train, ROW_KEY, HELD_OUT)
    held = materialise(audience.scored_pairs(train.where(cut.held_out), vectors, WIDTH_FITTED), "held")
    candidates = history_vectors(train, vectors, ROW_KEY, WIDTH_FITTED, lookup_bytes=0)
    ranks = true_pair_ranks(held, candidates, ROW_KEY, block_rows=5_000, lookup_bytes=0)
    accuracy = top_k_accuracy(ranks, 100).select(F.lit("top_100_accuracy").alias("metric"), F.col("accuracy").alias("again"))
    placed = with_shuffle_position(held, ROW_KEY)
    batched = placed.withColumn("batch", F.floor(F.col("shuffle_position") / BATCH))
    pairs = batched.select("batch", *ROW_KEY, "query", dot(F.col("query"), F.col("vector")).alias("own")).join(
        batched.select("batch", F.col("vector").alias("other")), "batch"
    )
    exps = pairs.groupBy(*ROW_KEY, "own").agg(F.sum(F.exp(dot(F.col("query"), F.col("other")))).alias("e"))
    loss = exps.agg(F.sum(F.log("e") - F.col("own")).alias("again")).select(F.lit("loss").alias("metric"), "again")
    counts = batched.agg(F.count(F.lit(1)).cast("double").alias("rows"), F.countDistinct("batch").cast("double").alias("batches"))
    counts = counts.select(F.inline(F.array(*(
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("again")) for n in ("rows", "batches")
    ))))
    again = accuracy.unionByName(loss).unionByName(counts)
    return found.join(again, "metric").select(
        "metric", (F.abs(F.col("value") - F.col("again")) < 1e-6 * (1 + F.abs("again"))).alias("agrees")
    )


def index_roundtrip(x: Inputs) -> DataFrame:
    path = scratch_path(x.spark, "index")
    write_index(audience.audience_index(x.inference(), x.vectors, WIDTH), path)
    stored = read_index(x.spark, path)
    return stored.select("user_id", *ROW_KEY, F.size("vector").cast("long").alias("width"),
                         millionths(F.col("vector").cast("array<double>")).alias("vector"))


def trained_snapshot(x: Inputs) -> DataFrame:
    """What the training job leaves in a prepared snapshot: index rows and metrics, each compared with another road.

    A vector has to be the mean that a join of its history with the stored item vectors gives; metrics have to be those
    of an evaluation apart.
    """
    layout = SnapshotLayout(scratch_path(x.spark, "root"))
    datasets.prepare(x.ratings, x.movies, layout, keys=True)
    done = training.train_snapshot(x.spark, layout, HELD_OUT, 100, BATCH)
    data, models = open_part(x.spark, layout), open_part(x.spark, layout, "models")
    vectors = models.read("vectors")
    plain = history_vectors(data.read("inference"), vectors, audience.INDEX_KEY, WIDTH_FITTED, lookup_bytes=0)
    both = models.read("index").join(plain.withColumnRenamed("vector", "plain"), list(audience.INDEX_KEY))
    close = F.forall(F.arrays_zip("vector", "plain"), lambda v: F.abs(v["vector"] - v["plain"]) < 1e-5)
    index = both.select(F.lit("index").alias("part"), F.col("user_id").cast("string").alias("entry"), close.alias("agrees"))
    again = audience.evaluate(data.read("train"), vectors, HELD_OUT, 100, BATCH).withColumnRenamed("value", "again")
    metrics = read_metrics(x.spark, done.metrics).join(again, "metric")
    same = F.abs(F.col("value") - F.col("again")) < 1e-6 * (1 + F.abs("again"))
    return index.unionByName(metrics.select(F.lit("metric").alias("part"), F.col("metric").alias("entry"), same.alias("agrees")))


def source_tables(x: Inputs) -> DataFrame:
    """Ratings written as a dataset's table and read back by dataset name, types checked."""
    folder = scratch_path(x.spark, "raw")
    write_dataset(x.ratings, f"{folder}/ratings")
    write_dataset(x.movies, f"{folder}/movies")
    read = read_ratings(x.spark, folder).join(read_movies(x.spark, folder).select("movie_id"), "movie_id", "left_semi")
    return read.select("rating_id", "user_id", "movie_id", TIME, F.col("rating_score").cast("long").alias("rating_score"))


def refused_overwrite(x: Inputs) -> DataFrame:
    """The catalogue, whose second writing is refused and changes nothing."""
    path = scratch_path(x.spark, "catalogue")
    catalogue = datasets.movie_catalogue(x.ratings, x.movies)
    write_dataset(catalogue, path)
    refused = False
    try:
        write_dataset(catalogue.limit(1), path)
    except AnalysisException:
        refused = True
    return read_dataset(x.spark, path).select("movie_id", "movie_title", F.lit(refused).alias("refused"))


def snapshot_roundtrip(x: Inputs) -> DataFrame:
    layout = SnapshotLayout(scratch_path(x.spark, "root"))
    catalogue = datasets.movie_catalogue(x.ratings, x.movies)
    write_dataset(catalogue, layout.data("movies"))
    return read_dataset(x.spark, layout.data("movies"), catalogue.schema)


def prepared_snapshot(x: Inputs) -> DataFrame:
    """Rows as read back from a committed snapshot that holds all three datasets."""
    layout = SnapshotLayout(scratch_path(x.spark, "root"))
    datasets.prepare(x.ratings, x.movies, layout, keys=True)
    done = open_part(x.spark, layout)
    return in_one(done.read("train"), done.read("inference"))


def updated(x: Inputs, config: SequenceConfig) -> dict[str, DataFrame]:
    """The datasets of a snapshot of the first nine tenths of the time, carried forward by the last tenth, in two steps."""
    first, last = x.ratings.agg(F.min(TIME), F.max(TIME)).first()
    times = [F.lit(first + (last - first) * share).cast("timestamp_ntz") for share in (0.9, 0.95)]
    when = F.col(TIME)
    parts = [x.ratings.where(when < times[0]), x.ratings.where((when >= times[0]) & (when < times[1])), x.ratings.where(when >= times[1])]
    root = scratch_path(x.spark, "root")
    layouts = [SnapshotLayout(root, f"s{i}") for i in range(3)]
    updates.prepare_carried(parts[0], x.movies, layouts[0], config, keys=True)
    for old, new, part in zip(layouts, layouts[1:], parts[1:], strict=False):
        updates.update(x.spark, old, new, part, x.movies, config, keys=True)
    done = open_part(x.spark, layouts[-1])
    return {kind: done.read(kind) for kind in datasets.KINDS}


def updated_snapshot(x: Inputs) -> DataFrame:
    done = updated(x, LIBRARY)
    return in_one(done["train"], done["inference"])


def in_one(train: DataFrame, inference: DataFrame) -> DataFrame:
    parts = [
        rows.select(F.lit(kind).alias("dataset"), *ROW_KEY, "user_id", text(F.col("previous_movie_ids")).alias("ids"))
        for kind, rows in (("train", train), ("inference", inference))
    ]
    return parts[0].unionByName(parts[1])


def metrics_roundtrip(x: Inputs) -> DataFrame:
    report = fanout_report(x.base())
    names = ("ratings", "pairs", "largest_pair", "fanout_rows")
    entries = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    path = scratch_path(x.spark, "metrics")
    write_metrics(report.select(F.inline(F.array(*entries))), path)
    return read_metrics(x.spark, path)


def batched_read(x: Inputs) -> DataFrame:
    def newest_id(batch: pd.DataFrame) -> pd.DataFrame:
        ids = np.stack(batch["previous_movie_ids"].to_numpy())
        newest = ids[np.arange(len(ids)), batch["history_len"].to_numpy() - 1]
        return batch[list(ROW_KEY)].assign(newest_id=newest)

    schema = "rating_id long, matched_rating_id long, newest_id long"
    return map_batches(x.train(), newest_id, schema, batch_size=1_000)


def ordered_train(x: Inputs) -> str:
    """Path of the training dataset stored in the order of its keys, in several files."""
    return store(x.train().select(*ROW_KEY, "movie_id").repartitionByRange(5, *ROW_KEY).sortWithinPartitions(*ROW_KEY), "ordered")


def batch_rows(x: Inputs, first: int, batches: int | None) -> DataFrame:
    return read_batches(x.spark, ordered_train(x), BATCH, first, batches, columns=ROW_KEY)


def buffer_shuffle(x: Inputs) -> DataFrame:
    buffers = read_batches(x.spark, ordered_train(x), HELD_OUT, columns=ROW_KEY)
    return shuffled_within(buffers, HELD_OUT, ROW_KEY).select(*ROW_KEY, "shuffle_position")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "ratings_base": ratings_base,
    "movie_median": movie_median,
    "median_impute": median_impute,
    "rating_gaps": lambda x: gaps(x, LIBRARY, "days_since_last_rating"),
    "rating_gaps_elapsed": lambda x: gaps(x, SequenceConfig(gap_unit="elapsed"), "days_since_last_rating"),
    "last_rating": lambda x: gaps(x, LIBRARY, LAST),
    "shifted_gaps": lambda x: gaps(x, LIBRARY, "shifted_days"),
    "shifted_gaps_by_time": lambda x: gaps(x, SequenceConfig(gap_order="time"), "shifted_days"),
    "shifted_gaps_segmented": lambda x: gaps(x, SEGMENTED, "shifted_days"),
    "repeated_movies_gaps": lambda x: rating_gaps(repeated(x, LIBRARY)).select("rating_id", "user_id", "shifted_days"),
    "repeated_movies_gaps_segmented": lambda x: rating_gaps(repeated(x, SEGMENTED)).select(
        "rating_id", "user_id", "shifted_days"
    ),
    "repeated_movies_train": lambda x: history(expand(repeated(x, LIBRARY), "train")),
    "repeated_movies_train_segmented": lambda x: history(expand(repeated(x, SEGMENTED), "train")),
    "repeated_movies_by_rating": lambda x: history(expand(repeated(x, replace(LIBRARY, rerate="by_rating")), "train")),
    "repeated_movies_by_rating_segmented": lambda x: history(
        expand(repeated(x, replace(SEGMENTED, rerate="by_rating")), "train")
    ),
    "repeated_movies_inference": lambda x: repeated_latest(x, LIBRARY),
    "repeated_movies_inference_segmented": lambda x: repeated_latest(x, SEGMENTED),
    "gap_join": lambda x: gap_join(x, LIBRARY),
    "gap_join_by_rating": lambda x: gap_join(x, SequenceConfig(rerate="by_rating")),
    "fanout_report": lambda x: fanout_report(x.base()),
    "history_train": lambda x: history(x.histories("train")),
    "history_inference": lambda x: history(x.histories("inference")),
    "history_min": lambda x: history(with_min_history(x.histories("train"), 3)),
    "history_latest": history_latest,
    "pad_post": lambda x: padded(x, "post"),
    "pad_pre": lambda x: padded(x, "pre"),
    "truncate_newest": lambda x: padded(x, "post", 4),
    "train_dataset": lambda x: rendered(datasets.train_dataset(x.ratings, x.movies, LIBRARY, keys=True)),
    "train_dataset_segmented": lambda x: rendered(
        datasets.train_dataset(x.ratings, x.movies, SEGMENTED, keys=True)
    ),
    "train_dataset_by_rating": lambda x: rendered(
        datasets.train_dataset(x.ratings, x.movies, SequenceConfig(rerate="by_rating"), keys=True)
    ),
    "train_dataset_unrated": lambda x: rendered(
        datasets.train_dataset(x.ratings, x.movies, SequenceConfig(include_unrated=True), keys=True)
    ),
    "sampled_train_dataset": lambda x: rendered(
        datasets.sampled_train_dataset(x.ratings, x.movies, HOSTED, keys=True)
    ),
    "inference_dataset": lambda x: rendered(x.inference()),
    "inference_dataset_segmented": lambda x: rendered(
        datasets.inference_dataset(x.ratings, x.movies, SEGMENTED, keys=True)
    ),
    "inference_dataset_front_padded": lambda x: rendered(
        datasets.inference_dataset(x.ratings, x.movies, HOSTED, keys=True)
    ),
    "inference_one_per_user": lambda x: rendered(
        datasets.inference_dataset(x.ratings, x.movies, LIBRARY, keys=True, one_per_user=True)
    ),
    "inference_one_per_user_segmented": lambda x: rendered(
        datasets.inference_dataset(x.ratings, x.movies, SEGMENTED, keys=True, one_per_user=True)
    ),
    "movie_catalogue": lambda x: datasets.movie_catalogue(x.ratings, x.movies),
    "hash_sample": hash_sample,
    "seeded_shuffle": seeded_shuffle,
    "holdout": lambda x: split_part(x, 1),
    "train_rest": lambda x: split_part(x, 0),
    "dataset_counts": dataset_counts,
    "vocabulary": vocabulary,
    "encode_ids": encoded_ids,
    "encode_history": encoded_history,
    "encode_history_joined": lambda x: encoded_history(x, lookup_bytes=0),
    "encode_history_repeated_rows": encoded_repeats,
    "encode_history_repeated_rows_joined": lambda x: encoded_repeats(x, lookup_bytes=0),
    "embedding_lookup": embedding_lookup,
    "history_vector": history_vector,
    "history_vector_joined": lambda x: history_vector(x, lookup_bytes=0),
    "history_vector_recency": lambda x: history_vector(x, recency=0.5),
    "dot_scores": dot_scores,
    "topk_users": topk_users,
    "topk_users_blocked": lambda x: topk_users(x, block_rows=40, lookup_bytes=0),
    "topk_users_pruned": topk_users_pruned,
    "topk_accuracy": topk_accuracy,
    "pair_ranks": pair_ranks,
    "pair_ranks_blocked": pair_ranks_blocked,
    "softmax_loss": softmax_loss,
    "softmax_loss_whole": lambda x: softmax_loss(x, HELD_OUT, block_rows=70, lookup_bytes=0),
    "als_item_vectors": als_item_vectors,
    "audience_index": audience_index,
    "best_users": best_users,
    "evaluation": evaluation,
    "index_roundtrip": index_roundtrip,
    "trained_snapshot": trained_snapshot,
    "source_tables": source_tables,
    "refused_overwrite": refused_overwrite,
    "snapshot_roundtrip": snapshot_roundtrip,
    "prepared_snapshot": prepared_snapshot,
    "updated_snapshot": updated_snapshot,
    "updated_train_unrated": lambda x: rendered(updated(x, SequenceConfig(include_unrated=True))["train"]),
    "updated_inference": lambda x: rendered(updated(x, LIBRARY)["inference"]),
    "updated_catalogue": lambda x: updated(x, LIBRARY)["movies"],
    "metrics_roundtrip": metrics_roundtrip,
    "batched_read": batched_read,
    "taken_batches": lambda x: batch_rows(x, 0, 3),
    "one_batch": lambda x: batch_rows(x, 2, 1),
    "all_batches": lambda x: batch_rows(x, 0, None),
    "buffer_shuffle": buffer_shuffle,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _on_folder(build) for name, build in QUERIES.items()}


def _on_folder(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Inputs(spark, folder))
