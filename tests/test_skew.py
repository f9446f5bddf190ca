"""Oversized users take another road to the same rows."""

import compare
import pytest
from fixtures import day, movies, ratings
from pyspark.sql import functions as F

from marquee.config import SequenceConfig, SkewPolicy
from marquee.operators.ratings import rating_base
from marquee.operators.sequences import expand, fanout_report, rating_gaps, rating_sequences
from marquee.operators.skew import find_hot_keys, split_hot, with_positions
from marquee.plans import datasets
from marquee.sources.adapters import movies_view, ratings_view

CUT = {"max_group_rows": 60, "segment_rows": 11, "pair_rows": 2, "range_rows": 50}


def rows_of(df):
    return compare.spark_rows(df.withColumn("history", F.col("history").cast("string")))


@pytest.fixture(scope="module")
def base(spark, small):
    """A third of all ratings moved to one user, who also rates one movie very often."""
    moved = ratings_view(spark, small).withColumn(
        "user_id", F.when(F.col("rating_id") % 3 == 0, 1).otherwise(F.col("user_id"))
    )
    moved = moved.withColumn(
        "movie_id", F.when(F.col("rating_id") % 9 == 0, 5).otherwise(F.col("movie_id"))
    )
    return rating_base(moved, movies_view(spark, small)).persist()


@pytest.mark.parametrize("changes", [
    {}, {"gap_order": "time", "gap_unit": "elapsed", "seq_length": 4}, {"rerate": "by_rating"},
])
def test_same_histories(spark, base, changes):
    config = SequenceConfig(**changes)
    plain, cut = (rating_sequences(base, c) for c in (config, config.with_skew(**CUT)))
    assert plain.oversized is None and cut.oversized is not None
    assert 0 < cut.ordinary.count() < base.count()
    for frame in ("train", "inference"):
        assert rows_of(expand(plain, frame)) == rows_of(expand(cut, frame))
    assert compare.spark_rows(rating_gaps(plain)) == compare.spark_rows(rating_gaps(cut))


def test_same_datasets(spark, base):
    plain, cut = (rating_sequences(base, SequenceConfig().with_skew(**c), latest_only=True) for c in ({}, CUT))
    assert rows_of(datasets.inference_rows(plain)) == rows_of(datasets.inference_rows(cut))
    assert rows_of(datasets.inference_rows(plain, True)) == rows_of(datasets.inference_rows(cut, True))


def test_same_sample(spark, base):
    plain, cut = (rating_sequences(base, SequenceConfig().with_skew(**c)) for c in ({}, CUT))
    assert rows_of(datasets.sampled_train_rows(plain)) == rows_of(datasets.sampled_train_rows(cut))


def test_without_broadcast(spark, base):
    cut = SequenceConfig().with_skew(**CUT, broadcast_rows=0)
    assert rows_of(expand(rating_sequences(base, SequenceConfig()), "train")) == rows_of(
        expand(rating_sequences(base, cut), "train")
    )


def test_positions_do_not_depend_on_the_input(spark):
    rows = [(u, o) for u in range(3) for o in range(500 if u == 1 else 7)]
    df = spark.createDataFrame(rows, "u long, o long")
    for parts in (1, 7):
        numbered = with_positions(df.repartition(parts), ("u",), ("o",), SkewPolicy(range_rows=20), len(rows), 3)
        assert numbered.where("position <> o").count() == 0 and numbered.count() == len(rows)
    whole = with_positions(df, (), ("u", "o"), SkewPolicy(range_rows=20), len(rows))
    assert sorted(r.position for r in whole.collect()) == list(range(len(rows)))


def test_split_keeps_every_row(spark, base):
    policy = SkewPolicy(max_group_rows=60)
    hot = find_hot_keys(base, "user_id", policy)
    cold, rest = split_hot(base, "user_id", hot, policy)
    assert hot.rows == rest.count() and cold.count() + rest.count() == base.count()


def test_one_user_with_fifty_thousand_ratings(spark):
    films = movies(spark, ids=range(1000))
    made = spark.range(50_000).select(
        F.col("id").alias("rating_id"), F.lit(1).cast("long").alias("user_id"),
        (F.col("id") % 1000).alias("movie_id"),
        (F.lit(day(0)) + F.make_dt_interval(F.floor(F.col("id") / 100).cast("int"), F.lit(0), F.lit(0), F.lit(0)))
        .cast("timestamp_ntz").alias("rating_timestamp_utc"),
        F.lit(3).alias("rating_score"), *[F.lit(True).alias(f) for f in (
            "user_eligible_for_trial", "user_has_payment_method", "user_subscriber", "user_trialist")],
    )
    base = rating_base(made, films)
    report = fanout_report(base).first()
    assert (report.ratings, report.largest_pair, report.fanout_rows) == (50_000, 50, 2_500_000)
    config = SequenceConfig(rerate="by_rating")
    found = expand(rating_sequences(base, config), "train")
    assert found.count() == 50_000
    assert found.where(
        (F.col("rating_id") >= 10) & (F.element_at("history.movie_id", 1) != (F.col("rating_id") - 10) % 1000)
    ).count() == 0


@pytest.mark.parametrize("cut", [{}, CUT], ids=["plain", "cut"])
def test_tasks_follow_the_counted_rows(spark, base, cut):
    """Windows and block joins get tasks by the rows, which are not merged into a few by their stored size."""
    usual, fine = (rating_sequences(base, SequenceConfig().with_skew(**cut, **x)) for x in ({}, {"task_rows": 20}))
    rows = {}
    for name, sequences in (("usual", usual), ("fine", fine)):
        dealt = expand(sequences, "train").withColumn("task", F.spark_partition_id()).persist()
        tasks = dealt.groupBy("task").count().collect()
        rows[name] = rows_of(dealt.drop("task"))
        assert len(tasks) >= (4 if name == "usual" else 8)
        dealt.unpersist()
    assert rows["usual"] == rows["fine"]
