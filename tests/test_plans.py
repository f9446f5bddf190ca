"""The physical plans stay the ones meant."""

import pytest

from marquee.config import SequenceConfig
from marquee.plans import datasets
from marquee.sources.adapters import movies_view, ratings_view


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def inputs(spark, small):
    return ratings_view(spark, small), movies_view(spark, small)


def test_train_has_one_shuffle_and_one_scan_per_table(inputs):
    text = plan(datasets.train_dataset(*inputs))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("FileScan parquet") == 2
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_inference_has_one_shuffle(inputs):
    assert plan(datasets.inference_dataset(*inputs)).count("Exchange hashpartitioning") == 1


def test_pair_arrays_are_gathered_after_the_last_sort(inputs):
    """The uppermost window collects the matches of a (user, movie); nothing above it sorts or moves rows."""
    lines = plan(datasets.train_dataset(*inputs)).splitlines()
    first = next(i for i, line in enumerate(lines) if "- Window [" in line)
    assert "collect_list" in lines[first] and "movie_id" in lines[first].split("windowspecdefinition(")[1].split(",")[1]
    assert not any("- Sort [" in line or "Exchange" in line for line in lines[:first])


def test_stored_sequences_are_read_as_they_lie(inputs):
    """Rows carry the matches of short pairs, and there are no others here: nothing is shuffled, sorted or windowed again."""
    config = SequenceConfig()
    rows = datasets.snapshot_rows(datasets.shared_sequences(*inputs, config), config, keys=True)
    for dataset in rows.values():
        assert dataset.collect()
        final = plan(dataset).split("== Initial Plan ==")[0]
        assert not any(word in final for word in ("Exchange", "Sort [", "Window ["))


def test_entries_are_made_without_lambdas(inputs):
    assert "lambda" not in plan(datasets.train_dataset(*inputs))


def test_one_per_user_costs_one_shuffle_and_two_scans(inputs):
    text = plan(datasets.inference_dataset(*inputs, one_per_user=True))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan parquet") == 2


def test_nothing_multiplies_tables(inputs):
    for df in (datasets.train_dataset(*inputs), datasets.movie_catalogue(*inputs)):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_median_stays_out_unless_asked_for(inputs):
    assert "percentile" not in plan(datasets.train_dataset(*inputs)).lower()
    assert "percentile" in plan(datasets.train_dataset(*inputs, SequenceConfig(include_unrated=True))).lower()


def test_catalogue_reads_only_ids_and_titles(inputs):
    text = plan(datasets.movie_catalogue(*inputs))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text
    assert "ReadSchema: struct<props:string>" in text


def test_shuffle_join_takes_over_beyond_the_broadcast_bound(spark, inputs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(datasets.train_dataset(*inputs))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_order_is_stable(inputs):
    columns = datasets.train_dataset(*inputs).columns
    assert columns[:2] == ["movie_id", "user_id"] and columns[-1] == "history_len"
    types = dict(datasets.train_dataset(*inputs).dtypes)
    assert types["previous_movie_ids"] == "array<int>" and types["previous_score"] == "array<float>"


def test_a_hot_movie_is_split_in_the_shuffle_join(spark, inputs):
    """Beyond the broadcast bound, a movie with a third of the ratings does not end up in one task."""
    from pyspark.sql import functions as F

    from marquee.operators.ratings import rating_base

    ratings, films = inputs
    hot = F.when(F.col("rating_id") % 3 == 0, 5).otherwise(F.col("movie_id"))
    bounds = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for name, value in bounds.items():
        spark.conf.set(name, value)
    try:
        joined = rating_base(ratings.withColumn("movie_id", hot).repartition(6), films)
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for name in bounds:
            spark.conf.unset(name)
