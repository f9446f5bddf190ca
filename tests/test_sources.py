import hashlib
import pathlib

import pytest
from fixtures import day, movies, ratings
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import SequenceConfig
from marquee.functions import sample_bucket
from marquee.operators.split import shuffled_within
from marquee.plans import datasets, training
from marquee.session import shared_dir, store
from marquee.sources.batches import BatchReader, read_batches, take_batches
from marquee.sources.buckets import read_bucketed, write_bucketed
from marquee.sources import (
    RATINGS, SnapshotLayout, check_schema, read_dataset, read_index, read_metrics, read_movies, read_ratings,
    write_dataset, write_metrics,
)
from marquee.sources.schemas import FLAGS


def test_layout():
    layout = SnapshotLayout("/x", "20240101")
    assert layout.data("train") == "/x/20240101/data/train/train.parquet"
    assert layout.data("train", "a.parquet") == "/x/20240101/data/train/a.parquet"
    assert layout.model("index") == "/x/20240101/models/index"
    assert len(SnapshotLayout("/x").snapshot) == 14


def test_existing_output_is_an_error(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "out")
    write_dataset(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_dataset(df, path)
    assert read_dataset(spark, path, df.schema).count() == 3


def test_prepare_writes_three_datasets_once(spark, tmp_path):
    rows = [(i, i % 3, i % 11, day(i), 3) for i in range(60)]
    inputs, layout = (ratings(spark, rows), movies(spark)), SnapshotLayout(str(tmp_path), "s1")
    done = datasets.prepare(*inputs, layout)
    assert set(done.paths) == {"train", "inference", "movies"} and done.seconds > 0
    train = read_dataset(spark, done.paths["train"])
    assert train.exceptAll(datasets.train_dataset(*inputs)).count() == 0
    assert train.count() == datasets.train_dataset(*inputs).count()
    inference = read_dataset(spark, done.paths["inference"])
    assert inference.exceptAll(datasets.inference_dataset(*inputs)).count() == 0
    with pytest.raises(FileExistsError):
        datasets.prepare(*inputs, layout)


def test_one_existing_dataset_stops_prepare_before_it_writes(spark, tmp_path):
    rows = [(i, i % 3, i % 11, day(i), 3) for i in range(60)]
    layout = SnapshotLayout(str(tmp_path), "s2")
    write_dataset(spark.range(1), layout.data("movies"))
    with pytest.raises(FileExistsError):
        datasets.prepare(ratings(spark, rows), movies(spark), layout)
    assert not (tmp_path / "s2" / "data" / "train").exists()


def test_jobs_leave_no_scratch(spark, tmp_path):
    def stored():
        return {p for p in pathlib.Path(shared_dir(spark).removeprefix("file:")).glob("marquee/*")}

    rows = [(i, i % 5, i % 11, day(i), 3) for i in range(200)]
    layout, before = SnapshotLayout(str(tmp_path), "s4"), stored()
    datasets.prepare(ratings(spark, rows), movies(spark), layout, SequenceConfig().with_skew(max_group_rows=20, segment_rows=15), keys=True)
    training.train_snapshot(spark, layout, n_holdout=20, k=5, batch_size=10, width=4, iterations=2)
    assert stored() == before


def test_training_job_fills_the_models_folder(spark, tmp_path):
    rows = [(i, i % 5, i % 11, day(i), 3) for i in range(200)]
    layout = SnapshotLayout(str(tmp_path), "s3")
    datasets.prepare(ratings(spark, rows), movies(spark), layout, keys=True)
    done = training.train_snapshot(spark, layout, n_holdout=40, k=5, batch_size=10, width=4, iterations=2)
    metrics = {r.metric: r.value for r in read_metrics(spark, done.metrics).collect()}
    assert metrics["rows"] == 40 and metrics["batches"] == 4
    assert {r.user_id for r in read_index(spark, done.index).collect()} == set(range(5))
    with pytest.raises(FileExistsError):
        training.train_snapshot(spark, layout)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_times_with_a_zone_become_utc(spark, zone):
    """Two instants across a UTC midnight and a clock change, read under two session zones."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(i, 1, 1, 3) for i in range(3)], "rating_id long, user_id long, movie_id long, rating_score int")
        at = F.element_at(F.array(*map(F.lit, (1730620740, 1730624460, 1730628060))), F.col("rating_id").cast("int") + 1)
        rows = rows.withColumn("rating_timestamp_utc", F.timestamp_seconds(at))
        for flag in FLAGS:
            rows = rows.withColumn(flag, F.lit(True))
        got = check_schema(rows, RATINGS, "ratings").orderBy("rating_id")
        times = ["2024-11-03 07:59:00", "2024-11-03 09:01:00", "2024-11-03 10:01:00"]
        assert [str(r.rating_timestamp_utc) for r in got.collect()] == times
        wanted = [int(hashlib.md5(f"{t}.000000".encode()).hexdigest()[:8], 16) % 100 for t in times]
        assert [r.b for r in got.select(sample_bucket(F.col("rating_timestamp_utc")).alias("b")).collect()] == wanted
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    write_metrics(spark.createDataFrame([("loss", 1.5), ("rows", 4.0)], "metric string, value double"), path)
    assert {tuple(r) for r in read_metrics(spark, path).collect()} == {("loss", 1.5), ("rows", 4.0)}


def test_tables_by_name_and_by_path(spark, tmp_path):
    rows = ratings(spark, [(1, 1, 1, day(0), 3)]).withColumn("extra", F.lit(1))
    rows.write.parquet(str(tmp_path / "ratings"))
    movies(spark).write.parquet(str(tmp_path / "movies"))
    assert read_ratings(spark, str(tmp_path)).schema.names == RATINGS.names
    assert read_movies(spark, str(tmp_path)).count() == 100
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_data")
    spark.sql(f"CREATE TABLE raw_data.ratings USING parquet LOCATION '{tmp_path}/ratings'")
    try:
        assert read_ratings(spark, "raw_data").count() == 1
    finally:
        spark.sql("DROP DATABASE raw_data CASCADE")


def test_schema_check(spark):
    with pytest.raises(ValueError, match="user_id is missing"):
        check_schema(spark.range(1).select(F.col("id").alias("rating_id")), RATINGS, "ratings")
    wrong = ratings(spark, []).withColumn("rating_score", F.lit("x"))
    with pytest.raises(ValueError, match="rating_score is string, not int"):
        check_schema(wrong, RATINGS, "ratings")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    """The index and the rows it is joined to lie in buckets of the user: bucket meets bucket."""
    rows = [(i, i % 23, i % 11, day(i), 3) for i in range(400)]
    inference = datasets.inference_dataset(ratings(spark, rows), movies(spark), keys=True)
    index = inference.select("user_id", "rating_id").withColumn("vector", F.array(F.lit(1.0), F.lit(2.0)))
    for name, table in (("index", index), ("inference", inference)):
        write_bucketed(table, str(tmp_path / name), "user_id", 8)
    stored = [read_bucketed(spark, str(tmp_path / name), "user_id", 8) for name in ("index", "inference")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for on in (["user_id"], ["user_id", "rating_id"]):
            # Further columns of the join may lie anywhere in a bucket, which Spark is told by a setting.
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", str(len(on) == 1).lower())
            joined = stored[1].join(stored[0], on)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
            assert joined.count() == inference.join(index, on).count() > 0
        grouped = stored[0].groupBy("user_id").count()
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    with pytest.raises(FileExistsError):
        write_bucketed(index, str(tmp_path / "index"), "user_id", 8)


def test_batches_by_place(spark, tmp_path):
    """Batches cross files and row groups; one of them opens only the files that hold it."""
    path = str(tmp_path / "rows")
    df = spark.range(0, 1_050, 1, 4).select("id", (F.col("id") * 2).cast("int").alias("twice"), F.array("id").alias("ids"))
    df.write.option("parquet.block.size", 1_000).parquet(path)
    every = read_batches(spark, path, 100).orderBy("place").collect()
    assert [r.place for r in every] == list(range(1_050)) and [r.id for r in every] == list(range(1_050))
    assert all(r.batch_id == r.place // 100 and r.twice == 2 * r.id and r.ids == [r.id] for r in every)
    assert read_batches(spark, path, 100).rdd.getNumPartitions() == 11
    first = [sorted(map(tuple, take_batches(spark, path, 100, 2, ["id"]).collect())) for _ in range(2)]
    assert first[0] == first[1] == [(i, i // 100, i) for i in range(200)]
    for name in sorted((tmp_path / "rows").glob("part-*"))[:2]:
        name.write_bytes(b"")  # only what lies in the last two files can still be read
    offsets = store(spark.createDataFrame([(str(p), n, s) for p, n, s in zip(
        sorted((tmp_path / "rows").glob("part-*")), (262, 263, 262, 263), (0, 262, 525, 787))], "file string, rows long, first long"), "files")
    last = BatchReader(read_batches_schema(df), {"files": offsets, "rows": "100", "start": "9", "count": "1"})
    (batch,) = last.partitions()
    assert [row for part in last.read(batch) for row in part.column("id").to_pylist()] == list(range(900, 1_000))


def read_batches_schema(df):
    return T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("place", T.LongType())])


def test_batches_of_nothing_and_odd_sizes(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    spark.range(5).write.parquet(str(tmp_path / "five"))
    assert read_batches(spark, str(tmp_path / "none"), 3).collect() == []
    assert read_batches(spark, str(tmp_path / "five"), 100).count() == 5
    assert read_batches(spark, str(tmp_path / "five"), 2, 7).collect() == []
    assert take_batches(spark, str(tmp_path / "five"), 2, 0).collect() == []
    with pytest.raises(ValueError, match="at least one row"):
        read_batches(spark, str(tmp_path / "five"), 0)


def test_a_shuffle_within_buffers_exchanges_nothing(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 1_000, 1, 3).write.parquet(path)
    shuffled = shuffled_within(read_batches(spark, path, 300), 300, ["id"])
    assert "Exchange" not in shuffled._jdf.queryExecution().executedPlan().toString()
    rows = shuffled.orderBy("shuffle_position").collect()
    assert [r.shuffle_position for r in rows] == list(range(1_000))
    assert all(r.id // 300 == r.shuffle_position // 300 for r in rows) and [r.id for r in rows] != sorted(r.id for r in rows)


def test_many_small_batches_share_partitions(spark, tmp_path):
    """A row group is not read once for every batch in it; whole batches stay together, and buffers are still shuffled apart."""
    path = str(tmp_path / "rows")
    spark.range(0, 1_050, 1, 2).write.parquet(path)
    batches = read_batches(spark, path, 2, 3)
    assert batches.rdd.getNumPartitions() == 174  # 522 batches by three
    rows = batches.withColumn("task", F.spark_partition_id()).orderBy("place").collect()
    assert [(r.id, r.batch_id, r.place) for r in rows] == [(i, i // 2, i) for i in range(6, 1_050)]
    assert len({(r.batch_id, r.task) for r in rows}) == 522
    shuffled = shuffled_within(batches, 2, ["id"]).orderBy("shuffle_position").collect()
    assert [r.shuffle_position for r in shuffled] == list(range(6, 1_050))
    assert all(r.id // 2 == r.shuffle_position // 2 for r in shuffled) and [r.id for r in shuffled] != list(range(6, 1_050))
