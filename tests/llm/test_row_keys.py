"""Rows keep their keys however their files are cut into tasks."""

import pytest
from pyspark.sql import functions as F
from textcases import edited, prose, table

from marquee.llm import decontaminate, near_dedup
from marquee.llm.common import ROW, _window, addressable, has_places, rows_at, with_row_key, without_rows

#: Small files are cut into as many splits as there are cores, as large ones would be.
CUT = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "128m"}


@pytest.fixture
def cores(spark):
    """Set the number of tasks that files are cut for, as gained and lost executors do."""
    for name, value in CUT.items():
        spark.conf.set(name, value)
    yield lambda n: spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(n))
    for name in (*CUT, "spark.sql.leafNodeDefaultParallelism"):
        spark.conf.unset(name)


@pytest.fixture
def files(spark, tmp_path):
    """Several files of several row groups, with near copies and benchmark passages among other texts."""
    item = prose(7_777, 30)
    rows = [(i, prose(i, 60), "en", "a") for i in range(150)]
    rows += [(200 + i, edited(prose(i, 60), i, 59), "en", "a") for i in range(40)]
    rows += [(300 + i, f"{prose(900 + i, 40)} {item} {prose(950 + i, 40)}", "en", "a") for i in range(20)]
    path = str(tmp_path / "docs")
    table(spark, rows).repartition(3).write.option("parquet.block.size", 4_000).parquet(path)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    return spark.read.parquet(path), items


def tasks(df):
    return df.select("doc_id").rdd.getNumPartitions()


def test_keys_do_not_follow_the_cores(spark, cores, files):
    docs, _ = files
    seen = set()
    for n in (2, 7, 16):
        cores(n)
        seen.add((tasks(docs), tuple(sorted((r.doc_id, r[ROW]) for r in with_row_key(docs.select("doc_id")).collect()))))
    assert len({n for n, _ in seen}) == 3, "the files were cut alike"
    assert len({keys for _, keys in seen}) == 1 and len({key for _, key in seen.pop()[1]}) == 210


def test_rows_to_drop_are_dropped_under_other_cores(spark, cores, files):
    docs, _ = files
    cores(3)
    keys = with_row_key(docs.select("doc_id")).where("doc_id % 2 = 1").select(ROW)
    keys = spark.createDataFrame(keys.collect(), keys.schema)
    cores(13)
    left = without_rows(docs, keys)
    assert sorted(r.doc_id for r in left.collect()) == [r for r in sorted(i.doc_id for i in docs.collect()) if r % 2 == 0]
    assert left.columns == docs.columns


@pytest.mark.parametrize("first, then", [(2, 11), (16, 3)])
def test_near_copies_are_found_while_cores_change(spark, cores, files, monkeypatch, first, then):
    docs, _ = files
    cores(first)
    wanted = sorted(tuple(r) for r in near_dedup.near_components(docs).drop(ROW).collect())
    made = near_dedup.sketches

    def changing(*args):
        found = made(*args)
        cores(then)
        return found

    monkeypatch.setattr(near_dedup, "sketches", changing)
    got = sorted(tuple(r) for r in near_dedup.near_components(docs).drop(ROW).collect())
    assert got == wanted and sum(not row[3] for row in got) == 40


def test_leaks_are_found_while_cores_change(spark, cores, files, monkeypatch):
    docs, items = files
    cores(2)
    search = decontaminate.leaks

    def changing(*args):
        found = search(*args)
        cores(11)
        return found

    monkeypatch.setattr(decontaminate, "leaks", changing)
    got = {r.doc_id for r in decontaminate.contamination(docs, items).collect() if r.contaminated}
    assert got == set(range(300, 320))


def test_what_has_places(spark, files):
    docs, _ = files
    assert has_places(docs) and has_places(docs.where("doc_id > 3").select("text").withColumn("x", F.lit(1)))
    others = [
        docs.limit(5), docs.union(docs), docs.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))),
        docs.where(F.rand() > 0.5), docs.join(docs.select("doc_id"), "doc_id", "left_semi"), docs.repartition(2), spark.range(3),
    ]
    for other in others:
        assert not has_places(other)
        with pytest.raises(ValueError, match="no lasting key"):
            with_row_key(other)
    stored = addressable(docs.repartition(2))
    assert has_places(stored) and stored.count() == 210 and addressable(docs) is docs


def test_files_are_told_apart(spark, tmp_path):
    paths = [f"file:///data/part-{i:05d}.parquet" for i in range(3_000)]
    shift, bits = _window(paths)
    assert bits <= 28 and shift + bits <= 63
    odd = str(tmp_path / "a b%c=d" / "é+x")
    spark.range(10).repartition(4).write.parquet(odd)
    keyed = with_row_key(spark.read.parquet(odd)).collect()
    assert len({r[ROW] for r in keyed}) == 10


def test_a_hidden_name_is_refused(spark):
    with pytest.raises(ValueError, match="rename"):
        addressable(spark.range(2).withColumn("_metadata", F.lit(1)))


@pytest.mark.parametrize("most", [0, 1_000])
def test_rows_are_found_where_they_lie(spark, cores, files, most):
    """By keys sent along and by keys read from the shared folder, a few of them at a time."""
    docs, _ = files
    cores(5)
    keyed = with_row_key(docs.select("doc_id"))
    wanted = spark.createDataFrame(keyed.where("doc_id % 3 = 0").select(ROW).collect(), f"{ROW} long")
    found = rows_at(keyed.select(ROW, "doc_id"), wanted, most)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id % 3 == 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("MapInArrow" in plan) == (most == 0) and "Exchange hash" not in plan
    assert rows_at(keyed, wanted.limit(0), most).collect() == []
