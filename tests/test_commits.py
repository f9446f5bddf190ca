"""Commits of snapshots, and snapshots carried forward against snapshots of everything."""

import datetime
import random

import pytest
from fixtures import day, movies, ratings
from pyspark.sql import DataFrame

from marquee.config import SequenceConfig, hosted_variant
from marquee.plans import datasets, training, updates
from marquee.sources import SnapshotLayout, commits, files
from marquee.sources.commits import Changed, NotCommitted, discard, open_part, read_snapshot, writing


@pytest.fixture
def some(spark):
    rows = [(i, i % 3, i % 11, day(i), 3) for i in range(60)]
    return ratings(spark, rows), movies(spark)


def test_a_committed_snapshot_says_what_it_holds(spark, tmp_path, some):
    layout = SnapshotLayout(str(tmp_path), "s")
    done = datasets.prepare(*some, layout)
    part = open_part(spark, layout)
    assert set(part.tables) == set(datasets.KINDS) and part.path("train") == done.paths["train"]
    for kind in datasets.KINDS:
        assert part.read(kind).count() == part.rows(kind) > 0
    assert read_snapshot(spark, layout, "train").dtypes == datasets.train_dataset(*some).dtypes


@pytest.mark.parametrize("failing", [1, 2, 3])
def test_a_snapshot_whose_writing_failed_is_not_read(spark, tmp_path, some, monkeypatch, failing):
    layout, written = SnapshotLayout(str(tmp_path), "s"), []
    write = commits.write_dataset

    def breaking(df, path):
        written.append(path)
        if len(written) == failing:
            raise OSError("the disk is full")
        write(df, path)

    monkeypatch.setattr(commits, "write_dataset", breaking)
    with pytest.raises(OSError, match="full"):
        datasets.prepare(*some, layout)
    monkeypatch.undo()
    with pytest.raises(NotCommitted):
        read_snapshot(spark, layout, "train")
    with pytest.raises(NotCommitted):
        training.train_snapshot(spark, layout)
    with pytest.raises(FileExistsError):  # what is left is not mixed with a second writing
        datasets.prepare(*some, layout)
    discard(spark, layout)
    datasets.prepare(*some, layout)
    assert read_snapshot(spark, layout, "movies").count() == 11


def test_of_two_writers_one_loses(spark, tmp_path, some):
    layout = SnapshotLayout(str(tmp_path), "s")
    with writing(spark, layout, "data") as first:
        with pytest.raises(FileExistsError):
            datasets.prepare(*some, layout)
        first.write("movies", some[1])
    assert set(open_part(spark, layout).tables) == {"movies"}
    with pytest.raises(FileExistsError):
        discard(spark, layout)


def test_a_manifest_is_published_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/manifest.json"
    files.publish(spark, path, "first")
    with pytest.raises(FileExistsError):
        files.publish(spark, path, "second")
    assert files.read_text(spark, path) == "first" and not list(tmp_path.glob("*.draft"))


def test_changed_files_are_refused(spark, tmp_path, some):
    layout = SnapshotLayout(str(tmp_path), "s")
    path = datasets.prepare(*some, layout).paths["movies"]
    some[1].select("movie_id", "movie_title").write.mode("append").parquet(path)
    with pytest.raises(Changed):
        read_snapshot(spark, layout, "movies")


def all_rows(df: DataFrame) -> list:
    names = sorted(df.columns)
    return sorted((tuple(str(v) for v in row) for row in df.select(names).collect()))


def same(spark, layout, everything, films, config):
    done = open_part(spark, layout)
    wanted = {
        "train": datasets.train_dataset(everything, films, config, keys=True),
        "inference": datasets.inference_dataset(everything, films, config, keys=True),
        "movies": datasets.movie_catalogue(everything, films),
    }
    for kind, rows in wanted.items():
        got = done.read(kind)
        assert got.columns == rows.columns
        assert all_rows(got) == all_rows(rows), kind


def random_ratings(rng, first, n, users, films):
    return [
        (first + i, rng.choice([*range(users), None]) if rng.random() < 0.05 else rng.randrange(users), rng.randrange(films),
         day(rng.randrange(200) + rng.choice([0, 0.3])), rng.choice([1, 2, 3, 4, 5, None]))
        for i in range(n)
    ]


CONFIGS = {
    "library": SequenceConfig(),
    "unrated": SequenceConfig(include_unrated=True),
    "hosted": hosted_variant(),
    "segments": SequenceConfig(include_unrated=True).with_skew(max_group_rows=20, segment_rows=15, pair_rows=2),
    "shuffled joins": SequenceConfig().with_skew(broadcast_rows=0),
}


@pytest.mark.parametrize("name", CONFIGS)
def test_a_snapshot_carried_forward_is_the_one_of_everything(spark, tmp_path, name):
    """Twice: new ratings, then also movies added, dropped, listed twice and described anew."""
    rng, config = random.Random(name), CONFIGS[name]
    batches = [random_ratings(rng, 0, 250, 12, 30), random_ratings(rng, 1_000, 9, 3, 34), random_ratings(rng, 2_000, 7, 14, 34)]
    films = movies(spark, range(28))
    later = movies(spark, range(2, 34), rows=[(7, "another title", 1950, None)])
    later = later.unionByName(later.where("movie_id = 9"))
    layouts = [SnapshotLayout(str(tmp_path), f"s{i}") for i in range(3)]
    updates.prepare_carried(ratings(spark, batches[0]), films, layouts[0], config, keys=True)
    same(spark, layouts[0], ratings(spark, batches[0]), films, config)
    updates.update(spark, layouts[0], layouts[1], ratings(spark, batches[1]), films, config, keys=True)
    same(spark, layouts[1], ratings(spark, batches[0] + batches[1]), films, config)
    updates.update(spark, layouts[1], layouts[2], ratings(spark, batches[2]), later, config, keys=True)
    same(spark, layouts[2], ratings(spark, sum(batches, [])), later, config)


def test_only_touched_users_are_rebuilt(spark, tmp_path, monkeypatch):
    rows = [(i, i % 10, i % 11, day(i), 3) for i in range(200)]
    layouts = [SnapshotLayout(str(tmp_path), f"s{i}") for i in range(2)]
    updates.prepare_carried(ratings(spark, rows), movies(spark), layouts[0])
    rebuilt = []
    shared = updates.shared_sequences
    monkeypatch.setattr(updates, "shared_sequences", lambda rated, *rest: rebuilt.append(rated.collect()) or shared(rated, *rest))
    updates.update(spark, layouts[0], layouts[1], ratings(spark, [(900, 4, 5, day(300), 2), (901, 77, 5, day(3), 2)]), movies(spark))
    assert {row.user_id for row in rebuilt[0]} == {4, 77} and len(rebuilt[0]) == 22


def test_snapshots_read_their_state_and_the_rated_movies(spark, tmp_path, monkeypatch):
    """What a snapshot reads follows its ratings, which it reads from their state, and not the list of all movies."""
    rows, films = [(i, i % 3, i % 11, day(i), 3) for i in range(60)], movies(spark)
    films = films.unionByName(films.where("movie_id in (4, 50)"))
    layouts = [SnapshotLayout(str(tmp_path), f"s{i}") for i in range(2)]
    seen = []
    shared = updates.shared_sequences
    monkeypatch.setattr(updates, "shared_sequences", lambda rated, listed, *rest: (
        seen.append((rated.inputFiles(), sorted(r.movie_id for r in listed.collect()))) or shared(rated, listed, *rest)
    ))
    updates.prepare_carried(ratings(spark, rows), films, layouts[0], keys=True)
    updates.update(spark, *layouts, ratings(spark, [(900, 1, 70, day(300), 2)]), films, keys=True)
    assert all(f"{tmp_path}/s0/state/ratings" in path for path in seen[0][0]) and seen[0][0]
    assert [ids for _, ids in seen] == [sorted([*range(11), 4]), sorted([*range(11), 4, 70])]
    same(spark, layouts[1], ratings(spark, rows + [(900, 1, 70, day(300), 2)]), films, SequenceConfig())


def test_changed_movies_count_repeated_lines(spark):
    before = movies(spark, range(6), rows=[(1, None, None, None)])
    after = movies(spark, range(1, 7), rows=[(1, None, None, None), (3, "movie 3", None, "en")])
    after = after.unionByName(after.where("movie_id = 5"))
    assert sorted(r.movie_id for r in updates._changed_movies(before, after).collect()) == [0, 3, 5, 6]
    twice = before.unionByName(before)
    assert updates._changed_movies(twice, twice).isEmpty()
    lines = updates._changed_movies(before, after)._jdf.queryExecution().optimizedPlan().toString()
    assert lines.count("Aggregate [") == 2  # the lines once, and their ids


@pytest.mark.parametrize("rerate", ["fanout", "by_rating"])
def test_pairs_of_more_ratings_than_a_frame(spark, tmp_path, rerate):
    """Pairs of one to nine ratings, and users of long and short pairs, with frames of three entries."""
    config = SequenceConfig(seq_length=3, min_history=0, rerate=rerate)
    rows = [(100 * m + i, u, m, day((7 * m + 5 * i + u) % 40), (m + i) % 5 + 1)
            for u in range(3) for m in range(1, 10) for i in range(m if u else 1 + m % 3)]
    rows = [(n, *row[1:]) for n, row in enumerate(rows)]
    layout = SnapshotLayout(str(tmp_path), "s")
    updates.prepare_carried(ratings(spark, rows), movies(spark), layout, config, keys=True)
    same(spark, layout, ratings(spark, rows), movies(spark), config)


def test_a_moved_median_touches_the_unscored(spark):
    counts = spark.createDataFrame([(1, 2, 3), (1, 5, 3), (2, None, 4), (3, 4, 1)], "movie_id long, rating_score int, n long")
    assert {tuple(r) for r in updates.medians_of(counts).collect()} == {(1, 2), (3, 4)}
    before = ratings(spark, [(1, 10, 1, day(0), None), (2, 11, 1, day(0), 5), (3, 12, 2, day(0), None)])
    moved = spark.createDataFrame([(1,)], "movie_id long")
    users = updates.touched_users(before, ratings(spark, []), moved.where("false"), moved, SequenceConfig())
    assert [r.user_id for r in users.collect()] == [10]


def test_nothing_new_and_nothing_before(spark, tmp_path):
    rows = [(i, i % 3, i % 11, day(i), 3) for i in range(60)]
    layouts = [SnapshotLayout(str(tmp_path), f"s{i}") for i in range(4)]
    none, films = ratings(spark, []), movies(spark)
    updates.prepare_carried(none, films, layouts[0], keys=True)
    updates.update(spark, layouts[0], layouts[1], none, films, keys=True)
    updates.update(spark, layouts[1], layouts[2], ratings(spark, rows), films, keys=True)
    updates.update(spark, layouts[2], layouts[3], none, films, keys=True)
    same(spark, layouts[3], ratings(spark, rows), films, SequenceConfig())


def test_settings_have_to_agree(spark, tmp_path, some):
    layouts = [SnapshotLayout(str(tmp_path), f"s{i}") for i in range(2)]
    updates.prepare_carried(*some, layouts[0])
    with pytest.raises(ValueError, match="settings"):
        updates.update(spark, *layouts, some[0], some[1], SequenceConfig(min_history=0))
    assert day(0) == datetime.datetime(2024, 1, 1, 12)
