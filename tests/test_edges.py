"""One hand-written case per trap of the reference semantics."""

import datetime

import pytest
from fixtures import day, movies, ratings
from pyspark.sql import functions as F

from marquee.config import SequenceConfig, hosted_variant
from marquee.functions import newest, pad, unpad
from marquee.operators.ratings import rating_base
from marquee.operators.sequences import expand, rating_gaps, rating_sequences
from marquee.operators.vocabulary import encode_ids
from marquee.plans import datasets

pytestmark = pytest.mark.usefixtures("interpreted")

# Both ways of computing: whole users per task, and every user cut into segments.
PLAIN = {}
SEGMENTED = {"max_group_rows": 0, "segment_rows": 11, "pair_rows": 2}
WAYS = pytest.mark.parametrize("bounds", [PLAIN, SEGMENTED], ids=["plain", "segmented"])


def sequences(spark, rows, bounds, films=None, latest_only=False, **changes):
    config = SequenceConfig(**changes).with_skew(**bounds)
    films = movies(spark) if films is None else films
    base = rating_base(ratings(spark, rows), films, config.include_unrated)
    return rating_sequences(base, config, latest_only)


def gaps(spark, rows, bounds, column, **changes):
    found = rating_gaps(sequences(spark, rows, bounds, **changes)).orderBy("rating_id")
    return [row[column] for row in found.collect()]


def test_gap_over_midnight(spark, bounds=PLAIN):
    rows = [
        (1, 1, 1, datetime.datetime(2024, 1, 1, 23, 59), 3),
        (2, 1, 2, datetime.datetime(2024, 1, 2, 0, 1), 3),
    ]
    column = "days_since_last_rating"
    assert gaps(spark, rows, bounds, column) == [-1, 1]
    assert gaps(spark, rows, bounds, column, gap_unit="elapsed") == [-1, 0]


@WAYS
def test_gap_order(spark, bounds):
    rows = [(i, 1, i, day(d), 3) for i, d in enumerate([0, 5, 7, 16])]  # gaps -1, 5, 2, 9
    assert gaps(spark, rows, bounds, "shifted_days") == [2, 9, 5, 0]
    assert gaps(spark, rows, bounds, "shifted_days", gap_order="time") == [0, -1, 5, 2]


@WAYS
def test_equal_gaps_keep_time_order(spark, bounds):
    rows = [(i, 1, i, day(d), 3) for i, d in enumerate([0, 1, 2, 4, 6, 7])]  # gaps -1, 1, 1, 2, 2, 1
    assert gaps(spark, rows, bounds, "shifted_days") == [1, 2, 1, 0, 2, 1]


@WAYS
def test_rerated_movie(spark, bounds):
    rows = [(i, 1, 7, day(i), 3) for i in range(3)]
    fanout = expand(sequences(spark, rows, bounds), "train")
    assert fanout.count() == 9
    assert sorted(r.history_len for r in fanout.collect()) == list(range(9))
    assert expand(sequences(spark, rows, bounds, rerate="by_rating"), "train").count() == 3


def test_null_user_and_unknown_movie_are_absent(spark, bounds=PLAIN):
    rows = [(1, None, 1, day(0), 3), (2, 5, 1, day(0), 3), (3, 5, 555, day(1), 3)]
    assert [r.rating_id for r in rating_gaps(sequences(spark, rows, bounds)).collect()] == [2]


def test_unrated_gets_median(spark, bounds=PLAIN):
    rows = [(i, i, 1, day(i), s) for i, s in enumerate([1, 2, None, 4, 5])]
    assert len(gaps(spark, rows, bounds, "rating_value")) == 4
    assert gaps(spark, rows, bounds, "rating_value", include_unrated=True) == [1, 2, 2, 4, 5]


def test_movie_without_any_score_keeps_arrays_aligned(spark, bounds=PLAIN):
    rows = [(i, 1, i, day(i), None if i == 2 else 4) for i in range(5)]
    found = expand(sequences(spark, rows, bounds, include_unrated=True), "train")
    last = found.where("rating_id = 4").first().history
    assert [(e.movie_id, e.rating_value) for e in last] == [(0, 4), (1, 4), (2, None), (3, 4)]


@pytest.mark.parametrize("bounds, latest_only", [(PLAIN, False), (PLAIN, True), (SEGMENTED, True)])
def test_time_ties(spark, bounds, latest_only):
    rows = [(1, 1, 1, day(0), 3), (2, 1, 2, day(1), 3), (3, 1, 3, day(2), 3), (4, 1, 4, day(2), 3)]
    for shuffled in (rows, rows[::-1]):
        made = sequences(spark, shuffled, bounds, latest_only=latest_only)
        found = datasets.inference_rows(made)
        lengths = {r.rating_id: [e.movie_id for e in r.history] for r in found.collect()}
        assert lengths == {3: [1, 2, 3], 4: [1, 2, 3, 4]}
        assert datasets.inference_rows(made, one_per_user=True).count() == 1


@WAYS
def test_history_sizes(spark, bounds):
    rows = [(u * 10 + i, u, i, day(i), 3) for u, n in ((1, 1), (3, 3), (4, 4), (5, 5)) for i in range(n)]
    made = sequences(spark, rows, bounds)
    train = {r.user_id: r["count"] for r in datasets.train_rows(made).groupBy("user_id").count().collect()}
    inference = {r.user_id for r in datasets.inference_rows(made).collect()}
    assert train == {4: 1, 5: 2}
    assert inference == {3, 4, 5}


@WAYS
def test_long_history_keeps_newest_and_excludes_current(spark, bounds):
    rows = [(i, 1, i, day(i), 3) for i in range(40)]
    made = sequences(spark, rows, bounds)
    for frame, shift in (("train", 0), ("inference", 1)):
        for row in expand(made, frame).collect():
            end = row.rating_id + shift
            assert [e.movie_id for e in row.history] == list(range(max(0, end - 10), end))
            assert row.history_len == len(row.history)


def test_pad_truncate_unpad(spark):
    df = spark.createDataFrame([([1, 2, 3],), (list(range(1, 8)),), ([],)], "a array<int>")
    kept = newest(F.col("a"), 5)
    zero = F.lit(0)
    post, pre = pad(kept, 5, zero), pad(kept, 5, zero, "pre")
    rows = df.select(post.alias("post"), pre.alias("pre"), F.size(kept).alias("n"))
    assert [(r.post, r.pre) for r in rows.collect()] == [
        ([1, 2, 3, 0, 0], [0, 0, 1, 2, 3]), ([3, 4, 5, 6, 7], [3, 4, 5, 6, 7]), ([0] * 5, [0] * 5)
    ]
    back = rows.select(unpad(F.col("post"), F.col("n")).alias("x"), unpad(F.col("pre"), F.col("n"), "pre").alias("y"))
    assert [(r.x, r.y) for r in back.collect()] == [([1, 2, 3],) * 2, ([3, 4, 5, 6, 7],) * 2, ([],) * 2]


def test_empty_history_and_null_year(spark):
    films = movies(spark, rows=[(3, "no year", None, None)])
    rows = [(1, 1, 3, day(0), 4), (2, 1, 5, day(2), 5)]
    config = SequenceConfig(min_history=0, seq_length=3)
    found = datasets.train_dataset(ratings(spark, rows), films, config, keys=True).orderBy("rating_id").collect()
    assert found[0].history_len == 0 and found[0].previous_movie_ids == [0, 0, 0]
    assert found[0].previous_movie_years == [1980.0] * 3 and found[0].previous_score == [2.5] * 3
    assert found[1].previous_movie_ids == [3, 0, 0] and found[1].previous_movie_years == [0.0, 1980.0, 1980.0]
    assert (found[1].user_has_payment_method, found[1].user_eligible_for_trial) == (1, 0)


@pytest.mark.parametrize("seq_length", [4, 15])
def test_hosted_frame_is_fixed(spark, seq_length):
    rows = [(i, 1, i + 1, day(i), 3) for i in range(20)]
    config = hosted_variant(seq_length)
    found = datasets.inference_dataset(ratings(spark, rows), movies(spark), config).first()
    ids = list(range(11, 21))
    assert found.previous_movie_ids == (ids[-4:] if seq_length == 4 else [0] * 5 + ids)
    assert found.history_len == min(10, seq_length)


def test_unknown_id_gets_zero(spark):
    vocabulary = spark.createDataFrame([(10, 1), (20, 2)], "movie_id long, index long")
    df = spark.createDataFrame([(20,), (30,), (None,)], "movie_id long")
    assert sorted(r["index"] for r in encode_ids(df, vocabulary, "movie_id").collect()) == [0, 0, 2]


def test_null_title_stays_null(spark):
    films = movies(spark, ids=[], rows=[(1, None, 2000, None), (2, "two", 2000, None)])
    rows = [(1, 1, 1, day(0), None), (2, None, 1, day(0), 3)]
    assert [tuple(r) for r in datasets.movie_catalogue(ratings(spark, rows), films).collect()] == [(1, None)]


def test_null_id_is_an_error(spark):
    from marquee.operators.features import required_id

    with pytest.raises(Exception, match="movie_id is null"):
        spark.createDataFrame([(None,)], "movie_id long").select(required_id("movie_id")).collect()


def test_config_is_checked():
    with pytest.raises(ValueError, match="pad_side"):
        SequenceConfig(pad_side="left")
    with pytest.raises(ValueError, match="segment_rows"):
        SequenceConfig(history_len=30).with_skew(segment_rows=30)
