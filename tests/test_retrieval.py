"""Retrieval against brute force, and the fitted model against planted tastes."""

import numpy as np
import pandas as pd
import pytest
from fixtures import movies
from pyspark.sql import functions as F

from marquee.operators.batches import map_batches, take_batches
from marquee.operators.factors import fit_item_vectors
from marquee.operators.ratings import rating_base
from marquee.operators.retrieval import (
    history_vectors, lookup_vectors, score, softmax_losses, top_k, top_k_accuracy, true_pair_ranks,
)
from marquee.operators.split import find_cut, hold_out
from marquee.operators.vocabulary import build_vocabulary, encode_history
from marquee.plans import audience, datasets, training
from marquee.session import materialise, ship_package

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def shipped(spark):
    ship_package(spark)
    return spark


def frame(spark, names, ids, vectors):
    return spark.createDataFrame([(*i, [float(x) for x in v]) for i, v in zip(ids, vectors)], names)


@pytest.mark.parametrize("block_rows, lookup_bytes", [(1000, 10**6), (17, 10**6), (17, 0)])
def test_top_k(shipped, block_rows, lookup_bytes):
    q, c = RNG.normal(size=(30, 5)).round(1), RNG.normal(size=(101, 5)).round(1)  # rounded: many ties
    queries = frame(shipped, "movie_id long, query array<double>", [(i,) for i in range(30)], q)
    users = [(i // 2, i) for i in range(101)]  # two rows per user
    index = frame(shipped, "user_id long, rating_id long, vector array<double>", users, c)
    found = top_k(queries, index, 7, block_rows, lookup_bytes).collect()
    scores = np.round(q @ c.T, 6)
    for movie in range(30):
        order = sorted(range(101), key=lambda j: (-scores[movie, j], users[j][0]))[:7]
        got = sorted((r for r in found if r.movie_id == movie), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 8))
        assert [r.user_id for r in got] == [users[j][0] for j in order]
        assert [r.score for r in got] == pytest.approx([scores[movie, j] for j in order])


def test_top_k_with_fewer_candidates_than_k(shipped):
    queries = frame(shipped, "movie_id long, query array<double>", [(1,)], [[1.0]])
    index = frame(shipped, "user_id long, vector array<double>", [(9,), (4,)], [[2.0], [2.0]])
    assert [(r["rank"], r.user_id) for r in top_k(queries, index, 5).orderBy("rank").collect()] == [(1, 4), (2, 9)]


@pytest.mark.parametrize("block_rows, lookup_bytes", [(13, 10**6), (13, 0)])
def test_ranks_and_loss(shipped, block_rows, lookup_bytes):
    n = 60
    movie = RNG.integers(0, 6, n)
    item, own = RNG.normal(size=(6, 4)), RNG.normal(size=(n, 4))
    rows = shipped.createDataFrame(
        [(i, int(movie[i]), item[movie[i]].tolist(), own[i].tolist()) for i in range(n)],
        "k long, movie_id long, query array<double>, vector array<double>",
    ).withColumn("score", F.round(F.expr("aggregate(zip_with(query, vector, (x, y) -> x * y), 0D, (a, x) -> a + x)"), 6))
    ranks = true_pair_ranks(rows, rows, ("k",), block_rows, lookup_bytes)
    scores = np.round(item[movie] @ own.T, 6)
    wanted = [1 + int((scores[i] > scores[i, i]).sum()) for i in range(n)]
    assert [r["rank"] for r in ranks.orderBy("k").collect()] == wanted
    accuracy = top_k_accuracy(ranks, 10).first()
    assert accuracy.accuracy == pytest.approx(np.mean([w <= 10 for w in wanted])) and accuracy.rows == n

    exact = item[movie] @ own.T
    losses = softmax_losses(rows.withColumn("position", F.col("k")), 25).orderBy("batch_id").collect()
    for b, row in enumerate(losses):
        part = exact[b * 25: (b + 1) * 25, b * 25: (b + 1) * 25]
        assert row.loss == pytest.approx((np.log(np.exp(part).sum(1)) - np.diag(part)).sum())
    assert [r.rows for r in losses] == [25, 25, 10]
    # One batch as large as the table, in blocks and in batches of queries smaller than it, with scores beyond exp's reach.
    large = rows.withColumn("query", F.transform("query", lambda x: x * 400)).withColumn("position", F.col("k") * 3)
    whole = softmax_losses(large, 10_000, block_rows=7, lookup_bytes=0).collect()
    part = 400 * exact
    top = part.max(1, keepdims=True)
    assert len(whole) == 1 and whole[0].rows == n
    assert whole[0].loss == pytest.approx((np.log(np.exp(part - top).sum(1)) + top[:, 0] - np.diag(part)).sum())


@pytest.mark.parametrize("side", ["post", "pre"])
@pytest.mark.parametrize("recency", [1.0, 0.5])
def test_history_vectors_by_lookup_and_by_join(shipped, side, recency):
    vectors = frame(shipped, "movie_id long, vector array<float>", [(i,) for i in range(1, 9)], RNG.normal(size=(8, 3)))
    known = {r.movie_id: np.array(r.vector) for r in vectors.collect()}
    histories = [[3, 1, 8], [2], [], [99], [5, 99, 5, 6]]
    rows = []
    for i, ids in enumerate(histories):
        pads = [0] * (5 - len(ids))
        rows.append((i, i * 10, ids + pads if side == "post" else pads + ids, len(ids)))
    df = shipped.createDataFrame(rows, "k long, c long, previous_movie_ids array<int>, history_len int")
    for limit in (10**6, 0):
        made = history_vectors(df, vectors, ("k",), 3, ("c",), recency, side, limit).orderBy("k").collect()
        assert [r.c for r in made] == [0, 10, 20, 30, 40]
        for row, ids in zip(made, histories):
            weights = [recency ** (len(ids) - 1 - at) if i in known else 0 for at, i in enumerate(ids)]
            mean = np.zeros(3)
            if sum(weights):
                mean = sum(w * known.get(i, np.zeros(3)) for w, i in zip(weights, ids)) / sum(weights)
            assert row.vector == pytest.approx(mean.tolist())


def test_encode_history_by_lookup_and_by_join(shipped):
    ids = shipped.createDataFrame([(70,), (10,), (30,), (10,), (None,)], "movie_id long")
    vocabulary = materialise(build_vocabulary(ids, "movie_id"), "vocabulary")
    assert [tuple(r) for r in vocabulary.orderBy("index").collect()] == [(10, 1), (30, 2), (70, 3)]
    df = shipped.createDataFrame([(1, [70, 10, 0]), (2, []), (3, [55, 30, 30])], "k long, previous_movie_ids array<int>")
    for limit in (10**6, 0):
        made = encode_history(df, vocabulary, ("k",), lookup_bytes=limit).orderBy("k").collect()
        assert [r.previous_movie_ids for r in made] == [[3, 1, 0], [], [0, 2, 2]]


def test_lookup_vectors_drops_or_fills(shipped):
    vectors = frame(shipped, "movie_id long, vector array<float>", [(1,)], [[1.0, 2.0]])
    df = shipped.createDataFrame([(1,), (2,)], "movie_id long")
    assert lookup_vectors(df, vectors).count() == 1
    assert {r.movie_id: r.query for r in lookup_vectors(df, vectors, width=2).collect()} == {1: [1, 2], 2: [0, 0]}


def test_batches(shipped):
    df = shipped.range(0, 1050, 1, 3)

    def sizes(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [len(batch)], "total": [batch["id"].sum()]})

    made = map_batches(df, sizes, "n long, total long", 100).collect()
    assert sorted(r.n for r in made) == [50] * 3 + [100] * 9
    assert sum(r.total for r in made) == sum(range(1050))
    assert take_batches(df, 100, 2).count() == 200


def test_planted_tastes(shipped):
    """Two groups of users who rate two disjoint sets of movies: the index must tell them apart."""
    half = F.col("user_id") % 2
    made = shipped.range(6000).select(
        F.col("id").alias("rating_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(120)).alias("user_id"),
        F.col("id"),
    ).select(
        "rating_id", "user_id",
        (half * 30 + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(30))).alias("movie_id"),
        F.timestamp_seconds(F.col("id") * 4000).cast("timestamp_ntz").alias("rating_timestamp_utc"),
        F.lit(4).alias("rating_score"),
        *[F.lit(True).alias(f) for f in (
            "user_eligible_for_trial", "user_has_payment_method", "user_subscriber", "user_trialist")],
    )
    films = movies(shipped, ids=range(60))
    vectors = materialise(fit_item_vectors(rating_base(made, films), width=8, iterations=5), "vectors")
    assert vectors.count() == 60
    inference = datasets.inference_dataset(made, films, keys=True)
    index = materialise(audience.audience_index(inference, vectors, 8), "index")
    best = audience.best_users(films, vectors, index, 10)
    fitting = best.select(F.avg((F.col("user_id") % 2 == F.floor(F.col("movie_id") / 30)).cast("int"))).first()[0]
    assert best.count() == 600 and fitting > 0.95

    train = materialise(datasets.train_dataset(made, films, keys=True), "train")
    found = training.evaluate_held_out(train, 500, 100, 250, width=8, iterations=5)
    metrics = {r.metric: r.value for r in found.collect()}
    assert metrics["rows"] == 500 and metrics["batches"] == 2
    # Ranked by how often their user occurs among the rows learned from, the same for every movie.
    rest, held = hold_out(train, ("rating_id", "matched_rating_id"), 500)
    often = rest.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    top = train.join(often, "user_id").orderBy(F.desc("n"), "rating_id", "matched_rating_id").limit(100)
    popularity = held.join(top.select("rating_id", "matched_rating_id"), ["rating_id", "matched_rating_id"]).count() / 500
    assert metrics["top_100_accuracy"] > popularity


def test_nothing_held_out_reaches_the_fit(shipped):
    """A movie that only a held-out row has gets no vector."""
    rows = [(i, i, i % 7, i % 5) for i in range(60)] + [(100, 100, 1, 99)]
    train = shipped.createDataFrame(rows, "rating_id long, matched_rating_id long, user_id long, movie_id long")
    for seed in range(200):
        cut = find_cut(train, ("rating_id", "matched_rating_id"), 5, seed)
        if train.where(cut.held_out & (F.col("movie_id") == 99)).count():
            break
    vectors = training.fit_on_rest(train, 5, width=4, iterations=2, seed=seed)
    assert {r.movie_id for r in vectors.collect()} == set(range(5))
    unanswered = audience.unanswered_movies(train, vectors)
    assert [r.movie_id for r in unanswered.collect()] == [99]


def test_repeated_ids_are_refused(shipped):
    twice = frame(shipped, "movie_id long, vector array<float>", [(1,), (1,)], [[1.0], [2.0]])
    df = shipped.createDataFrame([(1, [1, 1], 2)], "k long, previous_movie_ids array<int>, history_len int")
    for limit in (10**6, 0):
        with pytest.raises(ValueError, match="not unique"):
            history_vectors(df, twice, ("k",), 1, lookup_bytes=limit).collect()


def test_rows_with_one_key_stay_two(shipped):
    vectors = frame(shipped, "movie_id long, vector array<float>", [(1,), (2,)], [[1.0], [5.0]])
    df = shipped.createDataFrame([(1, [1], 1), (1, [2], 1)], "k long, previous_movie_ids array<int>, history_len int")
    for limit in (10**6, 0):
        made = history_vectors(df, vectors, ("k",), 1, lookup_bytes=limit).collect()
        assert sorted(r.vector[0] for r in made) == [1.0, 5.0]


def test_a_joined_history_has_the_same_vectors(shipped):
    """The road for large tables of items adds up in Python tasks, and gives the vectors of the other road."""
    items = frame(shipped, "movie_id long, vector array<float>", [(i,) for i in range(40)], RNG.normal(size=(40, 6)))
    histories = [(i, i % 7, [int(x) for x in RNG.integers(0, 50, 5)], int(RNG.integers(0, 6))) for i in range(300)]
    rows = shipped.createDataFrame(histories, "rating_id long, user_id long, previous_movie_ids array<int>, history_len int")
    for recency in (1.0, 0.5):
        near, far = (
            history_vectors(rows, items, ("rating_id",), 6, ("user_id",), recency, lookup_bytes=n) for n in (10**6, 0)
        )
        assert "MapInArrow" in far._jdf.queryExecution().executedPlan().toString()
        a, b = (sorted(df.collect()) for df in (near, far))
        assert [r[:2] for r in a] == [r[:2] for r in b]
        np.testing.assert_allclose([r.vector for r in a], [r.vector for r in b], rtol=1e-12, atol=1e-12)
        assert [0.0] * 6 in [r.vector for r in b]


def test_pairs_are_scored_where_they_lie(shipped):
    """With few item vectors, however large Spark takes their table to be, no row with vectors is exchanged."""
    items = frame(shipped, "movie_id long, vector array<float>", [(i,) for i in range(40)], RNG.normal(size=(40, 6)))
    pairs = [(i, i, int(RNG.integers(0, 50)), [int(x) for x in RNG.integers(0, 50, 5)], 5) for i in range(200)]
    train = shipped.createDataFrame(
        pairs, "rating_id long, matched_rating_id long, movie_id long, previous_movie_ids array<int>, history_len int"
    )
    shipped.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = audience.scored_pairs(train, items, 6)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        plain = lookup_vectors(history_vectors(train, items, audience.ROW_KEY, 6, ("movie_id",)), items, width=6)
        wanted = plain.select(*audience.ROW_KEY, "movie_id", "query", "vector", score().alias("score"))
        assert found.dtypes == wanted.dtypes and sorted(found.collect()) == sorted(wanted.collect())
    finally:
        shipped.conf.unset("spark.sql.autoBroadcastJoinThreshold")
