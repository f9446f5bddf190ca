"""The index in blocks gives what the whole one gives, and leaves blocks unread where directions part."""

import re

import numpy as np
import pytest

from marquee.operators.pruned_index import (
    BlockPolicy, PrunedIndex, read_pruned_index, top_k_pruned, write_pruned_index,
)
from marquee.operators.retrieval import top_k
from marquee.session import materialise, scratch_path, ship_package


@pytest.fixture(scope="module")
def shipped(spark):
    ship_package(spark)
    return spark


def rows_of(spark, vectors, users=None):
    users = range(len(vectors)) if users is None else users
    rows = [(int(u), i, [float(x) for x in v]) for i, (u, v) in enumerate(zip(users, vectors, strict=True))]
    return materialise(spark.createDataFrame(rows, "user_id long, rating_id long, vector array<float>").repartition(3), "index")


def asked(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "movie_id long, query array<double>")


def answers(found):
    return sorted((r.movie_id, r["rank"], r.user_id, r.score) for r in found.collect())


def stored(spark, index, policy) -> PrunedIndex:
    path = scratch_path(spark, "pruned")
    write_pruned_index(index, path, policy)
    return read_pruned_index(spark, path)


def test_planted_clusters_leave_blocks_unread(shipped):
    rng = np.random.default_rng(1)
    directions = np.linalg.qr(rng.normal(size=(12, 12)))[0][:10]
    vectors = np.concatenate([d * rng.uniform(1, 3, (60, 1)) + rng.normal(scale=0.02, size=(60, 12)) for d in directions])
    index = rows_of(shipped, vectors)
    pruned = stored(shipped, index, BlockPolicy(block_rows=60, iterations=20))
    queries = asked(shipped, directions[:2] + rng.normal(scale=0.01, size=(2, 12)))
    found = top_k_pruned(queries, pruned, 7)
    assert answers(found.best) == answers(top_k(queries, index, 7))
    assert pruned.n_blocks == found.blocks >= 8
    assert found.home_blocks + found.further_blocks <= found.blocks // 2 and found.scored_share < 0.5
    plan = found.best._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*block", plan)


@pytest.mark.parametrize("bounds", [(50_000, 64 * 1024 * 1024), (17, 0)])
@pytest.mark.parametrize("k", [1, 7, 400])
def test_random_vectors_lose_nothing(shipped, k, bounds):
    rng = np.random.default_rng(k)
    vectors = rng.normal(size=(300, 6)).round(1) * rng.choice([0.0, 0.3, 1, 5], size=(300, 1))  # ties, zeros, large norms
    index = rows_of(shipped, vectors, rng.integers(0, 40, 300))
    queries = asked(shipped, np.concatenate([rng.normal(size=(25, 6)).round(1), np.zeros((1, 6)), -np.ones((1, 6))]))
    found = top_k_pruned(queries, stored(shipped, index, BlockPolicy(block_rows=20)), k, *bounds)
    assert answers(found.best) == answers(top_k(queries, index, k))


def test_rows_alike_and_beyond_the_blocks_bound(shipped):
    """One direction for all rows, one user with most of them, and fewer blocks than rows ask for."""
    vectors = [[1.0, 2.0]] * 90 + [[0.0, 0.0]] * 5
    index = rows_of(shipped, vectors, [7] * 60 + list(range(35)))
    pruned = stored(shipped, index, BlockPolicy(block_rows=10, most_blocks=4))
    assert pruned.n_blocks <= 4
    queries = asked(shipped, [[1.0, 0.0], [-1.0, 0.0]])
    assert answers(top_k_pruned(queries, pruned, 3).best) == answers(top_k(queries, index, 3))


def test_nothing_asked_and_nothing_stored(shipped):
    index = rows_of(shipped, [[1.0, 0.0], [0.0, 1.0]])
    assert answers(top_k_pruned(asked(shipped, []), stored(shipped, index, BlockPolicy()), 3).best) == []
    nothing = stored(shipped, index.where("false"), BlockPolicy())
    assert answers(top_k_pruned(asked(shipped, [[1.0, 0.0]]), nothing, 3).best) == []


def test_candidates_are_read_once_and_nothing_goes_to_the_driver(shipped, monkeypatch):
    from pyspark.sql import DataFrame

    def refused(*_, **__):
        raise AssertionError("rows at the driver")

    index = rows_of(shipped, np.eye(4))
    queries = asked(shipped, np.eye(4))
    for name in ("toPandas", "collect", "toLocalIterator"):
        monkeypatch.setattr(DataFrame, name, refused)
    found = top_k(queries, index, 2, 2, 0)
    monkeypatch.undo()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Broadcast" not in plan
    assert len(answers(found)) == 8
