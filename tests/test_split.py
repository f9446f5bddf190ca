import hashlib

import pytest
from pyspark.sql import functions as F

from marquee.operators import split
from marquee.operators.split import hold_out, shuffled, with_shuffle_position

KEYS = ("a", "b")


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select((F.col("id") / 7).cast("long").alias("a"), (F.col("id") % 7).alias("b")).persist()


def expected(rows, seed):
    def order(row):
        return (int(hashlib.md5(f"{row.a}:{row.b}:{seed}".encode()).hexdigest()[:12], 16), row.a, row.b)

    return [tuple(r) for r in sorted(rows.collect(), key=order)]


@pytest.mark.parametrize("n", [0, 1, 4, 1000, 2999, 3000, 9000])
@pytest.mark.parametrize("few", [1, 10_000])
def test_hold_out_is_exact_and_complete(rows, n, few, monkeypatch):
    monkeypatch.setattr(split, "FEW_ROWS", few)
    rest, held = hold_out(rows, KEYS, n)
    order = expected(rows, 42)
    assert {tuple(r) for r in held.collect()} == set(order[:n])
    assert {tuple(r) for r in rest.collect()} == set(order[n:])


def test_order_does_not_depend_on_partitions(rows):
    order = expected(rows, 7)
    assert [tuple(r) for r in shuffled(rows.repartition(5), KEYS, 7).collect()] == order
    placed = with_shuffle_position(rows, KEYS, 7).collect()
    assert {(r.a, r.b): r.shuffle_position for r in placed} == {key: i for i, key in enumerate(order)}
