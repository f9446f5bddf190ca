"""Small hand-written ratings and movies."""

from __future__ import annotations

import datetime

from marquee.sources.schemas import MOVIES, RATINGS


def day(n: float) -> datetime.datetime:
    return datetime.datetime(2024, 1, 1, 12) + datetime.timedelta(days=n)


def ratings(spark, rows):
    """Rows of (rating_id, user_id, movie_id, time, score)."""
    return spark.createDataFrame([(*row, None, True, False, None) for row in rows], RATINGS)


def movies(spark, ids=range(100), **changes):
    rows = {i: (i, f"movie {i}", 2000 + i % 20, "en") for i in ids}
    rows.update({row[0]: row for row in changes.get("rows", ())})
    return spark.createDataFrame(list(rows.values()), MOVIES)
