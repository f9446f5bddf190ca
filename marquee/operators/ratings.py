"""The rating base: scored ratings joined to movies, with nulls filled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.sources.schemas import FLAGS


def movie_medians(ratings: DataFrame) -> DataFrame:
    """Discrete median score per movie.

    A grouped aggregate: each task sends one count per distinct score of a movie, however many ratings it has.
    """
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY rating_score)")
    return usable_ratings(ratings).groupBy("movie_id").agg(median.cast("int").alias("median_score"))


def usable_ratings(ratings: DataFrame, include_unrated: bool = False) -> DataFrame:
    return ratings if include_unrated else ratings.where(F.col("rating_score").isNotNull())


def rating_base(
    ratings: DataFrame, movies: DataFrame, include_unrated: bool = False, medians: DataFrame | None = None
) -> DataFrame:
    """Ratings of known movies, one row each.

    Without ``include_unrated`` only scored ratings stay and no median is computed. With it, a null
    score becomes the movie's median, and stays null where the movie has no score at all. The median
    joins the movies first, so the ratings go through one join either way. ``medians`` are those of
    ``ratings`` unless given, which is for a part of the ratings.
    """
    if include_unrated:
        movies = movies.join(movie_medians(ratings) if medians is None else medians, "movie_id", "left")
        value = F.coalesce("rating_score", "median_score")
    else:
        value = F.col("rating_score")
    return usable_ratings(ratings, include_unrated).join(movies, "movie_id").select(
        "rating_id",
        "user_id",
        "movie_id",
        "rating_timestamp_utc",
        "rating_score",
        *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in FLAGS],
        "movie_title",
        value.alias("rating_value"),
        F.coalesce("movie_release_year", F.lit(0)).alias("movie_release_year"),
        "movie_title_language",
    )


def rated_movies(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Id and title of every movie with a rating, scored or not. Ratings shrink to their ids before the join."""
    rated = ratings.select("movie_id").distinct()
    return movies.select("movie_id", "movie_title").join(rated, "movie_id", "left_semi").distinct()
