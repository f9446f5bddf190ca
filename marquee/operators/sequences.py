"""Day gaps and rating histories per user.

The result of the reference semantics is a fan-out: a rating appears once for every rating its user gave
the same movie, each copy with another shifted gap, and histories are windows over these copies. Here the
windows run over the ratings alone. A rating keeps

* ``context``: the last N history entries before it, built from bounded tails of the ratings before, and
* the shifted gaps of its (user, movie),

and the copies are made last, after row filters. The gaps of a whole (user, movie) are gathered after the
last sort and only then turned into copies; before that a rating carries at most N of them. Sequences that are stored
carry the whole pair where it has at most N ratings, so that only larger pairs are gathered anew when they are read.

Ratings are told apart by their place in a user's order, never by their id: a movie listed twice gives every
rating of it twice, on either of the two roads below.

Ordinary users take one shuffle on ``user_id``. Users above the row bound are cut into segments, and their
copies come from a salted join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.config import SequenceConfig, SkewPolicy
from marquee.functions import day_gap, newest
from marquee.operators.skew import (
    HotKeys, dealt, find_groups, join_counted, split_hot, with_positions, with_segments, without_lent_rows,
)
from marquee.session import materialise

USER = "user_id"
PAIR = ("user_id", "movie_id")
TIME = "rating_timestamp_utc"
#: A movie listed twice repeats its ratings; what its lines say then decides their order.
PAIR_ORDER = ("rating_id", "movie_release_year", "movie_title")
TIME_ORDER = (TIME, *PAIR_ORDER)
GAP = "days_since_last_rating"
LAST = "last_rating_timestamp"

RATING_COLUMNS = (
    "rating_id", "user_id", "movie_id", TIME, "rating_score",
    "user_eligible_for_trial", "user_has_payment_method", "user_subscriber", "user_trialist",
    "movie_title", "rating_value", "movie_release_year", GAP, LAST,
)


@dataclass(frozen=True)
class Sequences:
    """One row per rating with its context, ordinary users apart from oversized ones."""

    ordinary: DataFrame
    config: SequenceConfig
    ordinary_rows: int  # at most, as counted before the join with movies
    oversized: DataFrame | None = None
    matches: DataFrame | None = None  # the ratings that oversized ones are paired with
    oversized_rows: int = 0
    stored: bool = False  # read back, so no longer dealt by user; with 'pair_rows', and the matches of pairs of few ratings


def with_day_gaps(
    rows: DataFrame, unit: str, keys: Sequence[str] = (USER,), order: Sequence[str] = TIME_ORDER
) -> DataFrame:
    """Days since the user's rating before, -1 for the first."""
    previous = F.lag(TIME).over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(GAP, F.coalesce(day_gap(F.col(TIME), previous, unit), F.lit(-1)))


def with_shifted_gaps(
    rows: DataFrame, order: str, keys: Sequence[str] = (USER,), places: Sequence[str] = TIME_ORDER
) -> DataFrame:
    """The gap one row earlier, by falling gap or by time; 0 for the first in that order."""
    by = (F.desc(GAP), *places) if order == "gap_desc" else places
    shifted = F.lag(GAP).over(Window.partitionBy(*keys).orderBy(*by))
    return rows.withColumn("shifted_days", F.coalesce(shifted, F.lit(0)))


def with_shifted_gaps_by_value(rows: DataFrame, n_rows: int, policy: SkewPolicy) -> DataFrame:
    """As ``with_shifted_gaps`` by falling gap, without ordering a user's rows (which have a ``position``).

    Among rows of one user with equal gaps all but the first get that same gap, and the first gets the
    next larger gap. Only one row per (user, gap) is windowed, and days bound how many there are. ``n_rows`` is
    the number of rows.
    """
    larger = F.lag(GAP).over(Window.partitionBy(USER).orderBy(F.desc(GAP)))
    firsts = rows.groupBy(USER, GAP).agg(F.min("position").alias("position")).select(
        USER, "position", F.coalesce(larger, F.lit(0)).alias("larger")
    )
    places = (USER, "position")
    joined = dealt(rows, n_rows, policy, *places).join(dealt(firsts, n_rows, policy, *places), [*places], "left")
    return joined.withColumn("shifted_days", F.coalesce("larger", GAP)).drop("larger")


def rating_sequences(
    base: DataFrame, config: SequenceConfig, latest_only: bool = False, users: DataFrame | None = None, carry: bool = False
) -> Sequences:
    """Gaps, shifted gaps and context of every rating.

    ``latest_only`` lets the plan drop ratings that no history of a user's latest rating can reach.
    ``carry`` adds the matches of pairs of at most a frame of ratings, for sequences that are going to be stored.
    ``users`` is what oversized users are counted in, ``base`` itself when unset. The ratings before their
    join do as well: a column scan that can only count more.
    """
    base = base.where(F.col(USER).isNotNull())
    n, hot = find_groups(base if users is None else users, USER, config.skew)
    if hot is None:
        return Sequences(_ordinary(dealt(base, n, config.skew, USER), config, latest_only, carry), config, n)
    cold_rows, hot_rows = split_hot(base, USER, hot, config.skew)
    oversized = _oversized(hot_rows, hot, config, latest_only)
    ordinary = _ordinary(dealt(cold_rows, n, config.skew, USER), config, latest_only, carry)
    return Sequences(ordinary, config, n, *oversized, hot.rows)


def rating_gaps(sequences: Sequences) -> DataFrame:
    """One row per rating with its gap, its shifted gap and the user's last time."""
    wanted = [*RATING_COLUMNS, "shifted_days"]
    rows = sequences.ordinary.select(wanted)
    return rows if sequences.oversized is None else rows.unionByName(sequences.oversized.select(wanted))


def is_latest() -> Column:
    return F.col(TIME) == F.col(LAST)


def expand(
    sequences: Sequences, frame: str, keep: Column | None = None, last_only: bool = False
) -> DataFrame:
    """History rows: every rating (where ``keep`` holds) with each of its shifted gaps and the history there.

    ``frame`` 'train' ends before the row, 'inference' includes it. With ``last_only`` a user keeps the last
    of these rows alone, which is known before any copy is made: the last rating, with its last match.
    """
    if frame not in ("train", "inference"):
        raise ValueError(f"frame must be 'train' or 'inference', not {frame!r}")
    config = sequences.config
    ordinary = sequences.ordinary
    if last_only:
        keep = F.col("is_last") if keep is None else keep & F.col("is_last")
    if "matches" not in ordinary.columns:
        ordinary = _with_matches(ordinary, config)
    rows = _expand_ordinary(_kept(ordinary, keep).where("matches is not null"), frame, config, last_only)
    if sequences.stored and config.rerate == "fanout":
        large = sequences.ordinary.where(F.col("pair_rows") > config.frame_len)  # bounds of this column leave out row groups
        large = _with_matches(dealt(large, sequences.ordinary_rows, config.skew, USER), config)
        rows = rows.unionByName(_expand_ordinary(_kept(large, keep), frame, config, last_only))
    if sequences.oversized is not None:
        rows = rows.unionByName(_expand_oversized(sequences, keep, frame, last_only))
    return rows


def with_min_history(rows: DataFrame, least: int) -> DataFrame:
    return rows.where(F.col("history_len") >= least) if least > 0 else rows


def fanout_report(base: DataFrame) -> DataFrame:
    """Rows the fan-out will make, from pre-aggregated counts: read it before running it on skewed data."""
    pairs = base.where(F.col(USER).isNotNull()).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.sum("n").alias("ratings"),
        F.count(F.lit(1)).alias("pairs"),
        F.max("n").alias("largest_pair"),
        F.sum(F.col("n") * F.col("n")).alias("fanout_rows"),
    )


def _kept(rows: DataFrame, keep: Column | None) -> DataFrame:
    return rows if keep is None else rows.where(keep)


def _entries(gaps: Column) -> Column:
    """An entry per gap, zipped from repeated values: unlike a lambda, that is compiled."""
    own = [F.array_repeat(name, F.size(gaps)).alias(name) for name in ("movie_id", "movie_release_year", "rating_value")]
    return F.arrays_zip(*own, gaps.alias("shifted_days"))


def _with_context(
    rows: DataFrame, tail: Column, keys: Sequence[str], n: int, order: Sequence[str] = TIME_ORDER
) -> DataFrame:
    """The last ``n`` entries before a rating: every rating adds at least one, so ``n`` ratings suffice."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)
    rows = rows.withColumn("_tails", F.collect_list(tail).over(before))
    return rows.withColumn("context", newest(F.flatten("_tails"), n))


def _with_history(rows: DataFrame, own: Column, own_rows: Column, n: int) -> DataFrame:
    """Context and own copies joined to the last ``n`` entries, with the length known without building them."""
    return rows.select(
        *RATING_COLUMNS,
        "matched_rating_id",
        "shifted_days",
        F.least(F.size("context") + own_rows, F.lit(n)).alias("history_len"),
        newest(F.concat("context", _entries(own)), n).alias("history"),
    )


# --- ordinary users: every window below is satisfied by one hash exchange on user_id ---------------


def _ordinary(base: DataFrame, config: SequenceConfig, latest_only: bool, carry: bool) -> DataFrame:
    n = config.frame_len
    user = Window.partitionBy(USER).orderBy(*TIME_ORDER)
    rows = with_day_gaps(base, config.gap_unit)
    rows = rows.withColumns({  # in the order of the gaps, so all of them are one window
        "_nth": F.row_number().over(user), LAST: F.max(TIME).over(_whole(user)), "_n": F.count(F.lit(1)).over(_whole(user)),
    }).withColumn("is_last", F.col("_nth") == F.col("_n"))
    if latest_only:
        rows = rows.withColumn("_first_latest", F.min(F.when(is_latest(), F.col("_nth"))).over(_whole(user)))
    rows = with_shifted_gaps(rows, config.gap_order)
    tail, size = F.array(_match()), F.lit(1).cast("long")
    if config.rerate == "fanout":
        pair = Window.partitionBy(*PAIR).orderBy(*PAIR_ORDER)
        size = F.count(F.lit(1)).over(_whole(pair))  # in the same order, so nothing is sorted for it
        rows = rows.withColumn("_after", size - F.row_number().over(pair))
        late = F.when(F.col("_after") < n, _match() if carry else F.struct("shifted_days"))
        tail = F.collect_list(late).over(_whole(pair))
    rows = rows.withColumns({"_tail": tail, "pair_rows": size}).withColumn("tail", F.col("_tail").getField("shifted_days"))
    kept = [*RATING_COLUMNS, "is_last", "shifted_days", "context"]
    if latest_only:
        # The ratings that a movie was given before drop out here, so their gaps are gathered first. Of a
        # user's rows only the latest take them along.
        rows = _with_matches(rows, config).withColumn("matches", F.when(is_latest(), F.col("matches")))
        rows = rows.where(F.col("_nth") >= F.col("_first_latest") - n)
        kept.append("matches")
    elif carry:
        rows = rows.withColumn("matches", F.when(F.col("pair_rows") <= n, F.col("_tail")))
        kept += ["matches", "pair_rows"]
    return _with_context(rows, _entries(F.col("tail")), (USER,), n).select(*kept)


def _whole(window: Window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _match() -> Column:
    return F.struct(F.col("rating_id").alias("matched_rating_id"), F.col("shifted_days"))


def _with_matches(rows: DataFrame, config: SequenceConfig) -> DataFrame:
    """The ids and shifted gaps of all ratings of a rating's (user, movie): at most max_group_rows of them."""
    if config.rerate != "fanout":
        return rows.withColumn("matches", F.array(_match()))
    pair = Window.partitionBy(*PAIR).orderBy(*PAIR_ORDER)
    return rows.withColumn("matches", F.collect_list(_match()).over(_whole(pair)))


def _expand_ordinary(rows: DataFrame, frame: str, config: SequenceConfig, last_only: bool) -> DataFrame:
    n = config.frame_len
    rows = rows.drop("shifted_days")
    if last_only:
        last = F.size("matches") - 1
        copies = rows.select("*", last.alias("_copy"), F.get("matches", last).alias("_match"))
    else:
        copies = rows.select("*", F.posexplode("matches").alias("_copy", "_match"))
    through = F.col("_copy") + (0 if frame == "train" else 1)
    start = F.greatest(F.lit(1), through - (n - 1))
    # Sliced before its field is taken, so a copy costs no more than its history.
    own = F.slice("matches", start, F.least(through, F.lit(n))).getField("shifted_days")
    return _with_history(copies.select("*", "_match.*"), own, through, n)


# --- oversized users: segments instead of whole groups --------------------------------------------


def _oversized(
    base: DataFrame, hot: HotKeys, config: SequenceConfig, latest_only: bool
) -> tuple[DataFrame, DataFrame]:
    """Ratings with their context, and the ratings they match. With ``latest_only`` both are cut down early."""
    n, policy = config.frame_len, config.skew
    rows = with_positions(base, (USER,), TIME_ORDER, policy, hot.rows, hot.keys)
    lasts = rows.groupBy(USER).agg(F.max(TIME).alias(LAST), F.max("position").alias("_last"))
    segment = (USER, "segment")
    if latest_only:
        at_last = join_counted(rows, lasts, USER, "inner", hot.keys, policy).where(is_latest())
        lasts = at_last.groupBy(USER, LAST, "_last").agg(F.min("position").alias("_first_latest"))

    # The gap reaches one row back, and the gap of the row before reaches one further.
    cut = dealt(with_segments(rows, "position", policy, 2), hot.rows, policy, *segment)
    cut = with_day_gaps(cut, config.gap_unit, segment, ("position",))
    if config.gap_order == "time":
        cut = with_shifted_gaps(cut, "time", segment, ("position",))
    gaps = without_lent_rows(cut, "position", policy).drop("segment")
    if config.gap_order == "gap_desc":
        gaps = with_shifted_gaps_by_value(gaps, hot.rows, policy)
    gaps = join_counted(gaps, lasts, USER, "inner", hot.keys, policy)
    gaps = gaps.withColumn("is_last", F.col("position") == F.col("_last")).drop("_last")

    in_reach = F.col("position") >= F.col("_first_latest") - n if latest_only else F.lit(True)
    if config.rerate == "fanout":
        if latest_only:
            # Of older ratings only those matter whose movie a rating in reach has.
            near = join_counted(rows, lasts.drop("_last"), USER, "inner", hot.keys, policy).where(in_reach)
            gaps = gaps.join(near.select(*PAIR).distinct(), [*PAIR], "left_semi")
        gaps = _with_pair_gaps(gaps, hot, config)
    else:
        gaps = gaps.where(in_reach).withColumn("own", F.array("shifted_days")).withColumn("tail", F.col("own"))
        gaps = gaps.withColumns({"pair_rows": F.lit(1).cast("long"), "pair_position": F.lit(0).cast("long")})
    if latest_only:
        gaps = materialise(gaps, "matches")
    cut = dealt(with_segments(gaps.where(in_reach), "position", policy, n), hot.rows, policy, *segment)
    cut = _with_context(cut, _entries(F.col("tail")), segment, n, ("position",))
    kept = [*RATING_COLUMNS, "is_last", "shifted_days", "pair_position", "pair_rows", "own", "context"]
    rows = materialise(without_lent_rows(cut, "position", policy).select(*kept), "oversized")
    return rows, gaps if latest_only else rows


def _with_pair_gaps(rows: DataFrame, hot: HotKeys, config: SequenceConfig) -> DataFrame:
    """Per rating the last shifted gaps of its (user, movie) up to itself, and the pair's size and tail.

    A pair may be as large as its user, so it is numbered and cut into segments as well.
    """
    n, policy = config.frame_len, config.skew
    numbered = with_positions(rows, PAIR, PAIR_ORDER, policy, hot.rows, hot.rows, "pair_position")
    by_segment = (*PAIR, "pair_segment")
    cut = dealt(with_segments(numbered, "pair_position", policy, n, "pair_segment"), hot.rows, policy, *by_segment)
    up_to_here = Window.partitionBy(*by_segment).orderBy("pair_position").rowsBetween(-n, 0)
    cut = cut.withColumn("own", F.collect_list("shifted_days").over(up_to_here))
    own = without_lent_rows(cut, "pair_position", policy, "pair_segment")
    pairs = own.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("pair_rows"), newest(F.max_by("own", "pair_position"), n).alias("tail")
    )
    last_segment = F.floor((F.col("pair_rows") - 1) / policy.segment_rows).cast("long")
    per_segment = pairs.withColumn("pair_segment", F.explode(F.sequence(F.lit(0).cast("long"), last_segment)))
    # Segments are no more than ratings, and the windows above have dealt those by the same keys.
    return own.join(dealt(per_segment, hot.rows, policy, *by_segment), [*by_segment]).drop("pair_segment")


def _expand_oversized(
    sequences: Sequences, keep: Column | None, frame: str, last_only: bool
) -> DataFrame:
    config = sequences.config
    n, policy = config.frame_len, config.skew
    kept = _kept(sequences.oversized, keep)
    if config.rerate == "fanout":
        # Both sides go into blocks of pair_rows, so no join key holds more copies than its square.
        block = F.floor(F.col("pair_position") / policy.pair_rows).cast("long")
        last_block = F.floor((F.col("pair_rows") - 1) / policy.pair_rows).cast("long")
        blocks = F.explode(F.sequence(F.lit(0).cast("long"), last_block))
        left = kept.withColumn("_left", block).withColumn("_right", blocks)
        matches = sequences.matches
        if last_only:
            matches = matches.where(F.col("pair_position") == F.col("pair_rows") - 1)
        right = matches.select(
            *PAIR, F.col("rating_id").alias("matched_rating_id"), "shifted_days", "own",
            block.alias("_right"), blocks.alias("_left"),
        )
        by_block, rows = (*PAIR, "_left", "_right"), sequences.oversized_rows
        left = left.drop("shifted_days", "own")
        copies = dealt(left, rows, policy, *by_block).join(dealt(right, rows, policy, *by_block), [*by_block])
    else:
        copies = kept.withColumn("matched_rating_id", F.col("rating_id"))
    # 'own' ends with the row itself; a training history stops one entry earlier.
    own_rows = F.size("own") - (1 if frame == "train" else 0)
    return _with_history(copies, F.slice("own", F.lit(1), own_rows), own_rows, n)
