"""Parameters of the dataset builders, one frozen dataclass per concern."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class SkewPolicy:
    """Row bounds that decide when a group is too large for one task.

    ``max_group_rows``   a user with more rows is taken out of the plain window plan and cut into segments.
    ``segment_rows``     rows per segment of such a user, always more than one history length.
    ``range_rows``       rows per range partition while positions are numbered.
    ``task_rows``        rows that a task of a shuffle by user, segment or (user, movie) takes on average.
    ``pair_rows``        rows of one (user, movie) that a single join task may take on its probe side.
    ``broadcast_rows``   a key table is broadcast only when its counted rows stay at or under this.
    """

    max_group_rows: int = 10_000
    segment_rows: int = 10_000
    range_rows: int = 1_000_000
    task_rows: int = 100_000
    pair_rows: int = 2_000
    broadcast_rows: int = 1_000_000


@dataclass(frozen=True)
class SequenceConfig:
    """How ratings become histories. The defaults give the library variant of the datasets."""

    seq_length: int = 10  # width of the padded arrays
    history_len: int | None = None  # rows in the window frame, seq_length when unset
    min_history: int = 3  # shortest history kept, 0 keeps all
    pad_side: str = "post"  # 'post' or 'pre'
    gap_unit: str = "calendar"  # 'calendar' day boundaries or 'elapsed' 24-hour spans
    gap_order: str = "gap_desc"  # order of the gap lag: 'gap_desc' or 'time'
    rerate: str = "fanout"  # 'fanout' pairs every re-rating, 'by_rating' keeps one row per rating
    include_unrated: bool = False  # keep unscored ratings and fill them with the movie median
    skew: SkewPolicy = field(default_factory=SkewPolicy)

    def __post_init__(self) -> None:
        allowed = {
            "pad_side": ("post", "pre"),
            "gap_unit": ("calendar", "elapsed"),
            "gap_order": ("gap_desc", "time"),
            "rerate": ("fanout", "by_rating"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}, not {getattr(self, name)!r}")
        if self.seq_length < 1 or self.frame_len < 1:
            raise ValueError("seq_length and history_len must be at least 1")
        if self.skew.segment_rows <= self.frame_len:
            raise ValueError("segment_rows must exceed the history length")

    @property
    def frame_len(self) -> int:
        return self.seq_length if self.history_len is None else self.history_len

    def with_skew(self, **bounds: int) -> "SequenceConfig":
        return replace(self, skew=replace(self.skew, **bounds))


def hosted_variant(seq_length: int = 10, **changes) -> SequenceConfig:
    """The hosted variant: pads in front, and a frame of ten rows whatever ``seq_length`` is."""
    return SequenceConfig(seq_length=seq_length, history_len=10, pad_side="pre", **changes)
