from marquee.sources.schemas import MOVIES, RATINGS, check_schema
from marquee.sources.snapshots import (
    SnapshotLayout, read_dataset, read_index, read_metrics, write_dataset, write_index, write_metrics,
)
from marquee.sources.tables import read_movies, read_ratings

__all__ = [
    "MOVIES", "RATINGS", "check_schema", "SnapshotLayout", "read_dataset", "read_index", "read_metrics",
    "write_dataset", "write_index", "write_metrics", "read_movies", "read_ratings",
]
