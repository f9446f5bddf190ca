"""Dense indices for ids, and encoding with them. Index 0 means unknown."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import SkewPolicy
from marquee.operators.lookup import LOOKUP_BYTES, broadcast_small, check_unique
from marquee.operators.skew import with_positions
from marquee.session import materialise


def build_vocabulary(ids: DataFrame, column: str, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """(column, index): the sorted distinct ids numbered from 1.

    The distinct ids are stored first, because counting and numbering them read them again.
    """
    distinct = materialise(ids.select(column).where(F.col(column).isNotNull()).distinct(), "distinct")
    numbered = with_positions(distinct, (), (column,), policy, distinct.count())
    return numbered.select(column, (F.col("position") + 1).alias("index"))


def encode_ids(df: DataFrame, vocabulary: DataFrame, column: str, into: str = "index") -> DataFrame:
    """Add the index of ``column``; unknown and null ids get 0."""
    names = vocabulary.select(F.col(column), F.col("index").alias(into))
    return df.join(names, column, "left").withColumn(into, F.coalesce(into, F.lit(0)))


def encode_history(
    df: DataFrame,
    vocabulary: DataFrame,
    row_key: Sequence[str],
    column: str = "previous_movie_ids",
    id_column: str = "movie_id",
    lookup_bytes: int = LOOKUP_BYTES,
) -> DataFrame:
    """(row key, column): each array with its ids replaced by indices, order and length kept.

    A vocabulary of at most ``lookup_bytes`` goes to every task and nothing is shuffled; a larger one is
    joined to the exploded arrays.
    """
    names = broadcast_small(vocabulary, id_column, "index", 8, lookup_bytes)
    if names is None:
        return _joined_encode_history(df, vocabulary, row_key, column, id_column)

    def encode(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = names.value
        for rows in chunks:
            arrays = rows[column].to_numpy()
            if not len(arrays):
                continue
            place, known = table.find(np.concatenate(arrays).astype(np.int64))
            found = table.values[place] if len(table.ids) else place
            indices = np.where(known, found, 0)
            ends = np.cumsum([len(a) for a in arrays])[:-1]
            yield rows[list(row_key)].assign(**{column: np.split(indices, ends)})

    fields = [df.schema[name] for name in row_key]
    schema = T.StructType([*fields, T.StructField(column, T.ArrayType(T.LongType()))])
    return df.select(*row_key, column).mapInPandas(encode, schema)


def _joined_encode_history(
    df: DataFrame, vocabulary: DataFrame, row_key: Sequence[str], column: str, id_column: str
) -> DataFrame:
    # Rows get a key of their own, as row keys may repeat. Pads are not joined: all of them are one value.
    pad = check_unique(vocabulary, id_column).where(F.col(id_column) == 0).first()
    fill = F.lit(0 if pad is None else pad["index"]).cast("long")
    size = F.coalesce(F.size(column), F.lit(0))
    entries = F.filter(
        F.transform(column, lambda x, i: F.struct(i.alias("_at"), x.cast("long").alias(id_column))),
        lambda x: x[id_column] != 0,
    )
    rows = df.select(
        F.monotonically_increasing_id().alias("_row"), *row_key, size.alias("_size"), entries.alias("_entries")
    )
    placed = rows.select("_row", *row_key, "_size", F.inline_outer("_entries"))
    encoded = encode_ids(placed, vocabulary, id_column)
    entry = F.when(F.col("_at").isNotNull(), F.struct("_at", "index"))
    arrays = encoded.groupBy("_row", *row_key, "_size").agg(F.map_from_entries(F.collect_list(entry)).alias("_found"))
    whole = F.transform(
        F.sequence(F.lit(0), F.col("_size") - 1), lambda i: F.coalesce(F.element_at("_found", i), fill)
    )
    return arrays.select(*row_key, F.when(F.col("_size") > 0, whole).otherwise(F.array()).alias(column))
