"""Tables kept in buckets of a key: rows of one key lie in one bucket, sorted by it, and joins on the key move nothing.

A join of two tables with as many buckets reads bucket against bucket. The number and the key of the buckets are part of
a table's metadata, so a stored table is named in the session's catalogue when it is written or read; its files stay
where they are when the name is dropped. A join on the key and further columns needs the setting
``spark.sql.requireAllClusterKeysForCoPartition`` to be false.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marquee.sources.snapshots import refuse_existing

#: Buckets of a table, unless another number is given. A bucket is what one task of a join reads.
BUCKETS = 64


def _name() -> str:
    return f"marquee_buckets_{uuid.uuid4().hex}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write once, with one exchange: a task holds whole buckets. An existing table is an error."""
    refuse_existing(df.sparkSession, [path])
    name = _name()
    rows = df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).mode("errorifexists").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The table with what the plan has to know about its buckets; they have to be those it was written with."""
    name, quoted = _name(), path.replace("'", "\\'")
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
        f"LOCATION '{quoted}'"
    )
    return spark.table(name)
