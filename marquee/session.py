"""The shared working folder of the cluster and the tables written there."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session may fall back to a fresh temporary folder; on a cluster that would be lost
    with the machine, so it is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-"))
    return context.getCheckpointDir()


_SCOPES: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())


def scratch_path(spark: SparkSession, label: str) -> str:
    scopes = _SCOPES.get()
    return f"{scopes[-1] if scopes else shared_dir(spark) + '/marquee'}/{uuid.uuid4().hex}/{label}"


@contextmanager
def scratch_scope(spark: SparkSession):
    """Tables stored inside are deleted at the end: for jobs whose results are written elsewhere by then."""
    root = f"{shared_dir(spark)}/marquee/scope-{uuid.uuid4().hex}"
    token = _SCOPES.set((*_SCOPES.get(), root))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Rows that a task stores at least, where it is known how many there are at most.
ROWS_PER_FILE = 250_000


def store(df: DataFrame, label: str, at_most: int | None = None) -> str:
    """Write ``df`` to the shared folder and return its path.

    ``at_most`` is a bound on its rows: a few rows then do not become a file for every partition of an exchange.
    """
    path = scratch_path(df.sparkSession, label)
    if at_most is not None:
        df = df.coalesce(max(1, math.ceil(at_most / ROWS_PER_FILE)))
    df.write.parquet(path)
    return path


def materialise(df: DataFrame, label: str, at_most: int | None = None) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and survives lost executors."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, label, at_most))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, for sessions not started with ``--py-files``."""
    context = spark.sparkContext
    if getattr(context, "_marquee_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="marquee-")) / "marquee"), "zip", root.parent, root.name
    )
    context.addPyFile(archive)
    context._marquee_shipped = True
