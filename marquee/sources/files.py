"""Single files in whatever store Spark writes to: made once, moved without replacing, listed, read."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _located(spark, path)
    return system.exists(place)


def _refused(problem: Py4JJavaError, path: str) -> Exception:
    """An existing target is told apart from other trouble by the name of the Java error or by its words."""
    words = str(problem.java_exception)
    return FileExistsError(f"{path} already exists") if "AlreadyExists" in words or "already exists" in words else problem


def create_new(spark: SparkSession, path: str, content: str) -> None:
    """Write a file that must not be there yet."""
    place, system = _located(spark, path)
    try:
        stream = system.create(place, False)
    except Py4JJavaError as problem:
        raise _refused(problem, path) from None
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, content: str) -> None:
    """Write a file that must not be there yet, so that readers find all of it or none."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    create_new(spark, draft, content)
    jvm, (source, system), (target, _) = spark.sparkContext._jvm, _located(spark, draft), _located(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.makeQualified(source).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(source), system.makeQualified(target), options)
    except Py4JJavaError as problem:
        system.delete(source, False)
        raise _refused(problem, path) from None


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def list_files(spark: SparkSession, folder: str) -> dict[str, int]:
    """Bytes of each data file below a folder, by its path there. Names that begin with _ or . are none of the data."""
    place, system = _located(spark, folder)
    root = system.makeQualified(place).toString()
    found, files = {}, system.listFiles(place, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString().removeprefix(root).lstrip("/")
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            found[name] = status.getLen()
    return found


def delete(spark: SparkSession, path: str) -> None:
    place, system = _located(spark, path)
    system.delete(place, True)
