"""What several operators share: reading texts, row keys, and models sent to every task."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.stored import stored_batches
from marquee.session import materialise, ship_package, store

ROW = "_key"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_pass_key(df: DataFrame) -> DataFrame:
    """Give every row a key of its own for one pass over the table, or until it is stored: another pass may give others."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


#: Steps of a plan that keep each row of a file the one row it is.
_KEEPS_ROWS = {"Project", "Filter", "SubqueryAlias", "View"}
_HIDDEN = "_metadata"


def has_places(df: DataFrame) -> bool:
    """Are the rows those of parquet files, at most filtered and with other columns?"""
    node = df._jdf.queryExecution().analyzed()
    if not node.deterministic():
        return False
    while node.nodeName() in _KEEPS_ROWS:
        node = node.children().apply(0)
    if node.nodeName() != "LogicalRelation" or "HadoopFsRelation" not in node.relation().getClass().getName():
        return False
    names = {name.lower() for name in node.relation().schema().fieldNames()}
    return node.relation().fileFormat().toString() == "Parquet" and _HIDDEN not in names


def addressable(df: DataFrame) -> DataFrame:
    """A table whose rows have a place in a file: the table itself if it is read from parquet files, else a stored copy."""
    if has_places(df):
        return df
    if _HIDDEN in (name.lower() for name in df.columns):
        raise ValueError(f"a column named {_HIDDEN} hides the places of rows in their files; rename it")
    return materialise(df, "rows")


def _path_text(path: str) -> str:
    """One way to write an address that may have an empty authority."""
    return re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", path)


def _window(paths: list[str]) -> tuple[int, int]:
    """Place and width of the bits that tell the hashes of all paths apart."""
    hashes = [xxhash.xxh64_intdigest(_path_text(path).encode(), seed=42) for path in paths]
    width = max(1, 2 * math.ceil(math.log2(max(2, len(set(hashes))))))
    for bits in range(width, 64):
        for shift in range(64 - bits):
            if len({hashed >> shift & (1 << bits) - 1 for hashed in hashes}) == len(hashes):
                return shift, bits
    raise ValueError("paths of files share their hashes")


def with_row_key(df: DataFrame, name: str = ROW) -> DataFrame:
    """Give every row the key that its file and its place there make, the same one however the files are read.

    How many rows a task reads, and so any number counted along tasks, follows the cores of the moment; files and places
    do not. The table has to be an ``addressable`` one. Of the 63 bits of a key some tell files apart, as many as it
    takes, and the others are the row's place in its file.
    """
    if not has_places(df):
        raise ValueError("rows without a place in a file have no lasting key: store the table first")
    shift, bits = _window(df.inputFiles())
    path = F.regexp_replace("_metadata.file_path", "^([A-Za-z0-9+.-]+):/+", "$1:/")
    file = F.shiftrightunsigned(F.xxhash64(path), shift).bitwiseAND(F.lit((1 << bits) - 1))
    place = F.col("_metadata.row_index")
    fits = F.when(place < 1 << (63 - bits), place).otherwise(F.raise_error(F.lit("a file holds too many rows")).cast("long"))
    return df.select("*", F.shiftleft(file, 63 - bits).bitwiseOR(fits).alias(name))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken = {name.lower() for name in df.columns}
    while wanted in taken:
        wanted = f"_{wanted}"
    return wanted


#: Keys that may be broadcast: 8 bytes each, a few times that in a hash table.
BROADCAST_KEYS = 1_000_000
#: Keys read together by a task that looks for them.
KEYS_AT_ONCE = 65_536


def without_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The addressable table without the rows of the given row keys; few keys go to where the rows lie."""
    key = free_name(docs, ROW)
    dropped = materialise(keys.select(F.col(ROW).alias(key)), "dropped_keys")
    if dropped.count() <= BROADCAST_KEYS:
        dropped = F.broadcast(dropped)
    named = [F.col(f"`{name}`") for name in docs.columns]
    return with_row_key(docs, key).join(dropped, key, "left_anti").select(*named)


def rows_at(keyed: DataFrame, wanted: DataFrame, most_sent: int = BROADCAST_KEYS) -> DataFrame:
    """Rows of a keyed table whose key is among the wanted ones (a stored table of distinct keys), found where they lie.

    Few keys are sent to every task. More of them are stored in order, and a task reads for each batch those between its
    smallest and its largest key; rows of a file have neighbouring keys, so it reads few others. Texts are never shuffled.
    """
    spark = keyed.sparkSession
    if wanted.count() <= most_sent:
        return keyed.join(F.broadcast(wanted.select(ROW)), ROW, "left_semi").select(*keyed.columns)
    path = store(wanted.select(ROW).repartitionByRange(shuffle_partitions(spark), ROW).sortWithinPartitions(ROW), "wanted_in_order")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = batch.column(ROW).to_numpy()
                between = (pyarrow.dataset.field(ROW) >= int(keys.min())) & (pyarrow.dataset.field(ROW) <= int(keys.max()))
                found = [b.column(0).to_numpy() for b in stored_batches(path, KEYS_AT_ONCE, [ROW], between)]
                hits = np.isin(keys, np.concatenate([np.zeros(0, dtype=np.int64), *found]))
                if hits.any():
                    yield batch.filter(pa.array(hits))

    return keyed.mapInArrow(find, keyed.schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows per Arrow batch: texts are long, and the engine's 10,000 of them may be gigabytes.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def ready(spark: SparkSession) -> None:
    """What Python work on texts needs: the package at the workers, and batches that stay small."""
    ship_package(spark)
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


#: What a worker keeps from task to task. Other operators in the same worker drop it first.
_KEPT: dict = {}


def kept_in_worker(key, make: Callable):
    """The worker's object for ``key``, made at first; whatever another operator kept is dropped."""
    if key not in _KEPT:
        drop_kept()
        _KEPT[key] = make()
    return _KEPT[key]


def drop_kept() -> None:
    if _KEPT:
        _KEPT.clear()
        give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker idles between stages, and its allocators would keep theirs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


#: Texts turned into Python strings at a time: a batch of long texts would take several times its size.
TEXTS_AT_ONCE = 256


def in_parts(texts: pa.Array) -> Iterator[str]:
    """The texts of a batch one after another, with few of them as Python strings at any time."""
    drop_kept()
    for start in range(0, len(texts), TEXTS_AT_ONCE):
        yield from texts.slice(start, TEXTS_AT_ONCE).to_pylist()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch after each other, and where each begins (one more entry than texts)."""
    drop_kept()
    wide = texts.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[wide.offset: wide.offset + len(wide) + 1]
    if data is None or len(wide) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(wide) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0]: bounds[-1]], bounds - bounds[0]


def load_tokenizer(definition: str):
    """A tokenizer from the text of its JSON file, single-threaded: Spark already keeps every core busy."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


#: A tokenizer definition is broadcast to every task; the public ones take 2 to 4 MB.
DEFINITION_BYTES = 64 * 1024 * 1024


def read_definition(path: str) -> str:
    """The vocabulary file's text, read on the driver so that executors need no copy of the file."""
    if os.path.getsize(path) > DEFINITION_BYTES:
        raise ValueError(f"{path} is too large to send to every task")
    with open(path, encoding="utf-8") as file:
        return file.read()
