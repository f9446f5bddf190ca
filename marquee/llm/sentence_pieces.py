"""SentencePiece ids and decoded texts by a table of distinct marked words.

SentencePiece writes a space as a marker before the word that follows. Where no vocabulary entry goes on from another
character into a marker, no merge can cross the start of a run of markers: a text is the sequence of its chunks (a run
of markers and what follows up to the next run), and each chunk has the same ids wherever it stands.

1. Texts are read once, in blocks of about ``block_bytes``. A block numbers its distinct chunks, most frequent first, and
   writes its texts as chunk numbers. One exchange deals the texts by block, and the distinct chunks in packed rows by
   word hash, in as many buckets as the size of all texts asks for.
2. The table of distinct chunks: every block's occurrence of a chunk meets in the task of its bucket, which has the
   library segment it once and answers each block. A chunk counts once per block here, however frequent it is, so no
   word makes a bucket heavy.
3. Answers go back to their block and ids are joined to the texts by position; the library decodes each chunk of the
   block from its ids.

What a task holds is bounded by a block in steps 1 and 3. In step 2 it is the distinct chunks of a partition, at most
``table_words`` of them: beyond that the table starts anew, which costs time and changes nothing.

Vocabularies that merge across markers or normalise texts are refused. Defined cases: null and empty texts have no
chunks, so their ids are begin and end alone; a literal marker character counts as a space, as the library has it;
repeated rows and null ids are encoded each. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import drop_kept, give_back, kept_in_worker, ready, shuffle_partitions, whole_text

#: What SentencePiece writes for a space.
MARKER = "▁"
_CHUNK = re.compile(rb" +[^ ]*")


@dataclass(frozen=True)
class ChunkTablePolicy:
    """Bytes of text in a block, and for each bucket of chunks; rows packed together, chunks segmented or decoded at a
    time, chunks in a task's table."""

    block_bytes: int = 8 * 1024 * 1024
    bucket_bytes: int = 4 * 1024 * 1024
    pack_rows: int = 1_000
    batch: int = 8_192
    table_words: int = 1_000_000


class Pieces:
    """The library's processor, and what it says about chunks."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)

    @cached_property
    def lone_marker(self) -> list[int]:
        """Ids of a marker that nothing follows; the library adds one before every text but an empty one."""
        word, spaced = self.model.encode(["x", "x "])
        return spaced[len(word):]

    def ids(self, bodies: list[bytes]) -> list[list[int]]:
        """Ids of chunks, each given as what follows its first marker."""
        texts = [body.decode("utf-8", "replace") for body in bodies]
        found = self.model.encode(texts, num_threads=1)
        return [own if text else self.lone_marker for text, own in zip(texts, found, strict=True)]

    def texts(self, ids: list[list[int]]) -> list[bytes]:
        """Decoded chunks; decoding drops the first marker of what it is given, so the space is put back."""
        return [b" " + text.encode() for text in self.model.decode(ids, num_threads=1)]


def refuse_crossing_pieces(model: bytes) -> None:
    """Raise unless chunks are segmented alike wherever they stand."""
    from sentencepiece import sentencepiece_model_pb2

    parsed = sentencepiece_model_pb2.ModelProto()
    parsed.ParseFromString(model)
    rules = parsed.normalizer_spec
    if (
        rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces
        or not rules.escape_whitespaces or parsed.trainer_spec.treat_whitespace_as_suffix
    ):
        raise ValueError("the vocabulary changes texts or does not mark words at their start")
    crossing = re.compile(f"[^{MARKER}]{MARKER}")
    if any(crossing.search(piece.piece) for piece in parsed.pieces):
        raise ValueError("pieces of the vocabulary cross whitespace markers")


def bodies(data: bytes) -> list[bytes]:
    """The chunks of a text, each without its first marker and with spaces for markers."""
    if not data:
        return []
    data = data.replace(MARKER.encode(), b" ")
    if b"  " in data or data[0] == 32 or data[-1] == 32:
        return [chunk[1:] for chunk in _CHUNK.findall(b" " + data)]
    return data.split(b" ")


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as four planes of bytes, the upper ones mostly zeros."""
    return np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


#: Compression of what is moved once or twice and read once.
LEVEL = 4


def pack_numbers(numbers: np.ndarray) -> bytes:
    return zlib.compress(planes(numbers), LEVEL)


def unpack_numbers(data: bytes) -> np.ndarray:
    return from_planes(zlib.decompress(data))


def pack(parts: list[bytes]) -> bytes:
    """Byte strings: their number, their lengths and their joined bytes."""
    sizes = np.fromiter(map(len, parts), dtype=np.uint32, count=len(parts))
    return zlib.compress(struct.pack("<I", len(parts)) + planes(sizes) + b"".join(parts), LEVEL)


def unpack(data: bytes) -> list[bytes]:
    raw = zlib.decompress(data)
    begin = 4 + 4 * struct.unpack_from("<I", raw)[0]
    ends = begin + np.cumsum(from_planes(raw[4:begin]), dtype=np.int64)
    starts = [begin, *ends.tolist()]
    return [raw[a:b] for a, b in zip(starts, starts[1:], strict=False)]


def pack_lists(parts: list[np.ndarray]) -> bytes:
    """Lists of ids: their lengths, then all ids, each as planes."""
    sizes = np.fromiter(map(len, parts), dtype=np.uint32, count=len(parts))
    flat = np.concatenate([np.zeros(0, dtype="<u4"), *parts])
    return zlib.compress(struct.pack("<I", len(parts)) + planes(sizes) + planes(flat), LEVEL)


def unpack_lists(data: bytes) -> list[bytes]:
    """The lists as bytes, four for each id."""
    raw = zlib.decompress(data)
    begin = 4 + 4 * struct.unpack_from("<I", raw)[0]
    ends = 4 * np.cumsum(from_planes(raw[4:begin]), dtype=np.int64)
    ids, starts = from_planes(raw[begin:]).astype("<u4").tobytes(), [0, *ends.tolist()]
    return [ids[a:b] for a, b in zip(starts, starts[1:], strict=False)]


class _Numbers(dict):
    """Chunk numbers in order of appearance."""

    def __missing__(self, body: bytes) -> int:
        self[body] = number = len(self)
        return number


class Block:
    """Texts as numbers of chunks, and the distinct chunks.

    Chunks of several occurrences are numbered from 1 by frequency. Those of a single one come after them, in order of
    appearance, and the texts say 0 for each: the first 0 of a block is the first of them.
    """

    def __init__(self):
        self.numbers, self.docs, self.codes, self.size = _Numbers(), [], [], 0

    def add(self, doc_id: int | None, data: bytes) -> None:
        own = bodies(data)
        self.docs.append(doc_id)
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, own), dtype=np.uint32, count=len(own)))
        self.size += len(data)

    def rows(self, block: str, policy: ChunkTablePolicy, buckets: int) -> Iterator[tuple]:
        """Rows of ``CODED``: texts, packed together, and the block's chunks of one bucket each."""
        flat = np.concatenate([np.zeros(0, dtype=np.uint32), *self.codes])
        uses = np.bincount(flat, minlength=len(self.numbers))
        order = np.argsort(np.where(uses > 1, -uses, 0), kind="stable")
        several = int((uses > 1).sum())
        code = np.empty(len(uses) + 1, dtype=np.int64)
        code[order] = np.arange(len(order)) + 1
        code[order[several:]] = 0
        known = list(self.numbers)
        hashes = np.fromiter((zlib.crc32(body) for body in known), dtype=np.int64, count=len(known))
        bucket = (hashes % buckets)[order]
        at = 0
        for start in range(0, len(self.docs), policy.pack_rows):
            lengths = [len(codes) for codes in self.codes[start: start + policy.pack_rows]]
            end = at + sum(lengths)
            # The first row of a block also says which bucket each number went to.
            numbers = pack_numbers(np.concatenate([np.array(lengths), bucket]) if start == 0 else np.array(lengths))
            yield block, None, block, start, self.docs[start: start + policy.pack_rows], numbers, pack_numbers(code[flat[at:end]])
            at = end
        by_bucket = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by_bucket], prepend=-1, append=-1))
        for start, stop in zip(cuts, cuts[1:], strict=False):
            own = order[by_bucket[start:stop]]
            number = int(bucket[by_bucket[start]])
            yield str(number), number, block, 0, None, None, pack([known[i] for i in own])


#: ``place`` deals texts by block and chunks by bucket in one exchange.
CODED = T.StructType([
    T.StructField("place", T.StringType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("block", T.StringType()),
    T.StructField("first", T.LongType()),
    T.StructField("docs", T.ArrayType(T.LongType())),
    T.StructField("numbers", T.BinaryType()),
    T.StructField("payload", T.BinaryType()),
])
_KINDS = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())


def _batch(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def coded_blocks(docs: DataFrame, policy: ChunkTablePolicy, buckets: int) -> DataFrame:
    """Blocks of texts as chunk numbers, and their distinct chunks by bucket, dealt by ``place``."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, made, part = Block(), 0, None
        drop_kept()
        for batch in batches:
            for doc_id, data, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                block.add(doc_id, data.as_py())
                if block.size >= policy.block_bytes:
                    for row in block.rows(f"{part}-{made}", policy, buckets):
                        yield _batch([row], CODED.names, _KINDS)
                    block, made = Block(), made + 1
        if block.docs:
            for row in block.rows(f"{part}-{made}", policy, buckets):
                yield _batch([row], CODED.names, _KINDS)
        give_back()

    texts = docs.select("doc_id", whole_text().cast("binary").alias("data"), F.spark_partition_id().alias("part"))
    return texts.mapInArrow(code, CODED).repartition(shuffle_partitions(docs.sparkSession), "place")


def _pieces(model: bytes) -> Pieces:
    """A worker's processor outlives its tasks."""
    return kept_in_worker(("pieces", hashlib.sha256(model).hexdigest()), lambda: Pieces(model))


def answered(coded: DataFrame, sent, policy: ChunkTablePolicy) -> DataFrame:
    """(block, answers, ids): ids of each block's chunks by bucket. A chunk is segmented in the one task of its bucket."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent.value)
        table: dict[bytes, np.ndarray] = {}
        for batch in batches:
            chunks = batch.filter(batch.column("bucket").is_valid())
            for bucket, block, payload in zip(*(chunks.column(c).to_pylist() for c in ("bucket", "block", "payload")), strict=True):
                words = unpack(payload)
                missing = [word for word in words if word not in table]
                for start in range(0, len(missing), policy.batch):
                    new = missing[start: start + policy.batch]
                    table.update((word, np.array(ids, dtype="<u4")) for word, ids in zip(new, pieces.ids(new), strict=True))
                row = block, bucket, pack_lists([table[word] for word in words])
                yield _batch([row], ["block", "answers", "ids"], (pa.string(), pa.int32(), pa.binary()))
                if len(table) > policy.table_words:
                    table = {}
        give_back()

    return coded.mapInArrow(segment, "block string, answers int, ids binary")


def ids_by_number(bucket_of: np.ndarray, answers: list[tuple[int, bytes]]) -> list[bytes]:
    """Ids of a block's chunks by their number, from (bucket, packed ids) and the bucket of each number."""
    found = [ids for _, packed in sorted(answers) for ids in unpack_lists(packed)]
    if len(found) != len(bucket_of):
        raise RuntimeError("the answers to a block are not those of its chunks")
    ids: list[bytes] = [b""] * len(found)
    for number, own in zip(np.argsort(bucket_of, kind="stable").tolist(), found, strict=True):
        ids[number] = own
    return ids


def encode(
    docs: DataFrame, model: bytes, policy: ChunkTablePolicy = ChunkTablePolicy(), with_ids: bool = False, with_text: bool = False
) -> DataFrame:
    """Per document: id, number of ids with begin and end, SHA-256 of the ids and of the decoded text.

    ``with_ids`` adds the ids, ``with_text`` the decoded text. ``model`` is the content of the model file.
    """
    spark = docs.sparkSession
    ready(spark)
    refuse_crossing_pieces(model)
    total = docs.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0
    buckets = max(1, math.ceil(total / policy.bucket_bytes))
    sent = spark.sparkContext.broadcast(model)
    coded = coded_blocks(docs, policy, buckets)
    answers = answered(coded, sent, policy)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    kinds += [pa.list_(pa.int32())] * with_ids + [pa.string()] * with_text
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded"] * with_text

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = _pieces(sent.value)
        columns: list[list] = [[] for _ in kinds]
        if left["bucket"][0].is_valid:  # chunks, which have their answers
            return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        left = left.sort_by("first")
        numbers = [unpack_numbers(packed.as_py()) for packed in left["numbers"]]
        rows_in = [len(own) for own in left["docs"]]
        answers = list(zip(right["answers"].to_pylist(), right["ids"].to_pylist(), strict=True))
        ids_of = ids_by_number(numbers[0][rows_in[0]:], answers)
        numbers[0] = numbers[0][: rows_in[0]]
        text_of: list[bytes] = []
        for start in range(0, len(ids_of), policy.batch):
            part = [np.frombuffer(ids, dtype="<u4").tolist() for ids in ids_of[start: start + policy.batch]]
            text_of += pieces.texts(part)
        begin, end = (struct.pack("<I", i) for i in (pieces.model.bos_id(), pieces.model.eos_id()))
        codes = [unpack_numbers(packed.as_py()) for packed in left["payload"]]
        # Single occurrences have the last numbers, in the order of the block.
        single = len(ids_of) - sum(int((own == 0).sum()) for own in codes)
        for doc_ids, lengths, own in zip(left["docs"], numbers, codes, strict=True):
            zeros = own == 0
            own = np.where(zeros, single + np.cumsum(zeros) - 1, own.astype(np.int64) - 1)
            single, at = single + int(zeros.sum()), 0
            own = own.tolist()
            for doc_id, length in zip(doc_ids.as_py(), lengths.tolist(), strict=True):
                chunks, at = own[at: at + length], at + length
                ids = begin + b"".join(map(ids_of.__getitem__, chunks)) + end
                # The marker before the first word is none of the text's.
                text = b"".join(map(text_of.__getitem__, chunks))[1:]
                row = [doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()]
                row += [np.frombuffer(ids, dtype="<i4")] * with_ids + [text.decode()] * with_text
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    # Both sides use the blocks whole, so that they read one exchange: texts are cut once, and block names are one.
    return coded.groupBy("place").cogroup(answers.groupBy("block")).applyInArrow(assemble, schema)
