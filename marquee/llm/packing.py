"""Packing of token ids into windows of a fixed capacity by Karmarkar-Karp multiway differencing.

A document's ids are cut at the capacity into full windows, one sequence each. What remains is cut into pieces
of bounded length, and blocks of pieces are partitioned: each piece starts as a partial partition of all windows
of the block, and the two partial partitions with the largest imbalance are merged, the fullest window of one
onto the emptiest of the other, until one partition is left. Its windows are near equal. If one exceeds the
capacity, the block gets one window more and is partitioned again.

Blocks are runs of rows of a partition, so no ids are shuffled and a task holds one block. Sequence numbers are
made of the partition's number and a count within it.

Defined cases: a null text counts as empty, and an empty document is its end mark alone; repeated rows are packed
each; ids may be null. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marquee.llm.common import give_back, kept_in_worker, ready, whole_text
from marquee.llm.pieces import PieceTable, word_values

CHUNK = 256
ID_BYTES = 4


@dataclass(frozen=True)
class PackPolicy:
    """Window capacity, the longest piece of a remainder, windows per block, and the id that ends a document.

    ``kept_pieces`` are the words whose ids a worker keeps in each of two generations, about 200 bytes each.
    """

    capacity: int = 2048
    longest_piece: int = 512
    block_windows: int = 48
    end_id: int = 1
    kept_pieces: int = 600_000


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Indexes of ``sizes`` in ``ways`` groups of near-equal sum."""
    if ways == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(ways - 1)]
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(ways, dtype=np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [i] + [None] * (ways - 1)))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, sums, members = heapq.heappop(heap)
        _, _, others, joined = heapq.heappop(heap)
        sums = sums + others[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        # A window's members are a tree of pairs, unfolded once at the end.
        merged = [b if a is None else a if b is None else (a, b) for a, b in zip(members, reversed(joined), strict=True)]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), turn, sums, [merged[i] for i in order.tolist()]))
        turn += 1
    return [unfold(tree) for tree in heap[0][3]]


def unfold(tree) -> list[int]:
    found, open_ = [], [] if tree is None else [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            open_ += node
        else:
            found.append(node)
    return sorted(found)


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Near-equal groups whose sums keep to the capacity, as few as differencing allows."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, ways)
        if max(sum(sizes[i] for i in group) for group in groups) <= capacity:
            return [group for group in groups if group]
        ways += 1


def _table(definition: str, kept: int) -> PieceTable:
    key = "ids", kept, hashlib.sha256(definition.encode()).hexdigest()
    return kept_in_worker(key, lambda: PieceTable(definition, "", lambda ids: struct.pack(f"<{len(ids)}I", *ids), limit=kept))


class _Packer:
    """Takes documents one after another and gives rows of pieces once a block is full."""

    def __init__(self, policy: PackPolicy, partition: int):
        self.policy, self.waiting, self.tokens = policy, [], 0
        self.next_id = partition << 40
        self.rows: list[tuple] = []

    def put(self, doc_id: int | None, ids: bytes) -> None:
        policy = self.policy
        total = len(ids) // ID_BYTES
        full = total - total % policy.capacity
        for start in range(0, full, policy.capacity):
            self.place([(doc_id, start, policy.capacity, total, ids)])
        rest = total - full
        count = -(-rest // policy.longest_piece)
        for part in range(count):  # equal parts, none longer than allowed
            start, stop = full + rest * part // count, full + rest * (part + 1) // count
            self.waiting.append((doc_id, start, stop - start, total, ids))
        self.tokens += rest
        if self.tokens >= policy.block_windows * policy.capacity:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            for group in windows_of([piece[2] for piece in self.waiting], self.policy.capacity):
                self.place([self.waiting[i] for i in group])
        self.waiting, self.tokens = [], 0

    def place(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, length, total, ids in pieces:
            own = ids[start * ID_BYTES: (start + length) * ID_BYTES]
            self.rows.append((doc_id, start, length, total, self.next_id, offset, own))
            offset += length
        self.next_id += 1

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long"


def pack(
    docs: DataFrame, definition: str, policy: PackPolicy = PackPolicy(), with_ids: bool = False
) -> DataFrame:
    """One row per piece: where it comes from, its sequence and place there, its checksum, its ids if wanted."""
    ready(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(definition)
    end = np.array([policy.end_id], dtype="<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 7
        own = columns.pop()
        arrays = [pa.array(values, pa.int64()) for values in columns]
        arrays.append(pa.array([zlib.crc32(ids) for ids in own], pa.int64()))
        names = [field.split()[0] for field in PIECES.split(", ")]
        if with_ids:
            ids = np.frombuffer(b"".join(own), dtype="<i4")
            ends = np.cumsum([0, *(len(x) // ID_BYTES for x in own)])
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _table(vocabulary.value, policy.kept_pieces)
        packer = _Packer(policy, TaskContext.get().partitionId())
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for first in range(0, len(doc_ids), CHUNK):
                values = word_values(texts.slice(first, CHUNK).to_pylist(), known)
                for doc_id, ids in zip(doc_ids[first: first + CHUNK], values, strict=True):
                    packer.put(doc_id, ids + end)
                yield batch_of(packer.take())
        packer.flush()
        yield batch_of(packer.take())
        give_back()

    schema = PIECES + ", ids array<int>" if with_ids else PIECES
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(packed, schema)
