"""Fill-in-the-middle transformation by secondary sort.

A text is cut into units (runs of A-Z and a-z, or single other code points), and two unit numbers drawn from a
hash of its id bound its prefix, middle and suffix. Each segment leaves as pieces of at most ``chunk_units``
units, keyed by document and output position. ``repartitionAndSortWithinPartitions`` brings the pieces of a
document together in output order, so the output streams through an incremental digest (or to a text) and no task
holds more than its sorter does. For restoration the same pieces get the position that their marker gives them and
are sorted again: the partitioner is the same, so the second sort moves nothing between tasks.

Defined cases: a null text counts as empty and stays plain, like a text that holds one of the markers; the hash of
a null id is that of the text ``null``. Rows with the same id are transformed each (they get the same draws); ties
of the draws give an empty middle. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ROW, ready, shuffle_partitions, whole_text, with_pass_key

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Order of the segments in the output of each form.
ORDERS = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
#: Order of the segments in the text.
TEXT_ORDER = (PREFIX, MIDDLE, SUFFIX)

#: Bytes of a text whose units are located at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class MiddlePolicy:
    """Shares in percent: texts left plain, and transformed texts with the suffix first. Units in a piece.

    A partition of pieces gets about ``partition_bytes`` of text: this exchange is not one that adapts by itself.
    """

    plain_percent: int = 10
    spm_percent: int = 20
    chunk_units: int = 16_384
    partition_bytes: int = 32 * 1024 * 1024
    seed: int = 1


def _letters() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[ord("A"): ord("Z") + 1] = table[ord("a"): ord("z") + 1] = True
    return table


LETTER = _letters()
#: Bytes that begin a code point.
FIRST = (np.arange(256) & 0xC0) != 0x80


class Units:
    """Where the units of a UTF-8 text begin, block by block: counts are kept, places are found again when asked for."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, dtype=np.uint8)
        counts = [int(self._begins(at).sum()) for at in range(0, len(self.data), BLOCK)]
        self.before = np.cumsum([0, *counts])
        self.count = int(self.before[-1])
        self._block, self._places = -1, np.zeros(0, dtype=np.int64)

    def _begins(self, start: int) -> np.ndarray:
        block = self.data[start: start + BLOCK]
        letter = LETTER[block]
        joined = np.empty_like(letter)
        joined[:1] = start > 0 and LETTER[self.data[start - 1]]
        joined[1:] = letter[:-1]
        return FIRST[block] & ~(letter & joined)

    def offset(self, unit: int) -> int:
        """Byte at which a unit begins; the end of the text for the number after the last one."""
        if unit >= self.count:
            return len(self.data)
        block = int(np.searchsorted(self.before, unit, side="right")) - 1
        if block != self._block:
            self._block, self._places = block, block * BLOCK + np.flatnonzero(self._begins(block * BLOCK))
        return int(self._places[unit - self.before[block]])

    def chars(self, begin: int, end: int) -> int:
        return sum(int(FIRST[self.data[at: min(end, at + BLOCK)]].sum()) for at in range(begin, end, BLOCK))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers from the document's id."""
    name = "null" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i: i + 8], 16) for i in range(0, 32, 8)]


def pieces_of(doc_id: int | None, data: bytes, policy: MiddlePolicy) -> Iterator[bytes | tuple]:
    """A header (doc_id, units, form, characters of prefix and of middle), then the output's pieces in order."""
    units = Units(data)
    n, size = units.count, policy.chunk_units
    h1, h2, h3, h4 = draws(doc_id, policy.seed)
    marked = any(marker in data for marker in TEXT_ORDER)

    def chunks(first: int, last: int) -> Iterator[bytes]:
        places = [*range(first, last, size), last]
        for a, b in zip(places, places[1:], strict=False):
            yield data[units.offset(a): units.offset(b)]

    if n == 0 or marked or h3 % 100 >= 100 - policy.plain_percent:
        yield doc_id, n, PLAIN, None, None
        yield from chunks(0, n)
        return
    one, other = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = SPM if h4 % 100 < policy.spm_percent else PSM
    bounds = {PREFIX: (0, one), MIDDLE: (one, other), SUFFIX: (other, n)}
    at, until = units.offset(one), units.offset(other)
    yield doc_id, n, form, units.chars(0, at), units.chars(at, until)
    for marker in ORDERS[form]:
        lead = marker
        for chunk in chunks(*bounds[marker]):
            yield lead + chunk
            lead = b""
        if lead:
            yield lead


def document_of(key: tuple) -> int:
    """Partition number, before the remainder, of a piece: that of its document."""
    return (key[0] * 0x9E3779B97F4A7C15 >> 32) & 0x7FFFFFFF


def output_pieces(docs: DataFrame, policy: MiddlePolicy = MiddlePolicy()) -> RDD:
    """((row, position), header or bytes): all pieces of a document in one partition, in output order after its header."""
    ready(docs.sparkSession)
    rows = with_pass_key(docs.select("doc_id", whole_text().cast("binary").alias("data"))).select(ROW, "doc_id", "data")
    total = rows.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    partitions = max(shuffle_partitions(docs.sparkSession), math.ceil(total / policy.partition_bytes))

    def emit(part: Iterator) -> Iterator[tuple]:
        for row, doc_id, data in part:
            for position, piece in enumerate(pieces_of(doc_id, bytes(data), policy), -1):
                yield (row, position), piece

    return rows.rdd.mapPartitions(emit).repartitionAndSortWithinPartitions(partitions, document_of)


def restored_place(form: str, segment: int, piece: bytes) -> tuple[int, bytes]:
    """Place in the text of the segment a piece of the output belongs to, and what it adds to the text.

    ``segment`` is that of the piece before. A transformed text holds no marker, so a marker at the start of a
    piece begins a segment.
    """
    if form != PLAIN:
        for place, marker in enumerate(TEXT_ORDER):
            if piece.startswith(marker):
                return place, piece[len(marker):]
    return segment, piece


HEADER = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def digests(docs: DataFrame, policy: MiddlePolicy = MiddlePolicy()) -> DataFrame:
    """(header, output_sha256, restored_sha256) per document; the restored text is put together from the output's pieces."""

    def assemble(part: Iterator[tuple]) -> Iterator[tuple]:
        row, header, digest, segment = None, None, None, 0
        for (own, position), piece in part:
            if position < 0:
                if header is not None:
                    yield (row, -1, 0), (*header, digest.hexdigest())
                row, header, digest, segment = own, piece, hashlib.sha256(), 0
                continue
            digest.update(piece)
            segment, kept = restored_place(header[2], segment, piece)
            yield (row, segment, position), kept
        if header is not None:
            yield (row, -1, 0), (*header, digest.hexdigest())

    def restore(part: Iterator[tuple]) -> Iterator[tuple]:
        header, digest = None, None
        for (_, segment, _), piece in part:
            if segment < 0:
                if header is not None:
                    yield *header, digest.hexdigest()
                header, digest = piece, hashlib.sha256()
            else:
                digest.update(piece)
        if header is not None:
            yield *header, digest.hexdigest()

    pieces = output_pieces(docs, policy).mapPartitions(assemble, preservesPartitioning=True)
    resorted = pieces.repartitionAndSortWithinPartitions(pieces.getNumPartitions(), document_of)
    schema = f"{HEADER}, output_sha256 string, restored_sha256 string"
    return docs.sparkSession.createDataFrame(resorted.mapPartitions(restore), schema, verifySchema=False)


def transformed(docs: DataFrame, policy: MiddlePolicy = MiddlePolicy()) -> DataFrame:
    """(header, output): the transformed texts themselves."""

    def join(part: Iterator[tuple]) -> Iterator[tuple]:
        header, held = None, []
        for (_, position), piece in part:
            if position >= 0:
                held.append(piece)
                continue
            if header is not None:
                yield *header, b"".join(held).decode()
            header, held = piece, []
        if header is not None:
            yield *header, b"".join(held).decode()

    texts = output_pieces(docs, policy).mapPartitions(join)
    return docs.sparkSession.createDataFrame(texts, f"{HEADER}, output string", verifySchema=False)
