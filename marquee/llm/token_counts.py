"""Token counts of whole texts by a two-tier lookup on the map side.

The first tier is a compact table of the lengths, in tokens, of frequent pre-token pieces; it is taken from a
bounded sample of rows and sent to every task. The second tier is each Python worker's own cache of the pieces
that the first lacks, tokenized in batches. Nothing is shuffled: a text is counted where it lies. The sample
decides only how much is looked up and how much is tokenized, never a count.

Defined cases: a null text counts as empty, and an empty text has 0 tokens; strings of added tokens inside a
text are handled as the library does by default. Repeated rows are counted each; further columns pass through.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import give_back, in_parts, kept_in_worker, ready, whole_text
from marquee.llm.pieces import LONGEST_KEPT, PieceTable, spaced_pieces, spaced_values

#: Texts tokenized together; the pieces of so many are held at a time.
CHUNK = 256
#: Bounds of the sample behind the first tier: rows, and the bytes a sampled text may have.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 1_000, 65_536
FREQUENT = 16_384

def _table(definition: str, fixed: dict[str, int]) -> PieceTable:
    """A worker's table outlives its tasks."""
    key = "lengths", hashlib.sha256(definition.encode()).hexdigest()
    return kept_in_worker(key, lambda: PieceTable(definition, " ", len, fixed))


def frequent_lengths(docs: DataFrame, definition: str, size: int = FREQUENT, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Lengths of the pieces most frequent in a bounded sample; one task counts it and returns ``size`` rows."""
    ready(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(definition)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for text in in_parts(batch.column(0)):
                seen.update(spaced_pieces(text)[1:])
        top = [piece for piece, _ in seen.most_common(size) if len(piece) <= LONGEST_KEPT]
        lengths = PieceTable(vocabulary.value, " ", len).encode([" " + piece for piece in top]) if top else []
        yield pa.RecordBatch.from_arrays([pa.array(top, pa.string()), pa.array(lengths, pa.int64())], ["piece", "n"])

    texts = docs.select(whole_text().alias("text")).where(F.octet_length("text") <= SAMPLE_TEXT_BYTES)
    # One partition holds the sample, so its pieces are counted without a shuffle of their own.
    rows = texts.limit(sample_rows).coalesce(1).mapInArrow(count, "piece string, n long")
    return {row["piece"]: row["n"] for row in rows.collect()}


def count_tokens(docs: DataFrame, definition: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """The table with the number of tokens of each text. ``definition`` is the tokenizer's JSON."""
    context = docs.sparkSession.sparkContext
    fixed = frequent_lengths(docs.select(F.col(text).alias("text")), definition)
    vocabulary, frequent = context.broadcast(definition), context.broadcast(fixed)

    @F.arrow_udf(T.LongType())
    def lengths(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _table(vocabulary.value, frequent.value)
        for batch in texts:
            counts = []
            for start in range(0, len(batch), CHUNK):
                counts += spaced_values(batch.slice(start, CHUNK).to_pylist(), known)
            yield pa.array(counts, pa.int64())
        give_back()

    return docs.withColumn(name, lengths(whole_text(text)))
