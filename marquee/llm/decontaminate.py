"""Benchmark decontamination: rare n-gram seeds join passages to test items, and local alignment scores them.

1. Every document is searched once for the n-grams of all test items, by hash. The hashes are sent to every task in order
   while they are few; beyond that a task holds the hashes of its documents and reads those of the items past them.
2. An n-gram's rarity is the number of documents that hold it. Of each ``stretch`` neighbouring n-grams of an item that
   occur at all, the rarest is a seed; so every stretch of an item keeps one, and a phrase that many items or documents
   share is a seed only where nothing rarer stands beside it.
3. Seeds join documents to items. Around the places of all its n-grams an item is aligned with the document's words
   (Smith-Waterman, linear gaps), which follows inserted, dropped and replaced words. A score is the alignment's share of
   what the whole item would score. An item is left out of a document only where too few of its words occur for any
   alignment to reach ``least_score``, which keeps common phrases from costing alignments and loses nothing.

A copy is found where ``seed_words`` + ``stretch`` - 1 words of it stand unbroken, and where ``seed_words`` do if no other
document holds more of that place. Items shorter than ``seed_words`` are sought whole.

Defined cases: null and empty texts match nothing; items with fewer than ``least_words`` words are too short to tell a
copy from chance and are left out, unless that is lowered; repeated items count apart, an item without an id too;
repeated documents are judged each. Further columns are not read. An empty table on either side gives no matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.config import SkewPolicy
from marquee.llm.common import ROW, addressable, give_back, in_parts, ready, rows_at, shuffle_partitions, whole_text, with_row_key
from marquee.operators.skew import with_positions
from marquee.operators.stored import stored_batches
from marquee.session import materialise, store

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class LeakPolicy:
    seed_words: int = 4
    stretch: int = 2
    least_words: int = 5
    match: int = 2
    mismatch: int = 1
    gap: int = 1
    least_score: float = 0.6
    sent_hashes: int = 2_000_000
    held_hashes: int = 4_000_000
    broadcast_rows: int = 1_000_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: Words whose hashes a task keeps; they start anew beyond it.
KEPT_WORDS = 200_000


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = hashed = xxhash.xxh3_64_intdigest(word)
        return hashed


def word_hashes(words: list[str], known: WordHashes | None = None) -> np.ndarray:
    find = (WordHashes() if known is None else known).__getitem__
    return np.fromiter(map(find, words), dtype=np.uint64, count=len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the n-grams of ``size`` words, from those of the words."""
    if len(words) < size:
        return np.zeros(0, dtype=np.int64)
    values = words[: len(words) - size + 1].copy()
    for i in range(1, size):
        values = values * np.uint64(0x9E3779B97F4A7C15) + words[i: len(words) - size + 1 + i]
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values.view(np.int64)


def item_grams(words: list[str], policy: LeakPolicy) -> np.ndarray:
    """Hashes of an item's n-grams in order; a short item is one of them."""
    return gram_hashes(word_hashes(words), min(policy.seed_words, len(words))) if words else np.zeros(0, dtype=np.int64)


def align(item: np.ndarray, passage: np.ndarray, policy: LeakPolicy) -> tuple[float, int, int]:
    """Score of the best local alignment as a share of a whole match, and its first and last place in the passage.

    One vectorised step per word of the item: gaps along the passage are a running maximum of what each cell
    would give on without its cost.
    """
    width = len(passage)
    at = np.arange(width + 1)
    row, begins = np.zeros(width + 1, dtype=np.int64), at.copy()
    best, span = 0, (0, -1)
    for word in item:
        gain = np.where(passage == word, policy.match, -policy.mismatch)
        cells, starts = np.zeros(width + 1, dtype=np.int64), at.copy()
        for value, origin in ((row[:-1] + gain, begins[:-1]), (row[1:] - policy.gap, begins[1:])):
            better = value > cells[1:]
            cells[1:][better], starts[1:][better] = value[better], origin[better]
        handed = cells + policy.gap * at
        peak = np.maximum.accumulate(handed)
        source = np.maximum.accumulate(np.where(handed == peak, at, 0))
        row, begins = peak - policy.gap * at, starts[source]
        top = int(row.argmax())
        if row[top] > best:
            best, span = int(row[top]), (int(begins[top]), top - 1)
    return best / (policy.match * len(item)), *span


def regions(seeds: list[tuple[int, int]], item_words: int, n_words: int, policy: LeakPolicy) -> list[tuple[int, int]]:
    """Stretches of a document where an item may lie, from (place in the item, place in the document).

    They reach as far as words put in between may move a copy that still scores ``least_score``.
    """
    slack = 1 + int((1 - policy.least_score) * policy.match * item_words / policy.gap)
    found: list[tuple[int, int]] = []
    for begin, end in sorted(
        (max(0, place - pos - slack), min(n_words, place - pos + item_words + slack)) for pos, place in seeds
    ):
        if found and begin <= found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((begin, end))
    return found


NONE = np.zeros(0, dtype=np.int64)


def numbered_items(items: DataFrame, policy: LeakPolicy) -> DataFrame:
    """Stored (number, item_id, text): items numbered densely, in that order."""
    rows = materialise(items.select("item_id", whole_text().alias("text"), F.monotonically_increasing_id().alias("place")), "items")
    narrow, n = rows.select("place"), rows.count()
    numbers = with_positions(narrow, (), ("place",), SkewPolicy(), n, name="number")
    joined = rows.join(numbers, "place").select("number", "item_id", "text")
    return materialise(joined.repartitionByRange(shuffle_partitions(items.sparkSession), "number").sortWithinPartitions("number"), "numbered_items")


def item_postings(items: DataFrame, policy: LeakPolicy) -> DataFrame:
    """Stored (hash, number, pos, size): the n-grams of all items that are long enough."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), in_parts(batch.column(1)), strict=True):
                words = words_of(text)
                if len(words) >= max(1, policy.least_words):
                    grams, size = item_grams(words, policy), min(policy.seed_words, len(words))
                    n = len(grams)
                    arrays = [pa.array(grams), pa.array(np.full(n, number)), pa.array(np.arange(n)), pa.array(np.full(n, size))]
                    yield pa.RecordBatch.from_arrays(arrays, ["hash", "number", "pos", "size"])
        give_back()

    schema = "hash long, number long, pos long, size long"
    return materialise(items.select("number", "text").mapInArrow(cut, schema), "item_grams")


def _hits(docs: DataFrame, postings: DataFrame, sizes: list[int], policy: LeakPolicy) -> DataFrame:
    """Stored: documents that hold any n-gram of the items, with the n-grams' hashes and places, in one pass over them."""
    spark = docs.sparkSession
    distinct = postings.select("hash").distinct()
    path = store(distinct.repartitionByRange(shuffle_partitions(spark), "hash").sortWithinPartitions("hash"), "item_hashes")
    stored = spark.read.parquet(path)
    few = stored.count() <= policy.sent_hashes
    sent = spark.sparkContext.broadcast(np.sort(stored.toPandas()["hash"].to_numpy()) if few else None)

    def known_among(values: np.ndarray) -> np.ndarray:
        """Those of the sorted hashes that are the items', which are read past them."""
        parts = [np.zeros(0, dtype=np.int64)]
        for batch in stored_batches(path, policy.sent_hashes, ["hash"]):
            parts.append(np.intersect1d(values, batch.column(0).to_numpy(), assume_unique=True))
        return np.sort(np.concatenate(parts))

    def marked(held: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value if few else known_among(np.unique(np.concatenate([NONE, *(grams for _, grams, _ in held)])))
        rows = []
        for row, grams, places in held if len(wanted) else ():
            at = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
            found = wanted[at] == grams
            if found.any():
                rows.append((row, grams[found], places[found]))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [ROW, "hashes", "places"]
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, WordHashes()
        most = policy.held_hashes // (32 if few else 1)  # nothing is gained by holding more where nothing is read
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), in_parts(batch.column(1)), strict=True):
                words = word_hashes(words_of(text), known)
                grams = [gram_hashes(words, n) for n in sizes]
                held.append((row, np.concatenate(grams), np.concatenate([np.arange(len(own)) for own in grams])))
                size += sum(map(len, grams))
                if size >= most:
                    yield from marked(held)
                    held, size = [], 0
        yield from marked(held)
        give_back()

    schema = f"{ROW} long, hashes array<long>, places array<long>"
    return materialise(docs.select(ROW, "text").mapInArrow(search, schema), "gram_hits")


def rarest_of_stretches(positions: np.ndarray, counts: np.ndarray, stretch: int) -> np.ndarray:
    """Places, in arrays sorted by position, of the rarest n-gram of each ``stretch`` neighbouring ones; of a shorter run,
    of all. Ties go to one that is chosen already, then to the last."""
    chosen: set[int] = set()
    cuts = [0, *(np.flatnonzero(np.diff(positions) != 1) + 1).tolist(), len(positions)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        width = min(stretch, end - begin)
        for at in range(begin, end - width + 1) if width else ():
            chosen.add(min(range(at, at + width), key=lambda i: (counts[i], i not in chosen, -i)))
    return np.array(sorted(chosen), dtype=np.int64)


def seeds_of(postings: DataFrame, hits: DataFrame, policy: LeakPolicy) -> DataFrame:
    """Stored (hash, number): the seeds of each item."""
    df = hits.select(F.explode(F.array_distinct("hashes")).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("df"))
    occurring = postings.join(df, "hash").groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("pos", "df", "hash"))).alias("found")
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                pos, df, hashes = (found.values.field(i).to_numpy() for i in range(3))
                own = np.unique(hashes[rarest_of_stretches(pos, df, policy.stretch)])
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), number))], ["hash", "number"])

    return materialise(occurring.mapInArrow(choose, "hash long, number long"), "seeds")


def may_reach(item: list[str], held: set[str], policy: LeakPolicy) -> bool:
    """Could the item reach ``least_score`` if all of its words that are held matched, and nothing cost anything?"""
    return sum(word in held for word in item) / len(item) >= policy.least_score


LINKS = "item_id long, score double, first_word long, last_word long"


def _aligned(docs: DataFrame, hits: DataFrame, pairs: DataFrame, items_path: str, policy: LeakPolicy) -> DataFrame:
    """Alignments (row, item, score, span) of documents with the items whose seeds they hold.

    Items are read from the shared folder, those of a batch of documents at a time.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.unique(batch.column(4).flatten().to_numpy())
            number = pyarrow.dataset.field("number")
            span = (number >= int(wanted.min())) & (number <= int(wanted.max())) & number.isin(pa.array(wanted)) if len(wanted) else None
            known = {
                row["number"]: (row["item_id"], words_of(row["text"]))
                for part in (stored_batches(items_path, 1_000, where=span) if len(wanted) else ()) for row in part.to_pylist()
            }
            rows = []
            for row, text, hashes, places, numbers in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                words = words_of(text)
                held, at = set(words), {}
                for gram, place in zip(hashes, places, strict=True):
                    at.setdefault(gram, []).append(place)
                for own_number in numbers:
                    item_id, item = known[own_number]
                    if not may_reach(item, held, policy):
                        continue
                    seeds = [
                        (pos, place) for pos, gram in enumerate(item_grams(item, policy).tolist()) for place in at.get(gram, ())
                    ]
                    codes = {word: i for i, word in enumerate(dict.fromkeys(item))}
                    own = np.array([codes[word] for word in item])
                    best = (0.0, 0, -1)
                    for begin, end in regions(seeds, len(item), len(words), policy):
                        if not may_reach(item, set(words[begin:end]), policy):
                            continue
                        passage = np.array([codes.get(word, -1) for word in words[begin:end]])
                        share, first, last = align(own, passage, policy)
                        if share > best[0]:
                            best = share, begin + first, begin + last
                    rows.append((row, own_number, item_id, *best))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [ROW, "number", "item_id", "score", "first_word", "last_word"],
            )
        give_back()

    texts = rows_at(docs.select(ROW, "text"), pairs.select(ROW), policy.broadcast_rows)
    joined = texts.join(hits, ROW).join(pairs, ROW).select(ROW, "text", "hashes", "places", "numbers")
    return joined.mapInArrow(score, f"{ROW} long, number long, {LINKS}")


def leaks(docs: DataFrame, items: DataFrame, policy: LeakPolicy = LeakPolicy()) -> DataFrame:
    """Stored: (row key, item number, item_id, score, first_word, last_word) of documents that share seeds and words with
    an item."""
    spark = docs.sparkSession
    ready(spark)
    rows = with_row_key(addressable(docs.select("doc_id", "text"))).select("doc_id", whole_text().alias("text"), ROW)
    path = store(numbered_items(items, policy), "items")
    postings = item_postings(spark.read.parquet(path), policy)
    sizes = sorted(row["size"] for row in postings.select("size").distinct().collect())  # at most seed_words
    if not sizes:
        return spark.createDataFrame([], f"{ROW} long, number long, {LINKS}")
    hits = _hits(rows, postings, sizes, policy)
    seeds = seeds_of(postings, hits, policy)
    held = hits.select(ROW, F.explode(F.array_distinct("hashes")).alias("hash"))
    small = seeds.count() <= policy.broadcast_rows
    met = held.join(F.broadcast(seeds) if small else seeds, "hash")
    pairs = materialise(met.groupBy(ROW).agg(F.collect_set("number").alias("numbers")), "pairs")
    return materialise(_aligned(rows, hits, pairs, path, policy), "leaks")


def contamination(docs: DataFrame, items: DataFrame, policy: LeakPolicy = LeakPolicy()) -> DataFrame:
    """Per document: is it contaminated, with how many items, the best item, its score and its span of words."""
    docs = addressable(docs.select("doc_id", "text"))
    bad = leaks(docs, items, policy).where(F.col("score") >= policy.least_score)
    best = F.max_by(
        F.struct("item_id", "score", "first_word", "last_word"), F.struct("score", F.negative("item_id"), F.negative("number"))
    )
    found = bad.groupBy(ROW).agg(F.count(F.lit(1)).alias("n_items"), best.alias("best"))
    rows = with_row_key(docs.select("doc_id"))
    return rows.join(found, ROW, "left").select(
        ROW, "doc_id", F.col("best").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "best.*",
    )
