"""Source divergence audit: how far the term frequencies of each source are from those of the others in its language.

A language keeps the terms of at least ``least_documents`` of its documents. Each source's frequencies are smoothed to
integers p (billionths, see ``smoothed``), and two frequencies differ by f = floor((p - q)^2 / (p + q)). The value of two
sources is the sum of f over all kept terms, although most terms do not occur in most sources:

* If neither source had any term, each term would give f of their empty frequencies.
* Terms of one source alone correct that by an amount that depends on its count: counts are put together first, so a
  correction is made once for each (source, count) and other source.
* Terms of both correct it once more. A term's row, its nonzero counts in the order of the language's sources, largest
  first, is a path of a frequent-pattern tree; equal rows are one path with a multiplicity. Sorted paths are inserted
  one after another, so rows with a common beginning share nodes, and each node gives its correction with each of its
  ancestors once, times its multiplicity, whatever number of rows runs through it.

Paths are dealt by ranges of their beginning and then of all of them, so neither a language nor a source nor a common
beginning makes a task heavy; a node on a border is a node of both tasks, with its multiplicity shared out. All arithmetic is on integers.

Defined cases: null texts, languages and sources count as empty strings. Repeated documents count each. A group without
terms has frequencies of its own empty counts. Ties have the order of UTF-8 bytes. A language with no kept terms has
distances of 0 and no terms. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import drop_kept, give_back, ready, shuffle_partitions, whole_text
from marquee.session import materialise

SCALE = 1_000_000_000
#: Paths that begin with as many equal entries are dealt to neighbouring ranges.
SHARED_ENTRIES = 3


@dataclass(frozen=True)
class AuditPolicy:
    """``held_terms``: entries a counting task holds before it hands them on. ``pairs_at_once``: node and ancestor
    combinations worked on together; ``path_entries``: entries of the rows made into one tree. ``broadcast_bytes``:
    size up to which the table of groups goes to every task."""

    least_documents: int = 10
    top_terms: int = 10
    held_terms: int = 600_000
    path_entries: int = 500_000
    pairs_at_once: int = 1_000_000
    broadcast_bytes: int = 16 * 1024 * 1024


# ASCII letters as lower case, other ASCII as spaces, bytes of other characters as they are.
_AS_WORDS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 97 <= byte <= 122 or byte >= 128 else 32 for byte in range(256)
)


def terms_of(data: bytes) -> list[bytes]:
    """Runs of ASCII letters and other characters beyond ASCII, A-Z lower-cased."""
    return data.translate(_AS_WORDS).split(b" ") if data else []


#: A term's documents are counted in the upper bits of its number, and its occurrences below them.
_ONE_DOCUMENT = 1 << 40
#: Terms a task may count before it hands its sums on.
_MOST_COUNTED = 1 << 39


def counted_terms(docs: DataFrame, policy: AuditPolicy) -> DataFrame:
    """(lang, source, term, n, docs): partial counts of each task. A group of its own has a row without a term."""
    ready(docs.sparkSession)
    names = ["lang", "source", "term", "n", "docs"]

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), found in held.items():
            sums = np.fromiter(found.values(), dtype=np.int64, count=len(found))
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(found) + 1), pa.string()), pa.array([source] * (len(found) + 1), pa.string()),
                pa.array([None, *found], pa.binary()), pa.array(np.append(0, sums % _ONE_DOCUMENT)),
                pa.array(np.append(0, sums // _ONE_DOCUMENT)),
            ], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        held: dict[tuple, dict[bytes, int]] = {}
        size, most = 0, 0
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for group, data in zip(groups, batch.column(2), strict=True):
                terms = terms_of(data.as_py())
                own = Counter(terms)
                own.pop(b"", None)
                if group not in held:
                    held[group] = {}
                found = held[group]
                size -= len(found)
                get = found.get
                for term, n in own.items():
                    found[term] = get(term, 0) + n + _ONE_DOCUMENT
                size += len(found)
                most += len(terms)
                if size > policy.held_terms or most > _MOST_COUNTED:
                    yield from rows(held)
                    held, size, most = {}, 0, 0
        yield from rows(held)
        give_back()

    texts = docs.select(
        whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text().cast("binary").alias("data")
    )
    found = texts.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return found.withColumn("term", F.col("term").cast("string"))



def smoothed(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), in whole numbers of any size; null without terms."""
    wide = "decimal(27,0)"
    part = (count + 2).cast(wide) * F.lit(SCALE).cast("decimal(11,0)")
    return 1 + F.when(terms > 0, _whole_quotient(part, (total + 2 * terms).cast(wide)))


def _whole_quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def distance(p: Column, q: Column) -> Column:
    return _whole_quotient((p - q) * (p - q), p + q)


@dataclass(frozen=True)
class Frequencies:
    """Stored tables: kept terms with their smoothed frequency in each group that has them, and all groups."""

    terms: DataFrame  # lang, term, source, place, p, empty (p of a term it lacks), q (the language's)
    groups: DataFrame  # lang, source, place (0 for the largest), terms, empty
    small: bool  # may the groups go to every task?

    @property
    def sent_groups(self) -> DataFrame:
        return F.broadcast(self.groups) if self.small else self.groups


def frequencies(docs: DataFrame, policy: AuditPolicy = AuditPolicy()) -> Frequencies:
    partitions = shuffle_partitions(docs.sparkSession)
    # The one exchange of the counts serves both aggregations. Rows without a term, one for each group, are dealt by source.
    counted = counted_terms(docs, policy).withColumn("own", F.when(F.col("term").isNull(), F.col("source")))
    dealt = counted.repartition(partitions, "lang", "term", "own")
    per_source = dealt.groupBy("lang", "term", "own", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    per_term = per_source.groupBy("lang", "term", "own").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("found")
    )
    kept = per_term.where(F.col("term").isNull() | (F.col("docs") >= policy.least_documents)).select(
        "lang", "term", "n", "found"
    )
    rows = materialise(kept, "kept_terms")
    counts = rows.select("lang", "term", F.col("n").alias("everywhere"), F.inline("found"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = rows.groupBy("lang").agg(F.count("term").alias("terms"), F.sum("n").alias("lang_total"))
    groups = sums.join(langs, "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "source")) - 1
    groups = groups.select(
        "lang", "source", "total", "terms", "lang_total", place.alias("place"),
        smoothed(F.lit(0).cast("long"), F.col("total"), F.col("terms")).alias("empty"),
    )
    groups = materialise(groups, "groups")
    size = groups.agg(F.sum(F.octet_length("lang") + F.octet_length("source") + 64)).first()[0] or 0
    small = size <= policy.broadcast_bytes
    joined = counts.where("term is not null").join(F.broadcast(groups) if small else groups, ["lang", "source"])
    terms = joined.select(
        "lang", "term", "source", "place", smoothed(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "empty",
        smoothed(F.col("everywhere"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    return Frequencies(materialise(terms, "frequencies"), groups, small)


def f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class PatternTree:
    """A prefix tree of sorted rows, as arrays. An entry of a row is a node unless the row before runs through the same.

    ``sources``, ``p`` and ``empty`` are the entries of all rows after each other, ``lengths`` and ``times`` one for each row.
    """

    def __init__(self, sources: np.ndarray, p: np.ndarray, empty: np.ndarray, lengths: np.ndarray, times: np.ndarray):
        self.sources, self.p, self.empty = sources, p, empty
        starts = np.cumsum(lengths) - lengths
        row = np.repeat(np.arange(len(lengths)), lengths)
        self.depth = np.arange(len(row)) - starts[row]
        before = starts[row] - np.where(row > 0, lengths[row - 1], 0) + self.depth  # the same depth of the row before
        there = (row > 0) & (self.depth < lengths[row - 1])
        before = np.where(there, before, 0)
        same = there & (sources == sources[before]) & (p == p[before])
        # A row leaves the one before at its first entry that differs, and shares no node from there on.
        parting = np.minimum.reduceat(np.where(same, lengths[row], self.depth), starts) if len(row) else lengths
        new = self.depth >= parting[row]
        self.nodes = np.flatnonzero(new)
        # By depth, an entry's node is the last new one: a row that is too short parts its neighbours.
        order = np.lexsort((row, self.depth))
        last = np.maximum.accumulate(np.where(new[order], np.arange(len(order)), 0))
        self.times = np.zeros(len(row), dtype=np.int64)
        np.add.at(self.times, order[last], times[row[order]])

    def pairs(self, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(node, ancestor) as entry numbers, ancestors being the entries before a node in the row that made it."""
        depth = self.depth[self.nodes]
        parts = np.cumsum(depth) // at_once
        for part in np.unique(parts):
            nodes, counts = self.nodes[parts == part], depth[parts == part]
            below = np.repeat(nodes, counts)
            step = np.arange(len(below)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield below, below - 1 - step

    def corrections(self, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(source, other source, correction), each combination of sources once per part."""
        width = int(self.sources.max()) + 1 if len(self.sources) else 1
        for a, b in self.pairs(at_once):
            pa_, pb, ea, eb = self.p[a], self.p[b], self.empty[a], self.empty[b]
            value = (f_of(pa_, pb) - f_of(pa_, eb) - f_of(ea, pb) + f_of(ea, eb)) * self.times[a]
            combined = self.sources[a] * width + self.sources[b]
            order = np.argsort(combined, kind="stable")
            combined, value = combined[order], value[order]
            first = np.flatnonzero(np.diff(combined, prepend=-1))
            if len(first):
                yield combined[first] // width, combined[first] % width, np.add.reduceat(value, first)


def shared_corrections(found: Frequencies, policy: AuditPolicy) -> DataFrame:
    """(lang, place, other, value): what terms of both sources correct, summed for each task, each pair in one order."""
    item = F.struct("place", "p", "empty")
    paths = found.terms.groupBy("lang", "term").agg(F.sort_array(F.collect_list(item)).alias("path"))
    paths = paths.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    spark = found.terms.sparkSession
    # Ranges of hashes of a path's beginning, then of the whole path: a few bytes a path are sampled to find them.
    ranges = paths.repartitionByRange(
        shuffle_partitions(spark), "lang", F.xxhash64(F.slice("path", 1, SHARED_ENTRIES)), F.xxhash64("path")
    )
    ordered = materialise(ranges.sortWithinPartitions("lang", "path"), "paths")
    names = ["lang", "place", "other", "value"]

    def insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, lists, times = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            lengths = np.diff(lists.offsets.to_numpy())
            begin = lists.offsets[0].as_py()
            entries = lists.values.slice(begin, int(lengths.sum()))
            place, p, empty = (entries.field(i).to_numpy().astype(np.int64) for i in range(3))
            entry_starts = np.append(0, np.cumsum(lengths))
            codes = langs.dictionary_encode().indices.to_numpy()
            # A tree for each language, and for so many entries of it.
            cuts = np.flatnonzero(np.diff(codes) | np.diff(entry_starts[1:] // policy.path_entries)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(codes)], strict=True):
                own = slice(entry_starts[start], entry_starts[stop])
                tree = PatternTree(place[own], p[own], empty[own], lengths[start:stop], times[start:stop])
                for a, b, value in tree.corrections(policy.pairs_at_once):
                    lang = pa.array([langs[start].as_py()] * len(a), pa.string())
                    yield pa.RecordBatch.from_arrays([lang, pa.array(a), pa.array(b), pa.array(value)], names)
        give_back()

    made = ordered.mapInArrow(insert, "lang string, place long, other long, value long")
    return made.groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))


def single_corrections(found: Frequencies) -> DataFrame:
    """(lang, place, other, value): what the terms of one source alone correct, its counts put together first."""
    counts = found.terms.groupBy("lang", "place", "p", "empty").agg(F.count(F.lit(1)).alias("times"))
    # One row per count takes the other sources' empty frequencies along, as many as the result has per source.
    others = found.groups.groupBy("lang").agg(
        F.collect_list(F.struct(F.col("place").alias("other"), F.col("empty").alias("other_empty"))).alias("others")
    )
    joined = counts.join(others, "lang").select("lang", "place", "p", "empty", "times", F.inline("others"))
    value = (
        distance(F.col("p"), F.col("other_empty")) - distance(F.col("empty"), F.col("other_empty"))
    ) * F.col("times")
    return joined.where("place != other").groupBy("lang", "place", "other").agg(F.sum(value).alias("value"))


def source_distances(found: Frequencies, policy: AuditPolicy = AuditPolicy()) -> DataFrame:
    """(lang, source, item, value): every other source of the language, with the sum of f over all kept terms."""
    groups = found.groups.select("lang", "source", "place", "terms", "empty")
    other = groups.select(
        "lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("empty").alias("other_empty")
    )
    # The result has a row for each ordered pair of a language's sources; so has this table.
    pairs = groups.join(other, "lang").where("place != other").select(
        "lang", "source", "item", "place", "other",
        F.coalesce(F.col("terms") * distance(F.col("empty"), F.col("other_empty")), F.lit(0)).alias("without"),
    )
    shared, single = shared_corrections(found, policy), single_corrections(found)
    turned = [F.col("other").alias("place"), F.col("place").alias("other")]
    all_corrections = (
        shared.unionByName(single).unionByName(shared.select("lang", *turned, "value"))
        .unionByName(single.select("lang", *turned, "value"))
    ).groupBy("lang", "place", "other").agg(F.sum("value").alias("value"))
    joined = pairs.join(all_corrections, ["lang", "place", "other"], "left")
    return joined.select("lang", "source", "item", (F.col("without") + F.coalesce("value", F.lit(0))).alias("value"))


def typical_terms(found: Frequencies) -> DataFrame:
    """(lang, source, item, value): terms that a source has more often than its language."""
    return found.terms.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value")
    )


def audit(docs: DataFrame, policy: AuditPolicy = AuditPolicy()) -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources by distance, and the most typical terms, of each group."""
    found = frequencies(docs, policy)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_distances(found, policy).withColumn("rank", F.row_number().over(order))
    terms = typical_terms(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= policy.top_terms)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank"
    )
