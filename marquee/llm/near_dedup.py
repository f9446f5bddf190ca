"""Near-duplicate groups from bottom-k sketches of one hash function.

1. A document's set of word shingles is hashed with one function. Documents with equal sets (128-bit digest of all
   values) become one node, so copies are never paired. Of nodes that share a list with others, found in step 2, the
   ``kept`` smallest values are the sketch.
2. The ``listed`` smallest values feed inverted lists. Their document frequencies are counted, and a node enters
   only the lists of its rarest values: as many as make two nodes over the threshold share a list. A value seen
   once has no list, so passages and phrases that many documents share bring no work to documents that differ.
3. Lists give pairs in rounds: first all members against one pivot per list. Of lists that still span several
   components, short ones give all their pairs across components; long ones are tried against further pivots,
   and what is left is compared block against block inside tasks, on whole sets, so that a long list's pairs are
   never written out, only its links. A block is bounded in members and in values.
4. A pair's similarity is estimated on the union of the two sketches (the smallest ``kept`` values of both); it
   is exact where both sketches are whole sets. Pairs within ``deviations`` standard errors of the threshold or
   above it are verified on the words of the full texts.
5. Verified links are contracted to components after each round, which empties most lists.

Steps 2 and 4 lose a pair that just meets the threshold with a probability of about one in a million
(``deviations``); more similar pairs far less. Nothing is capped.

Defined cases: a null or empty text, or one of white space, has an empty set and is linked with nothing; a text
with fewer words than a shingle has one shingle of them all. Of a group the row with the smallest ``doc_id``
stays, null ids last, rows with the same id by their place in the table. Further columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import (
    ROW, addressable, give_back, in_parts, ready, rows_at, shuffle_partitions, whole_text, with_row_key,
)
from marquee.llm.components import component_stars
from marquee.session import ROWS_PER_FILE, materialise, scratch_path, scratch_scope


@dataclass(frozen=True)
class NearPolicy:
    words: int = 5
    percent: int = 80
    kept: int = 256
    listed: int = 64
    deviations: float = 5.4  # exact binomial tails of at most 1e-6, for the estimate and the lists, at 0.8 and 0.85
    pivot_rounds: int = 3
    short_list: int = 32
    block: int = 1_024
    block_values: int = 2_000_000
    broadcast_rows: int = 1_000_000

    @property
    def threshold(self) -> float:
        return self.percent / 100


def least_overlap(size: int, policy: NearPolicy) -> int:
    """Values that the listed parts of two similar sets share at least, when one of them has ``size`` values."""
    t = policy.threshold
    if size <= t * policy.listed:  # the other set fits too, so this is no estimate
        return max(1, math.ceil(t * size - 1e-9))
    return max(1, math.floor(t * size - policy.deviations * math.sqrt(size * t * (1 - t))))


def text_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased and nothing else."""
    return text.encode().lower().split()


def shingle_values(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = text_words(text)
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    values = hashes[: len(words) - width + 1].copy()
    for i in range(1, width):
        values = values * np.uint64(0x9E3779B97F4A7C15) + hashes[i: len(words) - width + 1 + i]
    values ^= values >> np.uint64(31)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return np.unique(values.view(np.int64))


def shingles(text: str, size: int) -> set[tuple[bytes, ...]]:
    words = text_words(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def _values_of(batch: pa.RecordBatch, column: int, policy: NearPolicy) -> Iterator[np.ndarray]:
    return (shingle_values(text, policy.words) for text in in_parts(batch.column(column)))


def _lists_of(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *values])))


def sketches(docs: DataFrame, policy: NearPolicy) -> DataFrame:
    """Stored: row key, id, set size, digest of the whole set and the values for the lists."""
    ready(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, kept = [], [], []
            for values in _values_of(batch, 2, policy):
                sizes.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                kept.append(values[: policy.listed].copy())
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists_of(kept)]
            yield pa.RecordBatch.from_arrays(columns, [ROW, "doc_id", "n", "digest", "listed"])
        give_back()

    rows = with_row_key(docs).select(ROW, "doc_id", whole_text().alias("text"))
    schema = f"{ROW} long, doc_id long, n long, digest binary, listed array<long>"
    return materialise(rows.mapInArrow(make, schema), "sketches")


def _nodes(made: DataFrame, members: DataFrame, policy: NearPolicy) -> DataFrame:
    """(node, n, listed): the first row of each set. Copies are few, or else rows meet their node's number by a shuffle."""
    rows = made.where("n > 0").select(F.col(ROW).alias("node"), "n", "listed")
    copies = members.where(f"n > 0 and node != {ROW}").select(F.col(ROW).alias("node"))
    small = copies.count() <= policy.broadcast_rows
    return rows.join(F.broadcast(copies) if small else copies, "node", "left_anti")


def _sketched(nodes: DataFrame, docs: DataFrame, policy: NearPolicy, at_most: int) -> DataFrame:
    """Stored (node, n, sketch) of the nodes (node) given, from their texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(values), values[: policy.kept].copy()) for values in _values_of(batch, 1, policy)]
            arrays = [batch.column(0), pa.array([n for n, _ in found], pa.int64()), _lists_of([own for _, own in found])]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "n", "sketch"])
        give_back()

    wanted = materialise(nodes.select(F.col("node").alias(ROW)), "wanted", at_most)
    rows = _texts_of(wanted, docs, policy).mapInArrow(make, "node long, n long, sketch array<long>")
    return materialise(rows, "listed_nodes")


def _members(made: DataFrame) -> DataFrame:
    """Each row's node: the first row with the same set. Salted, as one set may belong to a third of all rows."""
    rows = made.select(ROW, "doc_id", "n", "digest")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(shuffle_partitions(made.sparkSession))))
    parts = rows.where("n > 0").groupBy("digest", "salt").agg(F.min(ROW).alias("node"))
    nodes = parts.groupBy("digest").agg(F.min("node").alias("node"), F.collect_list("salt").alias("salts"))
    nodes = nodes.select("digest", "node", F.explode("salts").alias("salt"))
    joined = rows.join(nodes, ["digest", "salt"], "left")
    return materialise(joined.select(ROW, "doc_id", "n", F.coalesce("node", ROW).alias("node")), "members", made.count())


def _lists(nodes: DataFrame, policy: NearPolicy) -> DataFrame:
    """Stored (value, node, n): every node under the rarest of its listed values that others have too."""
    lengths = [0] + [size - least_overlap(size, policy) + 1 for size in range(1, policy.listed + 1)]
    listed = F.least(F.col("n"), F.lit(policy.listed)).cast("int")
    postings = nodes.select("node", "n", F.explode("listed").alias("value"))
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = postings.join(counts, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("found")
    )
    # Values nobody else has are the rarest and use up part of the length.
    length = F.get(F.array(*map(F.lit, lengths)), listed) - (listed - F.size("found"))
    rare = shared.where(length > 0).select("node", "n", F.explode(F.slice("found", F.lit(1), length)).alias("x"))
    return materialise(rare.select("x.value", "node", "n"), "lists")


def _similar_size(a: Column, b: Column, policy: NearPolicy) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * policy.percent


def estimate(na: int, nb: int, a: np.ndarray, b: np.ndarray, policy: NearPolicy) -> tuple[bool, bool]:
    """May two sets be linked, judged by size and sketch; and is that certain, both sketches being whole sets?"""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    if max(na, nb) <= policy.kept:
        common = int(twice.sum())
        return 100 * common >= policy.percent * (na + nb - common), True
    # Of the union's smallest values, those that occur in both.
    place = np.cumsum(np.concatenate([[True], ~twice]))
    seen = min(int(place[-1]), policy.kept)
    hits = int((twice & (place[1:] <= seen)).sum())
    return hits >= cutoff(policy) * seen, False


def cutoff(policy: NearPolicy) -> float:
    t = policy.threshold
    return t - policy.deviations * math.sqrt(t * (1 - t) / policy.kept)


def _estimated(pairs: DataFrame, nodes: DataFrame, policy: NearPolicy) -> DataFrame:
    """Of pairs (high, low) those whose sketches do not rule out a link, and whether that is already certain."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            sketches_a, sketches_b = (batch.column(i) for i in (4, 5))
            rows = []
            for i in range(len(high)):
                a, b = (x[i].values.to_numpy(zero_copy_only=False) for x in (sketches_a, sketches_b))
                possible, certain = estimate(na[i], nb[i], a, b, policy)
                if possible:
                    rows.append((high[i], low[i], certain))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["high", "low", "certain"]
            )
        give_back()

    a = nodes.select(F.col("node").alias("high"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("low"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "high").join(b, "low").select("high", "low", "na", "nb", "sa", "sb")
    return both.mapInArrow(judge, "high long, low long, certain boolean")


def _verified(pairs: DataFrame, docs: DataFrame, policy: NearPolicy, n: int) -> DataFrame:
    """Links among the ``n`` pairs (high, low, certain): uncertain ones are decided on the shingles of the full texts."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            high, low = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            links = []
            for i, (text, other) in enumerate(zip(in_parts(batch.column(2)), in_parts(batch.column(3)), strict=True)):
                if low[i] != last:
                    last, last_set = low[i], shingles(other, policy.words)
                own = shingles(text, policy.words)
                common = len(own & last_set)
                links.append(100 * common >= policy.percent * (len(own) + len(last_set) - common))
            kept = [i for i, link in enumerate(links) if link]
            yield pa.RecordBatch.from_arrays(
                [pa.array([high[i] for i in kept], pa.int64()), pa.array([low[i] for i in kept], pa.int64())],
                ["high", "low"],
            )
        give_back()

    open_pairs = pairs.where("not certain").select("high", "low")
    wanted = materialise(open_pairs.select("high").union(open_pairs.select("low")).distinct().toDF(ROW), "wanted", 2 * n)
    texts = _texts_of(wanted, docs, policy)
    a = texts.select(F.col(ROW).alias("high"), "text")
    b = texts.select(F.col(ROW).alias("low"), F.col("text").alias("other"))
    with_texts = open_pairs.join(a, "high").join(b, "low")
    decided = with_texts.select("high", "low", "text", "other").mapInArrow(decide, "high long, low long")
    return pairs.where("certain").select("high", "low").union(decided)


def _ordered(a: str, b: str) -> list[Column]:
    return [F.greatest(a, b).alias("high"), F.least(a, b).alias("low")]


def _with_list_values(lists: DataFrame, parts: list[Column], whole: list[Column], more: DataFrame | None = None) -> DataFrame:
    """Rows of lists with aggregates over their list, first per list and salt, then per list.

    The answer goes back by the same salted key, so one value that very many nodes share is no hot key. ``more`` has
    further answers (value, ..).
    """
    salts = shuffle_partitions(lists.sparkSession)
    salted = lists.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    found = salted.groupBy("value", "salt").agg(*parts)
    found = found.groupBy("value").agg(*whole, F.collect_list("salt").alias("salts"))
    found = found if more is None else found.join(more, "value")
    answers = found.withColumn("salt", F.explode("salts")).drop("salts")
    return salted.join(answers, ["value", "salt"]).drop("salt")


def _pivot(turn: int) -> Column:
    """A list's pivot: the smallest of these over its members, another one in each turn."""
    rank = F.lit(0).cast("long") if turn == 0 else F.xxhash64("value", "node", F.lit(turn))
    return F.struct(rank.alias("rank"), "node", "n", "component")


def _pivot_pairs(lists: DataFrame, policy: NearPolicy) -> DataFrame:
    """Members of lists (value, node, n, component, p) against the pivot of their list."""
    pairs = lists.where(
        (F.col("component") != F.col("p.component")) & _similar_size(F.col("n"), F.col("p.n"), policy)
    )
    return pairs.select("node", F.col("p.node").alias("pivot")).select(*_ordered("node", "pivot")).distinct()


def _open_lists(lists: DataFrame, stars: DataFrame, least: int, turn: int, policy: NearPolicy) -> DataFrame:
    """Stored lists of at least ``least`` members that span more than one component, with what the next step needs.

    Rows are (value, node, n, component, members), with the list's pivot ``p`` in the ``turn`` to come, or after the last
    turn with its blocks. All of it goes back to the members at once, so that every round joins them with one answer.
    """
    labels = stars.select(F.col("high").alias("node"), F.col("low").alias("component"))
    labelled = lists.select("value", "node", "n").join(labels, "node", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "node"))
    pivots = turn < policy.pivot_rounds
    spans = _with_list_values(
        labelled,
        [F.count(F.lit(1)).alias("members"), F.min("component").alias("a"), F.max("component").alias("b"),
         *([F.min(_pivot(turn)).alias("p")] if pivots else [])],
        [F.sum("members").alias("members"), F.min("a").alias("a"), F.max("b").alias("b"),
         *([F.min("p").alias("p")] if pivots else [])],
        None if pivots else _blocks(labelled, policy),
    )
    still_open = spans.where((F.col("members") >= least) & (F.col("a") < F.col("b"))).drop("a", "b")
    return materialise(still_open, "open_lists", lists.count())


def _blocks(lists: DataFrame, policy: NearPolicy) -> DataFrame:
    """(value, main, outer_blocks, inner_blocks): a list's largest component, and the blocks outside and inside it."""
    sizes = lists.groupBy("value", "component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("v"))
    largest = F.max_by(F.struct("component", "m", "v"), F.struct("m", "component"))
    main = sizes.groupBy("value").agg(largest.alias("main"), F.sum("m").alias("m"), F.sum("v").alias("v"))

    def count(members: Column, values: Column) -> Column:
        return F.ceil(F.greatest(members / policy.block, values / policy.block_values)).cast("int")

    return main.select(
        "value", F.col("main.component").alias("main"),
        count(F.col("m") - F.col("main.m"), F.col("v") - F.col("main.v")).alias("outer_blocks"),
        count(F.col("main.m"), F.col("main.v")).alias("inner_blocks"),
    )


def _short_pairs(lists: DataFrame, policy: NearPolicy) -> DataFrame:
    """All pairs across components of lists whose length is bounded."""
    lists = lists.select("value", "node", "n", "component")
    other = lists.toDF(*(f"{name}2" if name != "value" else name for name in lists.columns))
    pairs = lists.join(other, "value").where(
        (F.col("node") > F.col("node2")) & (F.col("component") != F.col("component2"))
        & _similar_size(F.col("n"), F.col("n2"), policy)
    )
    return pairs.select(F.col("node").alias("high"), F.col("node2").alias("low")).distinct()


#: Whole sets handed on together.
SETS_AT_ONCE = 128


def _whole_sets(lists: DataFrame, docs: DataFrame, policy: NearPolicy) -> DataFrame:
    """Stored (node, values): all shingle hashes of the nodes in the lists."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SETS_AT_ONCE):
                part = batch.slice(start, SETS_AT_ONCE)
                arrays = [part.column(0), _lists_of([*_values_of(part, 1, policy)])]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "values"])
        give_back()

    wanted = materialise(lists.select(F.col("node").alias(ROW)).distinct(), "wanted", lists.count())
    return materialise(_texts_of(wanted, docs, policy).mapInArrow(make, "node long, values array<long>"), "whole_sets")


def _texts_of(wanted: DataFrame, docs: DataFrame, policy: NearPolicy) -> DataFrame:
    """(row key, text) of the wanted rows, filtered where the texts lie."""
    return rows_at(with_row_key(docs).select(ROW, whole_text().alias("text")), wanted, policy.broadcast_rows)


def _block_links(lists: DataFrame, sets: DataFrame, policy: NearPolicy) -> DataFrame:
    """Links across components of long lists, which have their blocks, found block by block on whole sets.

    Members outside a list's largest component meet each other and that component; members inside it do not
    meet. A task holds two blocks, and only links leave it.
    """
    rows = lists.withColumn("inner", F.col("component") == F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("inner_blocks")).otherwise(F.col("outer_blocks"))).cast("int")
    rows = rows.withColumn("own", own)
    outer = F.transform(
        F.sequence(F.lit(0), F.col("outer_blocks") - 1),
        lambda i: F.struct(F.lit(False).alias("to_inner"), F.least("own", i).alias("i"), F.greatest("own", i).alias("j")),
    )
    across = F.transform(
        F.sequence(F.lit(0), F.col("inner_blocks") - 1),
        lambda j: F.struct(F.lit(True).alias("to_inner"), F.col("own").alias("i"), j.alias("j")),
    )
    received = F.transform(
        F.sequence(F.lit(0), F.col("outer_blocks") - 1),
        lambda i: F.struct(F.lit(True).alias("to_inner"), i.alias("i"), F.col("own").alias("j")),
    )
    places = F.when(F.col("inner"), received).otherwise(F.concat(outer, across))
    placed = rows.select("value", "node", "component", F.explode(places).alias("place"))
    placed = placed.select("value", "place.*", "node", "component").join(sets, "node")

    def compare(group: pa.Table) -> pa.Table:
        links = block_links(group, policy)
        return pa.table({"high": pa.array([a for a, _ in links], pa.int64()), "low": pa.array([b for _, b in links], pa.int64())})

    return placed.groupBy("value", "to_inner", "i", "j").applyInArrow(compare, "high long, low long").distinct()


#: Distinct values whose occurrence is held as a matrix at a time.
COLUMNS = 4_096


def block_links(group: pa.Table, policy: NearPolicy) -> list[tuple[int, int]]:
    """Linked pairs of a group's rows (node, component, values) that are in different components."""
    nodes, components = group["node"].to_numpy(), group["component"].to_numpy()
    lists = group["values"].combine_chunks()
    sizes = pa.compute.list_value_length(lists).to_numpy()
    values, place = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    owners = np.repeat(np.arange(len(nodes)), sizes)
    order = np.argsort(place, kind="stable")
    place, owners = place[order], owners[order]
    common = np.zeros((len(nodes), len(nodes)), dtype=np.float64)
    for first in range(0, len(values), COLUMNS):
        start, stop = np.searchsorted(place, [first, first + COLUMNS])
        has = np.zeros((len(nodes), COLUMNS), dtype=np.float32)
        has[owners[start:stop], place[start:stop] - first] = 1
        common += has @ has.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = (100 * common >= policy.percent * union) & (components[:, None] != components[None, :])
    return [(int(max(nodes[a], nodes[b])), int(min(nodes[a], nodes[b]))) for a, b in zip(*np.nonzero(np.triu(linked)), strict=True)]


def near_components(docs: DataFrame, policy: NearPolicy = NearPolicy()) -> DataFrame:
    """Per document: row key, id, set size, the smallest id of its group, and whether it is the row that stays."""
    spark = docs.sparkSession
    path = scratch_path(spark, "labelled")
    # What is stored on the way goes when the rows have their components.
    with scratch_scope(spark):
        docs = addressable(docs.select("doc_id", "text"))
        made = sketches(docs, policy)
        members = _members(made)
        labels = _stars(made, members, docs, policy).select(F.col("high").alias("node"), F.col("low").alias("component"))
        labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        labelled.coalesce(max(1, math.ceil(members.count() / ROWS_PER_FILE))).write.parquet(path)
    return _with_groups(spark.read.schema(labelled.schema).parquet(path))


def _stars(made: DataFrame, members: DataFrame, docs: DataFrame, policy: NearPolicy) -> DataFrame:
    """(high, low): every node of a group but the smallest, with the smallest."""
    lists = _lists(_nodes(made, members, policy), policy)
    # Most documents share no rare value with any other: only the rest take part from here on.
    nodes = _sketched(lists.select("node").distinct(), docs, policy, lists.count())
    stars = None

    def contract(links: DataFrame, at_most: int | None = None) -> DataFrame:
        if stars is None:
            return component_stars(links, at_most)
        return component_stars(stars.union(links), None if at_most is None else at_most + stars.count())

    def decided(pairs: DataFrame) -> tuple[DataFrame, int]:
        open_pairs = materialise(_estimated(pairs, nodes, policy), "pairs")
        n = open_pairs.count()
        return _verified(open_pairs, docs, policy, n), n

    first = _with_list_values(
        lists.withColumn("component", F.col("node")), [F.min(_pivot(0)).alias("p")], [F.min("p").alias("p")]
    )
    stars = contract(*decided(_pivot_pairs(first, policy)))
    # The one pair of a list of two is decided by now.
    open_lists = _open_lists(lists, stars, 3, 1, policy)
    short = open_lists.where(F.col("members") <= policy.short_list)
    for turn in range(1, policy.pivot_rounds):
        long = open_lists.where(F.col("members") > policy.short_list)
        pairs = _pivot_pairs(long, policy)
        if turn == 1:
            pairs = pairs.union(_short_pairs(short, policy)).distinct()
        stars = contract(*decided(pairs))
        open_lists = _open_lists(long, stars, policy.short_list + 1, turn + 1, policy)
        if open_lists.isEmpty():
            return stars
    return contract(_block_links(open_lists, _whole_sets(open_lists, docs, policy), policy))


def _with_groups(rows: DataFrame) -> DataFrame:
    """Rows with their component: the group's smallest id, found and returned under salts."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(shuffle_partitions(rows.sparkSession))))
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW)
    parts = rows.groupBy("component", "salt").agg(F.min(best).alias("best"))
    groups = parts.groupBy("component").agg(F.min("best").alias("best"), F.collect_list("salt").alias("salts"))
    groups = groups.select("component", "best", F.explode("salts").alias("salt"))
    return rows.join(groups, ["component", "salt"]).select(
        ROW, "doc_id", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"),
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"),
    )
