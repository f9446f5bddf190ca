"""Exact and near copies, shards: brute force and defined cases."""

import hashlib
import math
import pathlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from textcases import edited, prose, table

from marquee.llm import components, exact_dedup, near_dedup, sharding
from marquee.session import shared_dir


def test_exact_groups(edge, edge_rows):
    got = exact_dedup.exact_groups(edge).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in edge_rows:
        groups[text or ""].append(doc_id)
    wanted = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        wanted.update((i, keep, len(ids), digest) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == wanted
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert len(kept) == len(groups) and set(kept.values()) == {1}


def test_exact_groups_of_nothing(none):
    assert exact_dedup.exact_groups(none).collect() == []


def test_colliding_names_are_told_apart(edge):
    """With three bits of hash nearly all chunks collide, and the groups stay the same."""
    few = exact_dedup.ChunkPolicy(hash_bits=3)
    rows = lambda df: Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())
    assert rows(exact_dedup.exact_groups(edge, few)) == rows(exact_dedup.exact_groups(edge))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=6000), max_size=6))
def test_chunks_make_up_the_text(texts):
    texts = [t.decode("latin-1") for t in texts]
    policy = exact_dedup.ChunkPolicy()
    for text, ends in zip(texts, exact_dedup.chunk_ends(pa.array(texts, pa.string()), policy).to_pylist(), strict=True):
        size = len(text.encode())
        sizes = np.diff([0, *ends])
        assert sum(sizes) == size and all(0 < s <= policy.most for s in sizes)
        assert all(s >= policy.least for s in sizes[:-1])


def test_chunks_follow_the_content():
    """A word put in front changes the first chunks only."""
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(60_000))
    policy = exact_dedup.ChunkPolicy()
    ends = exact_dedup.chunk_ends(pa.array([text, "new " + text], pa.string()), policy).to_pylist()
    cut = [{t[a:b] for a, b in zip([0, *e], e, strict=False)} for t, e in zip([text, "new " + text], ends, strict=True)]
    assert len(cut[0] & cut[1]) >= len(cut[0]) - 2


def test_shards(edge, edge_rows):
    got = sharding.shard_slots(edge, [1.0] * 16, 1.0).collect()
    assert len(got) == len(edge_rows)
    wanted = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in edge_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == wanted
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id is None}) == 1


def test_shards_of_nothing(none):
    assert sharding.shard_slots(none, [1.0, 2.0], 1.0).collect() == []


def test_shards_follow_weights_and_move_little(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    placed = sharding.assign_shards(sharding.assign_shards(keys, "k", [1, 2, 1], "a"), "k", [1, 2, 1, 4], "b").collect()
    share = Counter(r.a for r in placed)
    assert abs(share[1] / 20_000 - 0.5) < 0.02
    assert all(r.b in (r.a, 3) for r in placed) and abs(Counter(r.b for r in placed)[3] / 20_000 - 0.5) < 0.02
    with pytest.raises(ValueError):
        sharding.assign_shards(keys, "k", [1, 0])


def brute_components(rows, size, percent):
    sets = [near_dedup.shingles(t or "", size) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    wanted = Counter()
    for i, row in enumerate(rows):
        ids = groups[find(i)]
        wanted[row[0], len(sets[i]), min((x for x in ids if x is not None), default=None)] += 1
    return wanted, len(groups)


def check_components(docs, rows, policy):
    got = near_dedup.near_components(docs, policy).collect()
    wanted, groups = brute_components(rows, policy.words, policy.percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == wanted
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.component_id for r in got if r.kept)


def test_near_components_defined_cases(edge, edge_rows):
    check_components(edge, edge_rows, near_dedup.NearPolicy(words=3, percent=85))


def test_near_components_of_nothing(none):
    assert near_dedup.near_components(none).collect() == []


@pytest.fixture(scope="module")
def family(spark):
    """Copies of one text with edits of many sizes, some out of reach of the first of them, and other texts."""
    rng, base = random.Random(7), prose(70, 160)
    rows = [(i, edited(base, i, rng.choice((20, 35, 60, 90))), "en", "a") for i in range(70)]
    rows += [(100 + i, prose(100 + i, 30) + " " + prose(99, 60), "en", "a") for i in range(20)]
    rows += [(200 + i, prose(200 + i, 8), "en", "a") for i in range(10)] + [(300, prose(200, 8), "en", "b")]
    return table(spark, rows).cache(), rows


@pytest.mark.parametrize("policy", [
    near_dedup.NearPolicy(words=3, percent=85),
    near_dedup.NearPolicy(words=2, percent=70, kept=32, listed=16),
    near_dedup.NearPolicy(words=3, percent=85, short_list=3, block=8, pivot_rounds=2),
    near_dedup.NearPolicy(words=3, percent=85, short_list=3, block_values=600, pivot_rounds=1, broadcast_rows=0),
])
def test_near_components_of_a_family(family, policy):
    check_components(*family, policy)


def test_near_components_leave_one_table_behind(spark, family):
    def stored():
        return {path for path in pathlib.Path(shared_dir(spark).removeprefix("file:")).glob("marquee/*/*")}

    before = stored()
    near_dedup.near_components(*family[:1], near_dedup.NearPolicy(words=3, percent=85)).collect()
    assert [path.name for path in stored() - before] == ["labelled"]


def test_each_round_answers_its_lists_once(spark, family, monkeypatch):
    """Members of long lists meet one answer a round, pivot or blocks included, and blocks are dealt without another."""
    answered, plans = [], []
    once, links = near_dedup._with_list_values, near_dedup._block_links
    monkeypatch.setattr(near_dedup, "_with_list_values", lambda *a: answered.append(1) or once(*a))

    def dealt(*given):
        found = links(*given)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(near_dedup, "_block_links", dealt)
    policy = near_dedup.NearPolicy(words=3, percent=85, short_list=1, block=8)
    assert near_dedup.near_components(family[0], policy).count() == family[0].count()
    assert len(answered) == 1 + policy.pivot_rounds
    assert plans and all("salt" not in plan for plan in plans)


def test_blocks_of_whole_sets():
    policy = near_dedup.NearPolicy(percent=68)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 100)) for _ in range(25)]
    group = pa.table({"node": range(25), "component": [i % 7 for i in range(25)], "values": [own.tolist() for own in sets]})
    wanted = {
        (a, b) for a in range(25) for b in range(a) if a % 7 != b % 7
        and 100 * len(set(sets[a]) & set(sets[b])) >= 68 * len(set(sets[a]) | set(sets[b]))
    }
    assert wanted and set(near_dedup.block_links(group, policy)) == wanted


def test_estimate_is_exact_on_whole_sets():
    policy = near_dedup.NearPolicy(words=3, percent=85, kept=64)
    a, b = np.arange(60), np.arange(5, 64)
    assert near_dedup.estimate(60, 59, a, b, policy) == (100 * 55 >= 85 * 64, True)
    possible, certain = near_dedup.estimate(500, 500, np.arange(64), np.arange(64), policy)
    assert possible and not certain


def test_least_overlap_grows_with_the_set():
    policy = near_dedup.NearPolicy(words=3, percent=85)
    values = [near_dedup.least_overlap(n, policy) for n in range(1, 65)]
    assert values[0] == 1 and all(v <= math.ceil(0.85 * n) for n, v in enumerate(values, 1))


def test_components(spark):
    links = spark.createDataFrame([(2, 1), (3, 2), (9, 8), (8, 3), (20, 10), (30, 20), (30, 10)], "high long, low long")
    stars = {(r.high, r.low) for r in components.component_stars(links).collect()}
    assert stars == {(2, 1), (3, 1), (8, 1), (9, 1), (20, 10), (30, 10)}
    assert components.component_stars(links.limit(0)).collect() == []


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_chance_of_losing_a_pair_at_the_threshold(threshold):
    policy = near_dedup.NearPolicy(percent=round(100 * threshold))

    def below(n, least):
        return sum(math.comb(n, i) * threshold**i * (1 - threshold) ** (n - i) for i in range(least))

    error = policy.deviations * math.sqrt(threshold * (1 - threshold) / policy.kept)
    assert below(policy.kept, math.ceil((threshold - error) * policy.kept)) <= 1e-6
    sizes = range(math.floor(threshold * policy.listed) + 1, policy.listed + 1)
    assert max(below(size, near_dedup.least_overlap(size, policy)) for size in sizes) <= 1e-6


def test_groups_that_do_not_settle_are_an_error(spark, monkeypatch):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)], "high long, low long")
    monkeypatch.setattr(components, "MOST_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        components.component_stars(links)
    assert components.component_stars(links.limit(0)).collect() == []
