"""Contamination, transcripts and the whole pipeline."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from marquee.llm import chat_format, decontaminate, near_dedup
from marquee.llm.common import addressable, with_row_key
from marquee.llm.queries import op5_decontamination, op6_chat_format
from textcases import edited, prose, table

POLICY = decontaminate.LeakPolicy()


def plain_score(a, b, p=POLICY):
    best, rows = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        same = p.match if a[i - 1] == b[j - 1] else -p.mismatch
        rows[i][j] = max(0, rows[i - 1][j - 1] + same, rows[i - 1][j] - p.gap, rows[i][j - 1] - p.gap)
        best = max(best, rows[i][j])
    return best / (p.match * len(a))


WORDS = st.lists(st.integers(0, 4), min_size=1, max_size=14)


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS)
def test_alignment_is_the_best(a, b):
    score, first, last = decontaminate.align(np.array(a), np.array(b), POLICY)
    assert abs(score - plain_score(a, b)) < 1e-12
    if score:
        assert abs(plain_score(a, b[first: last + 1]) - score) < 1e-12


def test_contamination_against_all_pairs(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    wanted = {}
    for doc in docs:
        words = decontaminate.words_of(doc.text or "")
        for item in items:
            own = decontaminate.words_of(item.text)
            if len(set(own) & set(words)) >= 0.5 * len(set(own)):  # a score of 0.6 needs more common words than that
                codes = {w: i for i, w in enumerate(dict.fromkeys(own))}
                score, *_ = decontaminate.align(
                    np.array([codes[w] for w in own]), np.array([codes.get(w, -1) for w in words]), POLICY
                )
                if score >= POLICY.least_score:
                    wanted.setdefault(doc.doc_id, []).append(item.item_id)
    got = {r.doc_id: r for r in op5_decontamination(spark, small).collect()}
    assert len(got) == len(docs)
    assert {i: r.n_items for i, r in got.items() if r.contaminated} == {i: len(x) for i, x in wanted.items()}
    assert all(got[i].item_id in x for i, x in wanted.items())


@pytest.fixture(scope="module")
def leaky(spark):
    items = [(i, prose(500 + i, 40)) for i in range(30)]
    rows = [(i, prose(i, 120), "en", "a") for i in range(1, 20)]
    rows.append((100, prose(31, 50) + " " + items[3][1] + " " + prose(32, 50), "en", "a"))
    rows.append((101, prose(33, 50) + "\n" + edited(items[4][1], 1, 6).upper() + "\n" + prose(34, 10), "en", "a"))
    words = items[5][1].split()
    del words[10:12]
    words.insert(20, "extra")
    rows.append((102, " ".join(words) + " " + items[6][1], "en", "a"))
    rows.append((103, " ".join(items[7][1].split()[:12]) + " " + prose(35, 80), "en", "a"))
    return table(spark, rows), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("policy", [
    POLICY, decontaminate.LeakPolicy(sent_hashes=100, held_hashes=300, broadcast_rows=0), decontaminate.LeakPolicy(stretch=3),
])
def test_copied_edited_and_partial_passages(leaky, policy):
    got = {r.doc_id: r for r in decontaminate.contamination(*leaky, policy).collect()}
    assert {i for i, r in got.items() if r.contaminated} == {100, 101, 102}
    assert (got[100].item_id, got[100].score, got[100].first_word, got[100].last_word) == (3, 1.0, 50, 89)
    assert got[101].item_id == 4 and got[102].n_items == 2 and got[102].item_id == 6
    assert got[103].item_id is None


def test_edited_copies_beside_verbatim_ones(spark):
    """The edits' n-grams are the rarest of an item once the others occur twice; they must not be its only seeds."""
    items = [(i, prose(700 + i, 40)) for i in range(3)]
    rows = [(i, prose(i, 120), "en", "a") for i in range(1, 10)]
    for i, (_, item) in enumerate(items):
        words = [f"new{i}x{at}" if at % 8 == 4 else word for at, word in enumerate(item.split())]
        rows.append((100 + i, prose(40 + i, 30) + " " + " ".join(words) + " " + prose(50 + i, 30), "en", "a"))
        rows.append((200 + i, item, "en", "b"))
    got = decontaminate.contamination(table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.item_id for r in got if r.contaminated} == {h + i: i for i in range(3) for h in (100, 200)}
    assert {r.score for r in got if 100 <= r.doc_id < 200} == {(2 * 35 - 5) / 80}


def test_a_phrase_of_all_items_is_no_seed_beside_rarer_ones(spark):
    """Where rarer n-grams stand beside it, the phrase gives none; inside, each stretch keeps one. Results do not change."""
    phrase = prose(640, 9)
    items = spark.createDataFrame([(i, f"{prose(600 + i, 12)} {phrase} {prose(660 + i, 12)}") for i in range(20)], "item_id long, text string")
    rows = [(i, f"{prose(i, 30)} {phrase} {prose(90 + i, 30)}", "en", "a") for i in range(40)]
    rows += [(100 + i, f"{prose(200 + i, 5)} {prose(600 + i, 12)} {phrase} {prose(660 + i, 12)}", "en", "a") for i in range(20)]
    docs = with_row_key(addressable(table(spark, rows).select("doc_id", "text")))
    numbered = decontaminate.numbered_items(items, POLICY)
    postings = decontaminate.item_postings(numbered, POLICY)
    hits = decontaminate._hits(docs, postings, [4], POLICY)
    seeds = Counter(r.hash for r in decontaminate.seeds_of(postings, hits, POLICY).collect())
    shared = decontaminate.item_grams(phrase.split(), POLICY).tolist()
    assert [gram in seeds for gram in shared] == [False, True, False, True, False, True] and seeds[shared[1]] == 20
    got = decontaminate.contamination(table(spark, rows), items).collect()
    assert {r.doc_id: r.item_id for r in got if r.contaminated} == {100 + i: i for i in range(20)}


def test_rarest_of_stretches():
    pos, df = np.array([0, 1, 2, 3, 7, 9, 10, 11]), np.array([5, 2, 9, 9, 4, 1, 1, 3])
    assert decontaminate.rarest_of_stretches(pos, df, 2).tolist() == [1, 3, 4, 6]
    assert decontaminate.rarest_of_stretches(pos, df, 3).tolist() == [1, 4, 6]
    assert decontaminate.rarest_of_stretches(pos[:0], df[:0], 2).tolist() == []
    rng = np.random.default_rng(0)
    for stretch in (1, 2, 4):
        pos = np.flatnonzero(rng.random(60) < 0.8)
        own = set(pos[decontaminate.rarest_of_stretches(pos, rng.integers(0, 5, len(pos)), stretch)].tolist())
        for at in range(60 - stretch + 1):
            window = range(at, at + stretch)
            assert not set(window) <= set(pos.tolist()) or own & set(window)


def test_short_items_are_sought_whole_where_they_are_asked_for(spark):
    items = spark.createDataFrame([(1, "Quaint word"), (2, "lone"), (3, "three more words"), (4, "")], "item_id long, text string")
    rows = [(1, "a QUAINT, word here", "en", "a"), (2, "quaint old word", "en", "a"), (3, "Lone", "en", "a"), (4, "more words", "en", "a")]
    got = {r.doc_id: r for r in decontaminate.contamination(table(spark, rows), items, decontaminate.LeakPolicy(least_words=1)).collect()}
    assert {i: r.item_id for i, r in got.items() if r.contaminated} == {1: 1, 3: 2}
    assert not any(r.contaminated for r in decontaminate.contamination(table(spark, rows), items).collect())


def test_far_parts_of_a_copy_count(spark):
    """Two words, one put in, and so on: the only n-gram lies at the copy's end, the first word 18 words further off."""
    words = prose(800, 40).split()
    spread = " ".join(w if at >= 36 or at % 2 == 0 else f"{w} put{at}" for at, w in enumerate(words))
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    row = decontaminate.contamination(table(spark, [(1, spread + " " + prose(2, 9), "en", "a")]), items).first()
    assert (row.contaminated, row.score, row.first_word, row.last_word) == (True, (80 - 18) / 80, 0, 57)


def test_contamination_defined_cases(spark, edge, edge_rows, none):
    items = spark.createDataFrame(
        [(1, None), (2, ""), (3, "too short"), (None, prose(1, 60)), (5, prose(1, 60)), (5, prose(1, 60))], "item_id long, text string"
    )
    got = decontaminate.contamination(edge, items).collect()
    assert len(got) == len(edge_rows)
    assert Counter(r.doc_id for r in got if r.contaminated) == {7: 2, 8: 1, 9: 1, 10: 1}
    assert {r.n_items for r in got if r.doc_id == 7} == {3}
    assert decontaminate.contamination(none, items).collect() == []
    assert not any(r.contaminated for r in decontaminate.contamination(edge, items.limit(0)).collect())


def random_model(seed, roles=3):
    rng = np.random.default_rng(seed)
    draw = lambda *shape: np.log(rng.dirichlet(np.ones(shape[-1]), shape[:-1] or None))
    return chat_format.RoleModel(list("abc")[:roles], draw(roles), draw(roles, roles), draw(roles, 6))


@pytest.mark.parametrize("seed", range(6))
def test_segments_decode_like_one_piece(seed):
    """Chained segments against every path, and against one long segment."""
    model, rng = random_model(seed), random.Random(seed)
    codes = [rng.randrange(6) for _ in range(7)]

    def score(path):
        total = model.start[path[0]] + model.seen[path[0], codes[0]]
        for i in range(1, len(path)):
            total += model.step[path[i - 1], path[i]] + model.seen[path[i], codes[i]]
        return total

    best = max(itertools.product(range(3), repeat=7), key=score)
    parts = [codes[:3], codes[3:5], codes[5:]]
    ends = chat_format.chain([chat_format.segment_table(own, i == 0, model) for i, own in enumerate(parts)])
    path, before = [], None
    for own, last in zip(parts, ends, strict=True):
        path += chat_format.decode(own, before, last, model)
        before = last
    assert score(path) == pytest.approx(score(best))


def test_roles_of_held_out_conversations(spark, small):
    source = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{small}/conversations.parquet").collect()}
    got = op6_chat_format(spark, small).collect()
    assert len(got) == len(source)
    tried = [r.role == source[r.conv_id, r.turn] for r in got if zlib.crc32(str(r.conv_id).encode()) % 5 == 0]
    assert np.mean(tried) > 0.9
    row = got[0]
    assert row.rendered.startswith(f"<|{row.role}|>\n") and row.rendered.endswith("\n<|end|>\n")


CHATS = "conv_id long, turn long, text string, role string, position string, block string, code string"


@pytest.mark.parametrize("segment", [512, 2])
def test_transcripts_with_markers(spark, segment):
    text = "System: be nice\nUser: hi there?\nAssistant: hello\nand more\n### Human\nbye"
    rows = [(1, 0, text, None), (1, 1, "**Assistant:** ok", None), (2, None, None, None), (2, 3, "", None),
            (None, None, "Q: why?", None), (3, 1, "A: so", None), (3, 1, "A: so", None)]
    table_ = spark.createDataFrame([(*r, "p", "b", "c") for r in rows], CHATS)
    got = chat_format.format_chats(table_, policy=chat_format.ChatPolicy(segment=segment)).collect()
    one = sorted((r.position, r.role, r.rendered.split("\n", 1)[1]) for r in got if r.conv_id == 1)
    assert [role for _, role, _ in one] == ["system", "user", "assistant", "user", "assistant"]
    assert [body for *_, body in one] == [f"{x}\n<|end|>\n" for x in ("be nice", "hi there?", "hello\nand more", "bye", "ok")]
    assert len(got) == 10 and sorted(r.position for r in got if r.conv_id == 3) == [0, 1]
    assert [r.role for r in got if r.conv_id is None] == ["user"]
    assert chat_format.format_chats(table_.limit(0)).collect() == []


def test_every_known_role_is_learned(spark):
    rows = [(1, i, f"turn {i}", f"role{i % 11:02}", "p", "b", "c") for i in range(55)]
    placed = chat_format._numbered(chat_format.blocks(addressable(spark.createDataFrame(rows, CHATS))))
    model = chat_format.learn_roles(placed, chat_format.ChatPolicy())
    assert model.roles == [f"role{i:02}" for i in range(11)]


def test_counts_of_roles_are_the_plain_ones(spark, small):
    """First roles, steps between neighbouring blocks and parts of observations, counted one by one."""
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    policy = chat_format.ChatPolicy()
    cut = chat_format.blocks(turns)
    placed = chat_format._numbered(cut)
    model = chat_format.learn_roles(placed, policy)
    transcripts = {}
    for r in cut.collect():
        transcripts.setdefault(r.conv_id, []).append((r.turn, r._key, r.block, r.known, r.code))
    roles = sorted({r[3] for own in transcripts.values() for r in own if r[3] is not None})
    assert model.roles == roles
    at = {role: i for i, role in enumerate(roles)}
    start, step = np.full(len(roles), 0.5), np.full((len(roles), len(roles)), 0.5)
    parts = [np.full((len(roles), n), 0.5) for n in chat_format.SIZES]
    for code, role in enumerate(chat_format.MARKERS, 1):
        if role in at:
            parts[0][at[role], code] += policy.marker_weight
    for own in transcripts.values():
        own.sort(key=lambda r: (r[0] is not None, r[0], r[1], r[2]))
        for i, (*_, known, code) in enumerate(own):
            if known is None:
                continue
            if i == 0:
                start[at[known]] += 1
            if i + 1 < len(own) and own[i + 1][3] is not None:
                step[at[known], at[own[i + 1][3]]] += 1
            for part, value in zip(parts, np.unravel_index(code + (i == 0), chat_format.SIZES), strict=True):
                part[at[known], value] += 1
    assert np.allclose(model.start, np.log(start / start.sum()))
    assert np.allclose(model.step, np.log(step / step.sum(axis=1, keepdims=True)))
    logs = [np.log(part / part.sum(axis=1, keepdims=True)) for part in parts]
    for code in (0, 7, 100, chat_format.CODES - 1):
        every = np.unravel_index(code, chat_format.SIZES)
        assert np.allclose(model.seen[:, code], sum(log[:, v] for log, v in zip(logs, every, strict=True)))


def test_one_long_transcript_is_cut(spark):
    rows = [(1, i, ("How is it, number %d?" if i % 2 == 0 else "It is as it is and goes on for much longer, %d.") % i,
             "user" if i % 2 == 0 else "assistant", "p", "b", "c") for i in range(300)]
    got = chat_format.format_chats(spark.createDataFrame(rows, CHATS), policy=chat_format.ChatPolicy(segment=16))
    assert all(r.role == ("user" if r.turn % 2 == 0 else "assistant") and r.position == r.turn for r in got.collect())


def test_pipeline_stages(spark, small, tmp_path):
    docs, benchmark = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "benchmark"))
    kept, before = [], docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, small).write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
        if i < 4:
            assert kept[i].columns == docs.columns, name
        before = kept[i]
    assert kept[0].count() >= 0.99 * docs.count()
    assert Counter(r.text for r in kept[1].collect()) == Counter({r.text for r in kept[0].collect()})
    sets = [near_dedup.shingles(r.text or "", 5) for r in kept[2].collect()]
    assert not any(a and b and len(a & b) >= 0.8 * len(a | b) for a, b in itertools.combinations(sets, 2))
    items = [r.text for r in benchmark.collect()]
    clean = [r.text for r in kept[3].collect()]
    assert not any(item in text for item in items for text in clean)
    assert {r.doc_id for r in kept[2].collect() if not any(item in r.text for item in items)} <= {r.doc_id for r in kept[3].collect()}
    assert {r.doc_id for r in kept[4].collect()} == {r.doc_id for r in kept[3].collect()}
    pieces = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert sum(pieces(corpus_pipeline.run(spark, small)).values()) >= kept[3].count()


def test_pipeline_defined_cases(spark, edge, none, small, tmp_path):
    for label, start in (("edge", edge), ("none", none)):
        start.write.parquet(f"{tmp_path}/{label}")
        docs = spark.read.parquet(f"{tmp_path}/{label}")
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, small)
            assert i == 4 or out.columns == edge.columns
            out.write.parquet(f"{tmp_path}/{label}{i}")
            docs = spark.read.parquet(f"{tmp_path}/{label}{i}")
        assert docs.isEmpty() == (label == "none")
