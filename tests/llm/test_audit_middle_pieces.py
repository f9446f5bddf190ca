"""Divergence of sources, fill-in-the-middle and SentencePiece ids against plain Python and the library."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from textcases import prose, table

from marquee.llm import fill_in_middle, sentence_pieces
from marquee.llm.divergence import AuditPolicy, PatternTree, audit, f_of, terms_of
from marquee.llm.fill_in_middle import MiddlePolicy, Units, digests, transformed
from marquee.llm.sentence_pieces import ChunkTablePolicy, bodies, encode

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_audit(rows, least=10, top=10):
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        own = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(own)
        documents[lang or ""].update(set(own))

    def ranked(lang, source, part, values):
        ordered = sorted(values, key=lambda x: (-x[1], x[0].encode()))
        return {(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)}

    found, f = set(), lambda p, q: (p - q) ** 2 // (p + q)
    for lang in documents:
        kept = [term for term, n in documents[lang].items() if n >= least]
        own = {source: c for (other, source), c in counts.items() if other == lang}

        def p(count, kept=kept):
            total = sum(count[term] for term in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        smooth, whole = {source: p(c) for source, c in own.items()}, p(sum(own.values(), Counter()))
        for source, c in own.items():
            others = [(o, sum(f(smooth[source][t], smooth[o][t]) for t in kept)) for o in own if o != source]
            found |= ranked(lang, source, "pair", others)
            terms = [(t, f(smooth[source][t], whole[t])) for t in kept if c[t] and smooth[source][t] > whole[t]]
            found |= {row for row in ranked(lang, source, "term", terms) if row[-1] <= top}
    return found


def words(rng, n, kinds):
    return " ".join(rng.choice(["Wort", "mot", "naïve", "Été", "don't", "x1y"]) + "abcdefgh"[rng.randrange(8)] * rng.randrange(kinds)
                    for _ in range(n))


@pytest.fixture(scope="module")
def spread_rows():
    """A hot source, sources with few documents, repeated rows, nulls, a language whose terms are all rare."""
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randint(0, 60), 3), "en", "hot" if i % 3 else f"s{i % 30}") for i in range(150)]
    rows += [(i, words(rng, 20, 2), "fr", rng.choice("ab")) for i in range(40)] + rows[:20]
    return rows + [(None, None, None, None), (1, "", "en", "empty"), (2, "only here", "de", "one"), (3, "123 !", "de", "two")]


def test_audit_is_the_plain_one(spark, spread_rows, edge, edge_rows):
    got = [tuple(r) for r in audit(table(spark, spread_rows).repartition(5)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(spread_rows)
    low = AuditPolicy(least_documents=2, top_terms=3)
    assert {tuple(r) for r in audit(edge, low).collect()} == plain_audit(edge_rows, 2, 3)


def test_audit_does_not_depend_on_its_bounds(spark, spread_rows):
    """Small tables in the tasks, small trees, and groups joined by a shuffle."""
    docs = table(spark, spread_rows).repartition(3)
    tight = AuditPolicy(held_terms=7, path_entries=5, pairs_at_once=3, broadcast_bytes=0)
    assert {tuple(r) for r in audit(docs, tight).collect()} == plain_audit(spread_rows)


def test_audit_of_nothing(none):
    assert audit(none).collect() == []


def test_terms():
    assert [x for x in terms_of("A-b ÀÉ ñx_9É".encode()) if x] == [x.encode() for x in ("a", "b", "ÀÉ", "ñx", "É")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=5, max_size=5), st.integers(1, 4)), max_size=12), st.integers(1, 9))
def test_tree_corrects_every_pair_of_a_row_once(rows, at_once):
    """Rows are counts of five sources; equal rows come with one multiplicity, as from the aggregation."""
    sums = Counter()
    for counts, times in rows:
        sums[tuple((s, 10 + 7 * n) for s, n in enumerate(counts) if n)] += times
    paths = sorted(path for path in sums if path)
    entries = [entry for path in paths for entry in path]
    empty = [3, 5, 4, 9, 8]
    tree = PatternTree(
        np.array([s for s, _ in entries], dtype=np.int64), np.array([p for _, p in entries], dtype=np.int64),
        np.array([empty[s] for s, _ in entries], dtype=np.int64), np.array([len(path) for path in paths], dtype=np.int64),
        np.array([sums[path] for path in paths], dtype=np.int64),
    )
    distinct = {path[: i + 1] for path in paths for i in range(len(path))}
    assert len(tree.nodes) == len(distinct)
    got, wanted = Counter(), Counter()
    for a, b, value in tree.corrections(at_once):
        for x, y, v in zip(a.tolist(), b.tolist(), value.tolist(), strict=True):
            got[x, y] += v
    for path in paths:
        for i, (a, p) in enumerate(path):
            for b, q in path[:i]:
                x, y, u, v = (np.int64(n) for n in (p, q, empty[a], empty[b]))
                wanted[a, b] += int(sums[path] * (f_of(x, y) - f_of(x, v) - f_of(u, y) + f_of(u, v)))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in wanted.items() if v}


UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain_middle(doc_id, text):
    text = text or ""
    units, h = UNIT.findall(text), hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    n, draws = len(units), [int(h[i: i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (n + 1) for x in draws[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if draws[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def texts_with_markers(edge_rows):
    awkward = ["a<P>b", "<S>", "x <M", "<", "P><S", "日本 x", "\n\n", "é" * 30, "a<b", "<P <S> x", "ab " * 300]
    return edge_rows + [(100 + i, text, "en", "a") for i, text in enumerate(awkward * 4)]


@pytest.mark.parametrize("units", [1, 7, 16_384])
def test_middle_is_the_plain_one(spark, edge_rows, units):
    rows = texts_with_markers([row for row in edge_rows if units > 1 or len(row[1] or "") < 10_000])
    wanted = [plain_middle(doc_id, text) for doc_id, text, *_ in rows]
    docs = table(spark, rows).repartition(3)
    policy = MiddlePolicy(chunk_units=units)
    got = [tuple(r) for r in transformed(docs, policy).collect()]
    assert Counter(got) == Counter(wanted)
    digested = Counter(tuple(r) for r in digests(docs, policy).collect())
    assert digested == Counter(
        (*found[:5], sha(found[5]), sha(text or "")) for found, (_, text, *_) in zip(wanted, rows, strict=True)
    )
    assert {row[2] for row in got} == {"plain", "psm", "spm"}


def test_middle_of_nothing(none):
    assert digests(none).collect() == [] and transformed(none).collect() == []


@pytest.mark.parametrize("units", [1, 5, 16_384])
def test_restoration_reads_the_output(units):
    """The text comes from the pieces as written, markers and all; a changed piece changes it."""
    for doc_id in range(30):
        text = prose(doc_id, 50)
        header, *pieces = fill_in_middle.pieces_of(doc_id, text.encode(), MiddlePolicy(chunk_units=units))
        assert b"".join(pieces).decode() == plain_middle(doc_id, text)[5]

        def restored(written, form=header[2]):
            segment, found = 0, []
            for place, piece in enumerate(written):
                segment, own = fill_in_middle.restored_place(form, segment, piece)
                found.append((segment, place, own))
            return b"".join(own for _, _, own in sorted(found)).decode()

        assert restored(pieces) == text
        assert restored([*pieces[:-1], pieces[-1] + b"!"]) != text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aZ9 é日<\n", max_size=80))
def test_units(text):
    found, data = UNIT.findall(text), text.encode()
    units = Units(data)
    places = np.cumsum([0] + [len(unit.encode()) for unit in found]).tolist()
    assert units.count == len(found) and [units.offset(i) for i in range(len(found) + 1)] == places
    assert units.chars(0, len(data)) == len(text)


def test_units_across_blocks(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "BLOCK", 5)
    test_units.hypothesis.inner_test("abc éé日 abcdefghijkl 99x<P>zz")


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


SPACED = [
    " ", "  ", "a  b", " x", "x ", "▁", "▁x", "x▁y", "x ▁ y", "a\n b", "\x00 a", "<s> </s> <unk>", "<0x0A>", "日本 語",
    "é à  ñ\t\tz", "   lead and trail   ", "a" * 3000, "ﬁ Ａ é ", "    ", "🙂 🙂🙂", "\r\n", "12,000.50 $5",
]


def wanted_ids(library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    return ids, library.decode(ids)


def test_pieces_are_the_librarys(spark, edge_rows, model, library):
    rows = edge_rows + [(100 + i, text, "en", "a") for i, text in enumerate(SPACED)]
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids, decoded = wanted_ids(library, text or "")
        packed = np.array(ids, dtype="<u4").tobytes()
        wanted[doc_id, len(ids), hashlib.sha256(packed).hexdigest(), sha(decoded), tuple(ids), decoded] += 1
    docs = table(spark, rows).repartition(3)
    tight = ChunkTablePolicy(block_bytes=2_000, pack_rows=2, batch=3, table_words=5, bucket_bytes=60_000)
    for policy in (ChunkTablePolicy(), ChunkTablePolicy(pack_rows=2), tight):
        found = encode(docs, model, policy, with_ids=True, with_text=True).collect()
        assert Counter((*r[:4], tuple(r.ids), r.decoded) for r in found) == wanted


def test_pieces_of_nothing(none, model):
    assert encode(none, model).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tab<>éß日."), st.characters(codec="utf-8")), max_size=60))
def test_chunks_are_segmented_alike_wherever_they_stand(library, model, text):
    pieces = sentence_pieces.Pieces(model)
    own = bodies(text.encode())
    ids = pieces.ids(own)
    assert [i for part in ids for i in part] == library.encode(text)
    assert b"".join(pieces.texts(ids))[1:].decode() == library.decode(library.encode(text))


def test_crossing_vocabularies_are_refused(model):
    from sentencepiece import sentencepiece_model_pb2

    parsed = sentencepiece_model_pb2.ModelProto()
    parsed.ParseFromString(model)
    parsed.pieces[500].piece = "of▁the"
    with pytest.raises(ValueError, match="cross"):
        sentence_pieces.refuse_crossing_pieces(parsed.SerializeToString())
    parsed.ParseFromString(model)
    parsed.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="changes texts"):
        sentence_pieces.refuse_crossing_pieces(parsed.SerializeToString())


def test_texts_are_coded_once(spark, small, model):
    """Both uses of the blocks read one exchange, so that block names agree and texts are cut once."""
    found = encode(spark.read.parquet(f"{small}/documents.parquet"), model)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("MapInArrow code") == 1 and "ReusedExchange" in final


def test_one_word_is_segmented_once(spark, model, monkeypatch):
    """All blocks' occurrences of a chunk are answered by one task, whatever number of blocks holds it."""
    rows = [(i, "same words in each text", "en", "a") for i in range(40)]
    docs = table(spark, rows).repartition(8)
    policy = ChunkTablePolicy()
    coded = [row for row in sentence_pieces.coded_blocks(docs, policy, 4).collect() if row.bucket is not None]
    buckets = defaultdict(set)
    for row in coded:
        for word in sentence_pieces.unpack(row.payload):
            buckets[word].add(row.bucket)
    assert all(row.place == str(row.bucket) for row in coded)
    assert len({row.block for row in coded}) == 8 and all(len(found) == 1 for found in buckets.values())
    assert set(buckets) == {b"same", b"words", b"in", b"each", b"text"}
