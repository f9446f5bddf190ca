"""Token counts and packing against the library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import packing, pieces, token_counts
from marquee.llm.common import load_tokenizer
from marquee.llm.queries import vocabulary

AWKWARD = [
    "", " ", "a  b", "foo \n bar", "a\n \nb", " x", "x ", "it's we'll don't", "a<|endoftext|>b <|startoftext|>",
    "é à  ñ\t\tz", "a \x1c b", "x y  z", "Σας ΟΔΟΣ", "12,000.50 $5!!! ##", "a\r\n\r\nb   c", "İ ﬁ K Å é é",
    "word... word?! 'tis", "你好 世界", "a" * 3000, "́x y", "naïve, coöperate. ÉÉÉ!",
]


@pytest.fixture(scope="module")
def spaced():
    definition = vocabulary("byte_bpe_50k.json")
    return load_tokenizer(definition), pieces.PieceTable(definition, " ", len, limit=40)


@pytest.fixture(scope="module")
def worded():
    definition = vocabulary("word_bpe_49k.json")
    table = pieces.PieceTable(definition, "", lambda ids: np.array(ids, "<u4").tobytes(), limit=40)
    return load_tokenizer(definition), table


def ids_of(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


TEXTS = st.lists(st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t.,'!*abcdest<|>0123éßñÄİΣς\x1c "), st.characters(codec="utf-8")
), max_size=60), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_lengths_are_the_librarys(spaced, texts):
    assert pieces.spaced_values(texts, spaced[1]) == [len(ids) for ids in ids_of(spaced[0], texts)]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_ids_are_the_librarys(worded, texts):
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.word_values(texts, worded[1])] == ids_of(worded[0], texts)


def test_awkward_texts(spaced, worded):
    assert pieces.spaced_values(AWKWARD, spaced[1]) == [len(ids) for ids in ids_of(spaced[0], AWKWARD)]
    assert [np.frombuffer(x, "<u4").tolist() for x in pieces.word_values(AWKWARD, worded[1])] == ids_of(worded[0], AWKWARD)


def test_counts_of_a_table(edge, edge_rows, spaced):
    got = token_counts.count_tokens(edge, vocabulary("byte_bpe_50k.json"))
    assert got.columns == [*edge.columns, "n_tokens"]
    wanted = [len(ids) for ids in ids_of(spaced[0], [text or "" for _, text, *_ in edge_rows])]
    assert sorted(r.n_tokens for r in got.collect()) == sorted(wanted)


def test_counts_of_nothing(none):
    assert token_counts.count_tokens(none, vocabulary("byte_bpe_50k.json")).collect() == []


def check_packing(rows, wanted, capacity):
    """``wanted``: the ids of each document in any order."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) > 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    found = []
    for own in documents.values():
        # Rows that share an id are told apart by what their starts continue.
        own.sort(key=lambda r: (r.start, r.ids))
        if sum(r.start == 0 for r in own) == 1:
            assert all(a.start + a.length == b.start for a, b in zip(own, own[1:], strict=False))
        found += [x for r in own for x in r.ids]
    assert sorted(found) == sorted(x for ids in wanted for x in ids)
    return sum(r.length for r in rows) / capacity / max(1, len(sequences))


def test_packing_of_a_table(edge, edge_rows, worded):
    wanted = [[*ids, 1] for ids in ids_of(worded[0], [text or "" for _, text, *_ in edge_rows])]
    rows = packing.pack(edge, vocabulary("word_bpe_49k.json"), with_ids=True).collect()
    check_packing(rows, wanted, 2048)


def test_packing_of_nothing(none):
    assert packing.pack(none, vocabulary("word_bpe_49k.json")).collect() == []


def test_packing_leaves_little_room(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").coalesce(1)
    rows = packing.pack(docs, vocabulary("word_bpe_49k.json"), with_ids=True).collect()
    tokenizer = load_tokenizer(vocabulary("word_bpe_49k.json"))
    wanted = [[*ids, 1] for ids in ids_of(tokenizer, [r.text for r in docs.collect()])]
    assert check_packing(rows, wanted, 2048) > 0.97


@pytest.mark.parametrize("ways", [1, 2, 3, 7])
def test_differencing_keeps_every_item(ways):
    rng = random.Random(ways)
    sizes = [rng.randint(1, 500) for _ in range(60)]
    groups = packing.differencing(sizes, ways)
    assert len(groups) == ways and sorted(i for g in groups for i in g) == list(range(60))
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) <= 40


def test_differencing_the_textbook_case():
    sums = sorted(sum((8, 7, 6, 5, 4)[i] for i in g) for g in packing.differencing([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]


def test_windows_rise_when_capacity_is_exceeded():
    groups = packing.windows_of([60, 60, 60], 100)
    assert len(groups) == 3
    assert packing.windows_of([], 100) == []
