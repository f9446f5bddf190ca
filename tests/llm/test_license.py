"""Licence rules and phrases against plain Python."""

import re

import pytest

from marquee.llm import license_rules, license_scan
from marquee.llm.queries import PHRASES
from textcases import table

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER))


def brute_spans(text, rules):
    """All detections, then those not inside one of better or equal priority, by comparing every two."""
    found = []
    for rule in rules:
        if rule.keyword in text.lower():
            for m in re.finditer("(?i)" + rule.pattern, text, re.ASCII):
                found.append((m.start(), m.end(), rule.priority, rule.order, rule.label))
    if not any(anchor in text.lower() for anchor in license_rules.ANCHORS):
        return set()

    def inside(a, b):
        if not (b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2]) or a is b:
            return False
        return (b[0], b[1]) != (a[0], a[1]) or b[2:4] < a[2:4]

    return {a for a in found if not any(inside(a, b) for b in found)}


TEXTS = [
    None, "", " ", "Released under the MIT License.", "UNDER THE MIT-LICENSE under the mit license",
    "under the mit licenses; under the mit_license é under the mitlicense", "éunder the mit license",
    "Licensed under the Apache License, Version 2.0 (https://www.apache.org/licenses/LICENSE-2.0)",
    "CC BY-NC 4.0 and cc by nc, licensed under CC BY-NC-SA 4.0. Creative Commons Attribution",
    "SPDX-License-Identifier: GPL-3.0-or-later\nThis program is free software, licensed under the GNU GPL version 3",
    "the BSD license, 3-clause BSD, BSD-2-Clause; (c) all rights reserved, without warranty of any kind",
    "GNU Lesser General Public License, LGPL v2.1, MPL; Mozilla Public License 2.0",
    "apache license version 2 " * 40 + "nothing", "plain words only", "mit license " * 3000,
]


@pytest.fixture(scope="module")
def scanned(spark):
    docs = table(spark, [(i, text, "en", "a") for i, text in enumerate(TEXTS)])
    found = license_scan.scan(docs, PHRASES)
    assert found.columns == [*docs.columns, "n_words", "places", "detections"]
    return found.cache()


def test_words_and_places(scanned):
    for row in scanned.collect():
        words = brute_words(TEXTS[row.doc_id] or "")
        assert row.n_words == len(words)
        wanted = []
        for phrase, label in PHRASES.items():
            own = phrase.split()
            wanted += [(label, i) for i in range(len(words)) if words[i: i + len(own)] == own]
        assert sorted((p.label, p.start) for p in row.places) == sorted(wanted)


def test_detections(scanned):
    rules = license_rules.rules()
    for row in scanned.collect():
        got = {(d.start, d.stop, d.priority, d.order, d.label) for d in row.detections}
        assert got == brute_spans(TEXTS[row.doc_id] or "", rules), row.doc_id


def test_summary(scanned):
    rows = {r.doc_id: r for r in license_scan.summary(scanned).collect()}
    assert (rows[3].labels, rows[3].n_base, rows[3].base_labels) == ("mit", 1, "mit")
    assert rows[9].labels == "gpl-3,gpl-text" or "gpl-3" in rows[9].labels.split(",")
    assert rows[0].first_word is None and rows[0].labels == "" and rows[0].score == 0
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows.values())


def test_rules_are_many_and_ordered():
    rules = license_rules.rules()
    assert len(rules) > 200 and [r.order for r in rules] == list(range(len(rules)))
    assert [r.priority for r in rules] == sorted(r.priority for r in rules)
    for rule in rules:
        re.compile(rule.pattern)


def samples(pattern):
    """Texts that the pattern matches: every alternative, optional parts left out and put in."""
    def of(node):
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "IN":
            return [of(entry)[0] for entry in value[:3]]
        if kind == "CATEGORY":
            return ["7" if "DIGIT" in str(value) else " " if "SPACE" in str(value) else "q"]
        if kind == "RANGE":
            return [chr(value[0])]
        if kind == "ANY":
            return ["q"]
        if kind in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = value
            return [text * n for n in sorted({least, min(least + 1, most)}) for text in series(inner)]
        if kind == "SUBPATTERN":
            return series(value[-1])
        if kind == "BRANCH":
            return [text for branch in value[1] for text in series(branch)]
        assert kind in ("ASSERT", "ASSERT_NOT", "AT"), kind
        return [""]

    def series(nodes):
        texts = [""]
        for node in nodes:
            texts = list(dict.fromkeys(head + tail for head in texts for tail in of(node)))
            if len(texts) > 3000:  # enough of what goes before: each further part still comes with all its forms
                texts = texts[::len(texts) // 1000]
        return texts

    return series(re._parser.parse(pattern))


def test_gates_let_every_match_through():
    for rule in license_rules.rules():
        texts = [text for text in samples(rule.pattern) if re.search(rule.pattern, text)]
        assert texts, rule
        for text in texts:
            assert rule.keyword in text, (rule, text)
            assert any(anchor in text for anchor in license_rules.ANCHORS), (rule, text)


STATED = {
    "Distributed under the terms of the Expat license.": "mit", "X11 License": "mit",
    "Licensed under Creative Commons Attribution 4.0.": "cc-by", "Creative Commons Zero 1.0 Universal": "cc0",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0": "cc-by-nc-nd", "CC BY-SA 4.0": "cc-by-sa",
    "https://www.eclipse.org/legal/epl-v10.html": "epl-1", "https://eclipse.org/legal/epl-2.0/": "epl-2",
    "https://mariadb.com/bsl11": "busl-1.1", "http://www.wtfpl.net/": "wtfpl", "without warranties of any kind": "no-warranty",
}


def test_detections_without_gates(spark):
    docs = table(spark, [(i, text, "en", "a") for i, text in enumerate([*STATED, *TEXTS])])
    rows = {r.doc_id: r for r in license_scan.scan(docs, PHRASES).collect()}
    for i, (text, label) in enumerate(STATED.items()):
        assert label in {d.label for d in rows[i].detections}, text
    for i, text in enumerate([*STATED, *TEXTS]):
        every = {(m.start(), m.end(), r.label) for r in license_rules.rules() for m in re.finditer("(?i)" + r.pattern, text or "", re.ASCII)}
        got = {(d.start, d.stop, d.label) for d in rows[i].detections}
        assert got <= every
        assert all(any(b[0] <= a[0] and a[1] <= b[1] for b in got) for a in every), text


def test_edge_table(edge, edge_rows, none):
    assert license_scan.summary(license_scan.scan(edge, PHRASES)).count() == len(edge_rows)
    assert license_scan.summary(license_scan.scan(none, PHRASES)).collect() == []
