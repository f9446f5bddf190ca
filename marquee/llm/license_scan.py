"""Licence detection by ordered signature rules, in DataFrame functions alone.

A text is looked at only if it holds one of a few anchor words, and a rule's pattern is tried only where the
rule's keyword occurs. Detections are intervals of characters. One that lies inside another of better or equal
priority is suppressed (of equal intervals with equal priority the earlier rule's stays): detections are sorted
by start and falling end, and the furthest end seen per priority tells in one pass. Everything happens in a
document's own row, so there is no shuffle, and copies or hot sources make no difference.

Besides, phrases can be counted: word sequences, wherever their words stand consecutively.

Defined cases: null counts as empty, and an empty text has no words and no detections; repeated rows are scanned
each. Further columns pass through untouched. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import free_name, whole_text
from marquee.llm.license_rules import ANCHORS, Rule, rules

#: Characters of words: digits, letters of either case, and all beyond ASCII.
NOT_IN_WORDS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WORD, BREAK = f"[^{NOT_IN_WORDS}]", f"[{NOT_IN_WORDS}]"


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{WORD}+")).cast("long")


def phrase_starts(text: Column, lowered: Column, phrase: str) -> Column:
    """Word numbers at which the phrase stands, found by cutting the text before each first word of it."""
    first, *rest = (re.escape(word) for word in phrase.split())
    follow = "".join(f"{BREAK}+{word}" for word in rest)
    pattern = f"(?i)(?<!{WORD}){first}(?={follow}(?!{WORD}))"
    before = F.transform(F.split(text, pattern, -1), count_words)
    found = F.aggregate(
        F.slice(before, F.lit(1), F.greatest(F.size(before) - 1, F.lit(0))),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda seen, words: F.struct(
            (seen["at"] + words + 1).alias("at"), F.array_append(seen["starts"], seen["at"] + words).alias("starts")
        ),
        lambda seen: seen["starts"],
    )
    gate = F.lit(True)
    for word in phrase.split():
        gate = gate & F.contains(lowered, F.lit(word))
    return F.when(gate, found).otherwise(F.array().cast("array<bigint>"))


SPAN = "struct<start:int,stop:int,priority:int,order:int,label:string,confidence:double>"


def _spans(text: Column, rule: Column) -> Column:
    """Intervals that a rule's pattern matches, summed up from the matches and what lies between them."""
    pattern = F.concat(F.lit("(?i)"), rule["pattern"])
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit")
    )

    def add(seen: Column, piece: Column) -> Column:
        start = seen["at"] + F.length(piece["gap"])
        stop = start + F.length(piece["hit"])
        span = F.struct(
            start.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"),
            rule["order"].alias("order"), rule["label"].alias("label"), rule["confidence"].alias("confidence"),
        ).cast(SPAN)
        return F.when(piece["hit"].isNull(), seen).otherwise(
            F.struct(stop.alias("at"), F.array_append(seen["found"], span).alias("found"))
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))
    return F.aggregate(pieces, empty, add, lambda seen: seen["found"])


def _unsuppressed(spans: Column, levels: int) -> Column:
    """Spans in text order without those inside another of better or equal priority."""
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), (-x["stop"]).alias("back"), x["priority"].alias("priority"),
        x["order"].alias("order"), x.alias("span"),
    )))

    def step(seen: Column, x: Column) -> Column:
        span = x["span"]
        inside = F.array_max(F.slice(seen["ends"], F.lit(1), span["priority"])) >= span["stop"]
        ends = F.transform(
            seen["ends"],
            lambda end, i: F.when(i == span["priority"] - 1, F.greatest(end, span["stop"])).otherwise(end),
        )
        kept = F.when(inside, seen["kept"]).otherwise(F.array_append(seen["kept"], span))
        return F.struct(ends.alias("ends"), kept.alias("kept"))

    empty = F.struct(
        F.array_repeat(F.lit(0), levels).alias("ends"), F.array().cast(f"array<{SPAN}>").alias("kept")
    )
    return F.aggregate(ordered, empty, step, lambda seen: seen["kept"])


def detections(text: Column, lowered: Column, signatures: Sequence[Rule]) -> Column:
    """The spans that stay of all rules whose keyword the lower-cased text holds."""
    table = F.array(*(
        F.struct(
            F.lit(rule.keyword).alias("keyword"), F.lit(rule.pattern).alias("pattern"),
            F.lit(rule.priority).alias("priority"), F.lit(rule.order).alias("order"),
            F.lit(rule.label).alias("label"), F.lit(rule.confidence).alias("confidence"),
        )
        for rule in signatures
    ))
    anchored = F.lit(False)
    for anchor in ANCHORS:
        anchored = anchored | F.contains(lowered, F.lit(anchor))
    tried = F.filter(table, lambda rule: F.contains(lowered, rule["keyword"]))
    spans = F.flatten(F.transform(tried, lambda rule: _spans(text, rule)))
    levels = max(rule.priority for rule in signatures)
    return F.when(anchored, _unsuppressed(spans, levels)).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(docs: DataFrame, phrases: dict[str, str], signatures: Sequence[Rule] | None = None) -> DataFrame:
    """The table with ``n_words``, ``places`` (label, start) of the phrases and ``detections`` of the rules."""
    signatures = rules() if signatures is None else signatures
    whole, low = free_name(docs, "_text"), free_name(docs, "_lowered")
    rows = docs.withColumn(whole, whole_text()).withColumn(low, F.lower(whole))
    text, lowered = F.col(whole), F.col(low)

    def labelled(phrase: str, label: str) -> Column:
        starts = phrase_starts(text, lowered, phrase)
        return F.transform(starts, lambda at: F.struct(F.lit(label).alias("label"), at.alias("start")))

    places = [labelled(phrase, label) for phrase, label in phrases.items()]
    return rows.select(
        *docs.columns, count_words(text).alias("n_words"), F.concat(*places).alias("places"),
        detections(text, lowered, signatures).alias("detections"),
    )


#: Confidence of a phrase found word for word.
PHRASE_CONFIDENCE = 0.9


def summary(scanned: DataFrame) -> DataFrame:
    """Counts, first and last place, label lists and score from ``places`` and ``detections``."""
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base = F.transform("places", lambda place: place["label"])
    starts = F.transform("places", lambda place: place["start"])
    sure = F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0))
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.greatest(sure, F.when(F.size("places") > 0, PHRASE_CONFIDENCE).otherwise(0.0)).alias("score"),
    )
