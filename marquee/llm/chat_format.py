"""Transcripts to canonical chat turns: roles recovered by a hidden Markov model.

A row's text is cut at speaker-marker lines into blocks. Every block is observed through its marker, its length,
its number of lines, a closing question and whether it opens the transcript; hidden behind is the speaker's role.
Start, transition and observation probabilities are counted by grouped aggregation over transcripts whose roles
are known. The most probable roles (Viterbi) are found in bounded segments: each segment gives the best score from
every entering to every leaving role, the segments of a transcript are chained by these small tables, and each
segment is decoded between its two roles. A transcript of any length thus never meets in one task.

Defined cases: rows of a transcript are ordered by ``turn``, nulls first, then by their place in the table; a null
text counts as empty and is a block of its own; a null ``conv_id`` is a transcript of its own; rows without a
known role are decoded but not learned from; without any known role markers alone decide. Repeated rows are
repeated turns. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.config import SkewPolicy
from marquee.llm.common import ROW, addressable, ready, whole_text, with_row_key
from marquee.operators.skew import with_positions
from marquee.session import materialise

#: Words of speaker markers and the role each points to. Fixed values.
MARKERS = {
    "user": ("user", "human", "question", "prompt", "customer", "me", "you", "q"),
    "assistant": ("assistant", "ai", "bot", "answer", "response", "model", "agent", "gpt", "a"),
    "system": ("system", "instruction", "instructions", "context"),
}
NONE = 0  # code of a block without a marker; the roles of MARKERS follow in order


@dataclass(frozen=True)
class ChatPolicy:
    segment: int = 512
    smoothing: float = 0.5
    marker_weight: float = 50.0  # blocks that a marker is taken to have been seen with, before counting


def _marker(words: tuple[str, ...]) -> str:
    name = "|".join(sorted(words, key=len, reverse=True))
    return rf"[ \t]*(?:(?:#{{1,4}}[ \t]*|\*\*|<\|?|\[)(?:{name})[ \t]*(?:\|?>|\]|:?\*\*|:|(?=\n|$))[ \t]*:?|(?:{name})[ \t]*[:：])[ \t]*"


ANY_MARKER = "(?i)(?:" + "|".join(_marker(words) for words in MARKERS.values()) + ")"
#: Places where a new block begins: at the start of a line that carries a marker.
BLOCK_START = r"(?im)(?=^(?:" + "|".join(_marker(words) for words in MARKERS.values()) + "))"


def _log_bucket(x: Column, most: int) -> Column:
    return F.least(F.floor(F.log2(x + 1)), F.lit(most)).cast("int")


#: Values of each part of an observation: marker, length, lines, closing question, opening block.
SIZES = (len(MARKERS) + 1, 16, 4, 2, 2)
CODES = int(np.prod(SIZES))


def blocks(turns: DataFrame) -> DataFrame:
    """Rows cut into blocks, with the text without its marker and the observation (all but the opening flag)."""
    cut = F.filter(F.split(whole_text(), BLOCK_START, -1), lambda x: F.length(F.trim(x)) > 0)
    cut = F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))
    known = F.col("role") if "role" in turns.columns else F.lit(None).cast("string")
    # The outer kind: for the other, Spark would cut texts twice, first to leave out rows without blocks, which there are none of.
    rows = with_row_key(turns).select(ROW, "conv_id", "turn", known.alias("known"), F.posexplode_outer(cut).alias("block", "raw"))
    marker = F.lit(NONE)
    for code, words in reversed(list(enumerate(MARKERS.values(), 1))):
        marker = F.when(F.col("raw").rlike("(?i)^" + _marker(words)), F.lit(code)).otherwise(marker)
    rows = rows.withColumn("marker", marker).withColumn("text", F.regexp_replace("raw", "^" + ANY_MARKER, ""))
    rows = rows.withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", ""))
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    parts = (
        F.col("marker"), _log_bucket(F.length("text"), SIZES[1] - 1), _log_bucket(lines, SIZES[2] - 1),
        F.col("text").rlike(r"[?？][\s\"')]*$").cast("int"),
    )
    code = F.lit(0)
    for part, size in zip(parts, SIZES, strict=False):
        code = code * size + part
    return rows.select(ROW, "block", "conv_id", "turn", "known", "text", (code * SIZES[4]).alias("code"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Stored narrow rows with their position in the transcript, counted along a distributed sort."""
    narrow = rows.select(F.coalesce("conv_id", F.lit(-1)).alias("conv"), F.col("conv_id").isNull().alias("none"),
                         "turn", ROW, "block", "known", "code")
    narrow = materialise(narrow, "chat_rows")  # texts are cut here, and once more where they are rendered
    total = narrow.count()
    placed = with_positions(narrow, ["none", "conv"], ["turn", ROW, "block"], SkewPolicy(), total, total)
    opening = (F.col("position") == 0).cast("int")
    return materialise(placed.withColumn("code", F.col("code") + opening), "chat_blocks")


@dataclass
class RoleModel:
    """Roles, and log probabilities of the first one, of each after another, and of observations."""

    roles: list[str]
    start: np.ndarray
    step: np.ndarray
    seen: np.ndarray


def learn_roles(placed: DataFrame, policy: ChatPolicy) -> RoleModel:
    """Counts over placed blocks with a known role. Neighbours meet by (transcript, position), so no key is hot."""
    known = placed.where(F.col("known").isNotNull()).select("none", "conv", "position", "code", "known")
    roles = sorted(row["known"] for row in known.select("known").distinct().collect()) or sorted(MARKERS)
    place = {role: i for i, role in enumerate(roles)}
    start, step = np.full(len(roles), policy.smoothing), np.full((len(roles), len(roles)), policy.smoothing)
    parts = [np.full((len(roles), size), policy.smoothing) for size in SIZES]
    for code, role in enumerate(MARKERS, 1):
        if role in place:
            parts[0][place[role], code] += policy.marker_weight

    for row in known.where("position = 0").groupBy("known").agg(F.count(F.lit(1)).alias("n")).collect():
        if row["known"] in place:
            start[place[row["known"]]] += row["n"]
    after = known.select("none", "conv", (F.col("position") - 1).alias("position"), F.col("known").alias("then"))
    for row in known.join(after, ["none", "conv", "position"]).groupBy("known", "then").agg(F.count(F.lit(1)).alias("n")).collect():
        if row["known"] in place and row["then"] in place:
            step[place[row["known"]], place[row["then"]]] += row["n"]
    for row in known.groupBy("known", "code").agg(F.count(F.lit(1)).alias("n")).collect():
        if row["known"] in place:
            for part, value in zip(parts, np.unravel_index(row["code"], SIZES), strict=True):
                part[place[row["known"]], value] += row["n"]
    logs = [np.log(part / part.sum(axis=1, keepdims=True)) for part in parts]
    # The parts count as independent given the role; a rare combination still gets a fair probability.
    every = np.unravel_index(np.arange(CODES), SIZES)
    seen = sum(log[:, value] for log, value in zip(logs, every, strict=True))
    return RoleModel(roles, np.log(start / start.sum()), np.log(step / step.sum(axis=1, keepdims=True)), seen)


def segment_table(codes: list[int], first: bool, model: RoleModel) -> np.ndarray:
    """Best log probability of a segment from each entering role (the one before it) to each leaving role."""
    scores = np.tile(model.start, (len(model.roles), 1)) if first else model.step.copy()
    scores = scores + model.seen[:, codes[0]]
    for code in codes[1:]:
        scores = (scores[:, :, None] + model.step).max(axis=1) + model.seen[:, code]
    return scores


def chain(tables: list[np.ndarray]) -> list[int]:
    """Leaving roles of the segments on the best path through all of them; the first table's rows are alike."""
    scores, backs = tables[0][0], []
    for table in tables[1:]:
        reach = scores[:, None] + table
        backs.append(reach.argmax(axis=0))
        scores = reach.max(axis=0)
    path = [int(scores.argmax())]
    for back in reversed(backs):
        path.append(int(back[path[-1]]))
    return path[::-1]


def decode(codes: list[int], entering: int | None, leaving: int, model: RoleModel) -> list[int]:
    """Roles of a segment between the role before it (none at the start) and its last one."""
    scores = (model.start if entering is None else model.step[entering]) + model.seen[:, codes[0]]
    backs = []
    for code in codes[1:]:
        reach = scores[:, None] + model.step
        backs.append(reach.argmax(axis=0))
        scores = reach.max(axis=0) + model.seen[:, code]
    path = [leaving]
    for back in reversed(backs):
        path.append(int(back[path[-1]]))
    return path[::-1]


def _decoded(placed: DataFrame, model: RoleModel, policy: ChatPolicy) -> DataFrame:
    """(row key, block, position, role) of all placed blocks."""
    ready(placed.sparkSession)
    sent = placed.sparkSession.sparkContext.broadcast(model)
    own = F.struct("position", ROW, "block", "code")
    segment = F.floor(F.col("position") / policy.segment).cast("long").alias("segment")
    segments = materialise(
        placed.groupBy("none", "conv", segment).agg(F.sort_array(F.collect_list(own)).alias("rows")), "segments"
    )

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def tables(codes: pa.Array, firsts: pa.Array) -> pa.Array:
        found = [
            segment_table(own, first == 0, sent.value).ravel().tolist()
            for own, first in zip(codes.to_pylist(), firsts.to_pylist(), strict=True)
        ]
        return pa.array(found, pa.list_(pa.float64()))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def chained(listed: pa.Array) -> pa.Array:
        width = len(sent.value.roles)
        found = [chain([np.array(t).reshape(width, width) for t in own]) for own in listed.to_pylist()]
        return pa.array(found, pa.list_(pa.int32()))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def roles(codes: pa.Array, entering: pa.Array, leaving: pa.Array) -> pa.Array:
        found = [
            decode(own, before, last, sent.value)
            for own, before, last in zip(codes.to_pylist(), entering.to_pylist(), leaving.to_pylist(), strict=True)
        ]
        return pa.array(found, pa.list_(pa.int32()))

    with_tables = segments.select("none", "conv", "segment", tables(F.col("rows.code"), F.col("segment")).alias("table"))
    paths = with_tables.groupBy("none", "conv").agg(F.sort_array(F.collect_list(F.struct("segment", "table"))).alias("t"))
    paths = paths.select("none", "conv", chained(F.col("t.table")).alias("path"))
    # One pair of roles per segment goes back to it.
    before = F.concat(F.array(F.lit(None).cast("int")), F.slice("path", F.lit(1), F.size("path") - 1))
    pairs = F.arrays_zip(F.col("path").alias("leaving"), before.alias("entering"))
    ends = paths.select("none", "conv", F.posexplode(pairs).alias("segment", "x"))
    ends = ends.select("none", "conv", F.col("segment").cast("long").alias("segment"), "x.leaving", "x.entering")
    found = segments.join(ends, ["none", "conv", "segment"]).select(
        "rows", roles(F.col("rows.code"), F.col("entering"), F.col("leaving")).alias("found")
    )
    listed = found.select(F.explode(F.arrays_zip("rows", "found")).alias("x"))
    names = F.array(*map(F.lit, model.roles))
    return listed.select(f"x.rows.{ROW}", "x.rows.block", "x.rows.position", F.get(names, F.col("x.found")).alias("role"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>\n"))


def format_chats(turns: DataFrame, learn_from: Column | None = None, policy: ChatPolicy = ChatPolicy()) -> DataFrame:
    """Per block: conv_id, turn, block, position in its transcript, recovered role and canonical rendering.

    ``learn_from`` restricts the rows whose roles are learned from, as a condition on ``conv`` (the conv_id).
    """
    columns = [name for name in turns.columns if name in ("conv_id", "turn", "role", "text")]
    cut = blocks(addressable(turns.select(columns)))
    placed = _numbered(cut)
    model = learn_roles(placed if learn_from is None else placed.where(learn_from), policy)
    roles = _decoded(placed, model, policy)
    # Texts meet their roles by row and block, keys that are never shared.
    return cut.join(roles, [ROW, "block"]).select(
        "conv_id", "turn", "block", "position", "role", render(F.col("role"), F.col("text")).alias("rendered")
    )
