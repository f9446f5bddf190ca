"""Token ids of texts by way of their pieces: a piece is tokenized once per worker and then looked up.

A byte-level or word-level BPE never merges across a pre-token boundary, so a text may be cut at any such
boundary and the parts tokenized apart. Texts are cut at single spaces (or all white space), which is always a
boundary; of pieces not seen before, closing punctuation is cut off too, and plain words go straight to the merges. What the cuts cannot vouch for (texts
with added-token strings or rare control characters) goes to the tokenizer whole. Results are the library's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

from marquee.llm.common import load_tokenizer

#: Closing punctuation that always starts a pre-token of its own after a letter. No apostrophe: that may be a contraction.
TAIL = ".,;:!?*&%$#"
#: Longer pieces are not kept: they hardly come again.
LONGEST_KEPT = 64

#: Letters below this one are written alike in all versions of Unicode and have no decomposed form of their own.
PLAIN_BELOW = "\u0180"

_SPACE_BEFORE_SPACE = re.compile(r" (?:\s|\Z)")
_SPACE_BEFORE_WORD = re.compile(r" (?=\S)")
_CONTROL = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where printable, else one above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


BYTE_LETTERS = _byte_letters()


def is_plain(piece: str) -> bool:
    """Is the piece one pre-token of letters that normalization leaves as they are?"""
    return piece.isalpha() and (piece.isascii() or max(piece) < PLAIN_BELOW)


def spaced_pieces(text: str) -> list[str]:
    """Cut at each space that a word follows; every piece but the first has lost that space."""
    return _SPACE_BEFORE_WORD.split(text) if _SPACE_BEFORE_SPACE.search(text) else text.split(" ")


class PieceTable:
    """Values of pieces: a fixed part sent along and two generations that this worker learns.

    When the young generation has grown to ``limit`` it becomes the old one; what is found there again is taken
    back into the young one, so frequent pieces stay and rare ones go.

    ``lead`` is what was cut off before a piece (one space, or nothing); ``value`` makes a value from a piece's
    ids, and values of neighbours are added.
    """

    def __init__(self, definition: str, lead: str, value: Callable, fixed: dict | None = None, limit: int = 600_000):
        self.tokenizer = load_tokenizer(definition)
        self.model = self.tokenizer.model
        self.added = [token["content"] for token in json.loads(definition).get("added_tokens") or []]
        self.lead, self.value, self.fixed, self.limit = lead, value, dict(fixed or {}), limit
        self.table, self.old, self.bare = dict(self.fixed), {}, {}
        self.passing: list[str] = []
        self.lead_letters = "".join(BYTE_LETTERS[byte] for byte in lead.encode())

    def encode(self, pieces: list[str]) -> list:
        found = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
        return [self.value(encoding.ids) for encoding in found]

    def encode_led(self, piece: str):
        """Value of a plain piece after ``lead``: the merges alone, without the steps before them."""
        if not piece.isascii():  # plain ASCII letters are written as they are
            piece = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self.value([token.id for token in self.model.tokenize(self.lead_letters + piece)])

    def has_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def learn(self, pieces: Iterable[str]) -> None:
        """Make sure that all pieces are in the table."""
        missing = set(pieces).difference(self.table)
        if not missing:
            return
        table, old = self.table, self.old
        self.passing += [piece for piece in missing if len(piece) > LONGEST_KEPT]
        ends, cores = {}, set()
        for piece in missing:
            if piece in old:
                table[piece] = old[piece]
                continue
            core = piece.rstrip(TAIL)
            if core != piece and core and core[-1].isalpha():
                ends[piece] = core
            cores.add(core if piece in ends else piece)
        others = []
        for core in cores.difference(table):
            if core in old:
                table[core] = old[core]
            elif is_plain(core):
                table[core] = self.encode_led(core)
            else:
                others.append(core)
        table.update(zip(others, self.encode([self.lead + core for core in others]), strict=True))
        self.learn_bare(piece[len(core):] for piece, core in ends.items())
        bare = self.bare
        for piece, core in ends.items():
            table[piece] = table[core] + bare[piece[len(core):]]

    def learn_bare(self, pieces: Iterable[str]) -> None:
        missing = list(set(pieces).difference(self.bare))
        if missing:
            self.passing += [piece for piece in missing if len(piece) > LONGEST_KEPT]
            self.bare.update(zip(missing, self.encode(missing), strict=True))

    def trim(self) -> None:
        """Forget long pieces, and the older half of what was learned once it is too much. Only speed depends on it."""
        for piece in self.passing:
            self.table.pop(piece, None)
            self.bare.pop(piece, None)
        self.passing = []
        if len(self.table) > self.limit + len(self.fixed):
            self.table, self.old = dict(self.fixed), self.table
        if len(self.bare) > self.limit // 10:
            self.bare = {}


def spaced_values(texts: list[str], known: PieceTable) -> list:
    """Values of whole texts for a vocabulary in which a word includes the space before it."""
    cut = [None if known.has_added(text) else spaced_pieces(text) for text in texts]
    known.learn(set().union(*(pieces[1:] for pieces in cut if pieces)))
    known.learn_bare({pieces[0] for pieces in cut if pieces})
    find, bare = known.table.__getitem__, known.bare
    values = [
        known.encode([text])[0] if pieces is None else sum(map(find, pieces[1:]), bare[pieces[0]])
        for text, pieces in zip(texts, cut, strict=True)
    ]
    known.trim()
    return values


def word_values(texts: list[str], known: PieceTable) -> list[bytes]:
    """Ids, as joined bytes, of whole texts for a lower-casing vocabulary that drops white space.

    Lower-casing first makes pieces alike. It commutes with the vocabulary's own except for the capital sigma,
    whose lower case depends on its neighbours; and the library counts four control characters as symbols that
    Python counts as white space. Texts with either go to the tokenizer whole.
    """
    cut = [
        None if known.has_added(text) or "Σ" in text or _CONTROL.search(text) else text.lower().split()
        for text in texts
    ]
    known.learn(set().union(*filter(None, cut)))
    find = known.table.__getitem__
    values = [
        known.encode([text])[0] if pieces is None else b"".join(map(find, pieces))
        for text, pieces in zip(texts, cut, strict=True)
    ]
    known.trim()
    return values
