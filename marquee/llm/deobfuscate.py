"""Restoring disguised words: a noisy channel decoded by Viterbi under a character language model.

A disguised word is a path through a lattice: look-alike signs stand for letters, separators inside a word stand
for nothing, a drawn-out letter stands for one or two. The path whose letters are likeliest under character
trigrams, counting what each disguise costs, is the restored word. Where words are written letter by letter, each
space stands for nothing or for the end of a word. Signs around a token may be punctuation or letters: both are read.

Before that, characters that are not seen are dropped, and letters of other widths or with accents are read as written
and as plain ones. A token of pairs of letters is read as one of its single letters too, and a token with other signs
inside part by part. Words cut into pieces of any length are put together where the letters are likelier as one word.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Collection
from functools import lru_cache

import numpy as np

#: Letters that a sign may stand for. Fixed values.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "{": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
}
SEPARATORS = ".-_*~'`^·"
#: Signs that may hide a vowel inside a word.
MASKS = "*#"
VOWELS = "aeiou"
LOOKALIKE_COST, SEPARATOR_COST, DOUBLED_COST, SHORTENED_COST = -0.5, -0.3, -0.7, -1.5

SYMBOLS = 28  # 0 outside a word, 1 to 26 the letters, 27 a byte of any other letter

_LETTER = re.compile(r"[^\W\d_]")
_DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
_CLOSING = re.compile(r"^[^\w@$|+({<€£¥]+|[^\w]+$")
_SIGNS = re.escape("".join(LOOKALIKES))
#: Beginnings that may be punctuation: all signs, all but "!" that stand for no letter, all that stand for none.
_OPENING = tuple(map(re.compile, (r"\W*", r"[^\w@$|+({<€£¥]*", rf"[^\w{_SIGNS}]*")))
_ENDING = re.compile(r"\W+$")
_LETTERLIKE = re.compile(f"[{_SIGNS}{re.escape(SEPARATORS)}]*")
_MASKED = re.compile(rf"(?<=[^\W\d_])[{MASKS}](?=[^\W\d_])")
_PAIRS = re.compile(r"(?:([^\W\d_])\1){3,}")
#: Signs that no word is written with.
_OTHER_SIGNS = re.compile(rf"[^\w{_SIGNS}{re.escape(SEPARATORS + MASKS)}]+")
#: Characters that are not seen: joiners, marks of direction, soft hyphens, variation selectors. Fixed values.
_UNSEEN = re.compile("[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")


def byte_codes() -> np.ndarray:
    codes = np.zeros(256, dtype=np.int64)
    codes[ord("a"): ord("z") + 1] = np.arange(1, 27)
    codes[0x80:] = 27
    return codes


_CODES = byte_codes()


def trigram_counts(text: str) -> np.ndarray:
    codes = _CODES[np.frombuffer(("\n" + text.lower() + "\n").encode(), dtype=np.uint8)]
    keys = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
    return np.bincount(keys, minlength=SYMBOLS**3)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log p(third | first, second) from trigram counts, each order smoothed towards the one below."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


def tokens_of(text: str) -> list[str]:
    """Lower-cased tokens between white space, without characters that are not seen."""
    return (text if text.isascii() else _UNSEEN.sub("", text)).lower().split()


def folded(token: str) -> str:
    """The token in letters of usual width and without accents."""
    return "".join(ch for ch in unicodedata.normalize("NFKD", token) if not unicodedata.combining(ch)).lower()


def is_disguised(token: str) -> bool:
    """Has the token letters, and look-alikes, separators or drawn-out letters among them?"""
    if len(token) < 3 or token.isalpha() and not _DRAWN_OUT.search(token):
        return False
    letters = len(_LETTER.findall(token))
    signs = sum(ch in LOOKALIKES or ch in SEPARATORS or ch in MASKS for ch in token)
    return letters > 0 and (signs > 0 or _DRAWN_OUT.search(token) is not None) and letters + signs == len(token)


def bare(token: str) -> str:
    """The token without punctuation around it; signs that may stand for letters stay in front."""
    return _CLOSING.sub("", token)


def _runs(token: str) -> list[tuple[str, int]]:
    runs: list[tuple[str, int]] = []
    for ch in token:
        if runs and runs[-1][0] == ch:
            runs[-1] = ch, runs[-1][1] + 1
        else:
            runs.append((ch, 1))
    return runs


def _arcs(ch: str, times: int) -> list[tuple[str, float]]:
    """Letters that a run of one sign may stand for, and what that costs."""
    if ch in SEPARATORS or ch in MASKS:
        return [("", SEPARATOR_COST)]
    letters, cost = (LOOKALIKES[ch], LOOKALIKE_COST) if ch in LOOKALIKES else (ch, 0.0)
    if times == 1:
        return [(x, cost) for x in letters]
    single, double = (SHORTENED_COST, 0.0) if times == 2 else (0.0, DOUBLED_COST)
    return [(x, cost + single) for x in letters] + [(x + x, cost + double) for x in letters]


#: Scores of the states of a lattice (the last two codes), each with its letters as a chain (chain before, letters).
States = dict[tuple[int, int], tuple[float, tuple | None]]


def _follow(states: States, letters: str, cost: float, model: np.ndarray, reached: States) -> None:
    """Enter into ``reached`` where the letters lead from each state, if nothing better is there."""
    codes = [_CODES[byte] for byte in letters.encode()]
    for (a, b), (score, text) in states.items():
        total = score + cost
        for code in codes:
            total += model[a, b, code]
            a, b = b, code
        if (a, b) not in reached or total > reached[a, b][0]:
            reached[a, b] = total, (text, letters) if letters else text


def _best(states: States, model: np.ndarray) -> tuple[float, str]:
    """Score and letters of the best state in which a word may end."""
    score, chain = max(
        ((score + model[a, b, 0], chain) for (a, b), (score, chain) in states.items()), key=lambda end: end[0]
    )
    parts = []
    while chain:
        chain, letters = chain
        parts.append(letters)
    return score, "".join(reversed(parts))


def restore(token: str, model: np.ndarray, sure: int | None = None) -> str:
    """The likeliest letters behind a token, or behind its likeliest beginning of more than ``sure`` signs."""
    states: States = {(0, 0): (0.0, None)}
    seen, best = 0, (-np.inf, "")
    for ch, times in _runs(token):
        if sure is not None and seen > sure:
            best = max(best, _best(states, model), key=lambda end: end[0])
        reached: States = {}
        for letters, cost in _arcs(ch, times):
            _follow(states, letters, cost, model, reached)
        states, seen = reached, seen + times
    return max(best, _best(states, model), key=lambda end: end[0])[1]


PUNCTUATION = ".,;:!?()\"'"


def readings(token: str, model: np.ndarray) -> list[str]:
    """Words that a token may stand for, as written, with plain letters, with single ones for pairs, and part by part."""
    words = _readings(token, model)
    core = token.strip(PUNCTUATION)
    if core[:1] == core[1:2] and _PAIRS.fullmatch(core):
        words += _readings(core[::2], model)
    if not token.isascii() and (plain := folded(token)) != token:
        words += _readings(plain, model)
    if core.isalpha():  # as most tokens are
        return words if len(words) < 2 else list(dict.fromkeys(words))
    if len(_MASKED.findall(token)) == 1:  # each vowel: trigrams alone cannot tell which
        words += [word for vowel in VOWELS for word in _readings(_MASKED.sub(vowel, token), model)]
    parts = [part for part in _OTHER_SIGNS.split(token) if part]
    if len(parts) > 1:
        letters = [_LETTER.findall(part) for part in parts]
        if all(len(own) == 1 for own in letters):  # a letter to each part
            words.append("".join(own[0] for own in letters))
        else:
            words += [word for part in parts if len(part) > 1 for word in _readings(part, model)]
    return list(dict.fromkeys(words))


def _readings(token: str, model: np.ndarray) -> list[str]:
    """Readings of one spelling: signs around it are read as punctuation, and where they can be as letters."""
    if token.isalpha() and not _DRAWN_OUT.search(token):
        return [token]
    stop = len(_ENDING.sub("", token))
    further = stop + len(_LETTERLIKE.match(token, stop)[0].rstrip(SEPARATORS))
    words = []
    for start in dict.fromkeys(opening.match(token).end() for opening in _OPENING):
        core, whole = token[start:stop], token[start:further]
        words.append(restore(core, model) if is_disguised(core) else core)
        if core and len(whole) > len(core) and is_disguised(whole):
            words += [restore(whole, model), restore(whole, model, len(core))]
    return list(dict.fromkeys(filter(None, words)))


@lru_cache(maxsize=1 << 16)
def _single(token: str) -> str:
    """The sign of a token of one sign, without punctuation around it; a space for any other token."""
    if len(token) > 1 and token[:2].isalnum():  # no punctuation around a sign leaves two of them
        return " "
    for own in (token, bare(token), re.sub(r"^\W+|\W+$", "", token)):
        if len(own) == 1 and (own.isalpha() or own in LOOKALIKES):
            return own
    return " "


def log_likelihood(words: list[str], model: np.ndarray) -> float:
    """Of the letters of words after one another, each begun and ended."""
    total = 0.0
    for word in words:
        a = b = 0
        for byte in word.encode():
            code = _CODES[byte]
            total += model[a, b, code]
            a, b = b, code
        total += model[a, b, 0]
    return total


def joined_pieces(tokens: list[str], known: Collection[str], beginnings: Collection[str], model: np.ndarray) -> list[str]:
    """Known words that neighbouring tokens make together and are likelier as one word than as several.

    ``beginnings`` are those of the known words; pieces are taken in while they make one.
    """
    found = []
    for at in [i for i, token in enumerate(tokens) if token in beginnings]:
        word, pieces = tokens[at], [tokens[at]]
        for place in range(at + 1, len(tokens)):
            piece = tokens[place] if tokens[place].isalpha() else bare(tokens[place])
            word += piece
            pieces.append(piece)
            if word in known and log_likelihood([word], model) > log_likelihood(pieces, model):
                found.append(word)
            if word not in beginnings or piece != tokens[place]:
                break
    return found


def spaced_words(tokens: list[str], least: int = 3) -> list[str]:
    """Words written letter by letter: runs of at least ``least`` tokens of one sign each, joined."""
    return re.findall(f"[^ ]{{{least},}}", "".join(map(_single, tokens)))


def restore_spaced(run: str, model: np.ndarray) -> list[str]:
    """The likeliest words behind a run of signs, between any two of which a word may end.

    A sign's letters are entered where its repetition ends: until then, ``pending`` holds the states before it by how
    often it came (three times stands for more).
    """
    pending: dict[int, States] = {1: {(0, 0): (0.0, None)}}

    def closed(ch: str) -> States:
        reached: States = {}
        for times, states in pending.items():
            for letters, cost in _arcs(ch, times):
                _follow(states, letters, cost, model, reached)
        return reached

    for before, ch in zip(run, run[1:], strict=False):
        done = closed(before)
        fresh: States = {} if ch == before else dict(done)
        for (a, b), (score, text) in done.items():
            total = score + model[a, b, 0]
            if (b, 0) not in fresh or total > fresh[b, 0][0]:
                fresh[b, 0] = total, (text, " ")
        longer: dict[int, States] = {}
        if ch == before:
            for times, states in pending.items():
                held = longer.setdefault(min(times + 1, 3), {})
                for at, state in states.items():
                    if at not in held or state[0] > held[at][0]:
                        held[at] = state
        pending = {1: fresh, **longer}
    return _best(closed(run[-1]), model)[1].split()
