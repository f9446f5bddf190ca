"""Texts and tables for the tests of the text operators."""

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, _key string, _text string, salt string, "
    "n string, kept string, score string"
)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(words))


def edited(text: str, seed: int, every: int) -> str:
    rng = random.Random(seed)
    words = text.split()
    for i in range(rng.randrange(every), len(words), every):
        words[i] = "q" + words[i]
    return " ".join(words)


def table(spark, rows):
    """Documents from (doc_id, text, lang, source), with further columns whose names the library uses itself."""
    full = [(*row, len(row[1] or ""), "k", "t", "s", "n", "yes", "x") for row in rows]
    return spark.createDataFrame(full, COLUMNS)
