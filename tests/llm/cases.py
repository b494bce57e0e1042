"""Rows that every text operator must take: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

# Columns named like those that operators add.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id string, row string, node long, "
    "kept boolean, score double, digest string"
)


def frame(spark, rows, partitions: int = 3):
    """(doc_id, text[, lang]) rows with further columns."""
    full = []
    for r in rows:
        doc, text, lang = (*r, None)[:3]
        size = None if text is None else len(text)
        full.append((doc, text, lang, "s", size, "x", None, 7, True, 0.5, "d"))
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


def prose(seed: int, words: int, alphabet: str = "abcdeghiklmnoprstuvw") -> str:
    """Made-up words with capitals, commas and line ends."""
    make = random.Random(seed)
    out = []
    for i in range(words):
        word = "".join(make.choice(alphabet) for _ in range(make.randint(1, 9)))
        out.append(word.capitalize() if i % 9 == 0 else word)
        if i % 9 == 8:
            out[-1] += make.choice([".", ",", ".\n"])
    return " ".join(out)


def word_list(text: str) -> list[str]:
    """Lower-case words of letters and digits, by plain Python."""
    return [w for w in ("".join(c for c in t if c.isalnum()) for t in text.lower().split()) if w]


def shingle_set(text: str) -> set[tuple[str, ...]]:
    words = word_list(text)
    n = min(5, max(len(words), 1))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
