"""Shared fixtures of small tables."""

from __future__ import annotations

import random

LONG = "word " * 30_000


def documents(spark, rows):
    """(doc_id, text) rows as a table of documents, with columns that clash with results."""
    full = [(i, t, "en", "src0", None if t is None else len(t), "clash", 9.5) for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double"
    )


def words(seed: int, n: int, letters: str = "abcdefghij") -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(letters, k=draw.randint(2, 7))) for _ in range(n))
