"""Rows that every operator has to live with."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, target string, "
    "kept string, key string, id string, score string, print string, n string"
)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns named like results."""
    rng = random.Random(5)
    passage = words(rng, 90)
    long = words(rng, 60_000)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", "en", None), (4, passage, None, "a"),
        (4, passage, None, "a"), (5, passage, "en", None), (None, passage + " end", "en", "b"), (None, None, None, None),
        (6, long, "en", "a"), (7, "start " + long, "en", "b"), (8, "x" * 3000, "en", "c"), (9, "12 34 %%", "en", "c"),
        (10, "Ünï cödé \U0001f600 " * 60, "de", "c"), (11, words(rng, 3), "de", "d"), (12, words(rng, 200), "fr", "d"),
        (13, words(rng, 30) + " " + passage + " " + words(rng, 30), "es", "d"),
    ]
    full = [(i, t, lang, source, None if t is None else len(t), "s", "t", "k", None, "i", "7", "p", "n") for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
