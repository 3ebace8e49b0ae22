"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows,
and extra columns whose names clash with those the operators add."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "tu") for b in ("bar", "den", "fir", "gol", "hem", "jat", "pel")]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def documents(n=40, seed=1):
    """(doc_id, text, lang, source, n_chars): ordinary rows and the hard ones."""
    rows = [(i, prose(30 + i % 50, seed * 1000 + i), "en", f"s{i % 3}") for i in range(n)]
    rows += [
        (n, None, "en", "s0"), (n + 1, "", None, "s1"), (n + 2, " \t\n", "en", None), (None, prose(40, 77), "en", "s0"),
        (n + 3, "Ünïcode 漢字 \U0001f600 " * 30, "xx", "ŝ"), (n + 4, prose(60_000, 99), "en", "s2"),
        (n + 5, rows[0][1], "en", "s0"), (n + 5, rows[0][1], "en", "s0"), (5, prose(20, 55), "en", "s1"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOC_SCHEMA)
