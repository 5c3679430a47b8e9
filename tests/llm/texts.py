"""Documents for tests: plain ones, and one frame with every odd case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside or give out themselves.
CLASHES = "row long, words string, component_id string, kept string, copy_no string, digest string"


def invented(seed, words=80, vocabulary=4000):
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}x" for _ in range(words))


def frame(spark, texts, sources=None, ids=None):
    ids = range(len(texts)) if ids is None else ids
    sources = sources or ["a"] * len(texts)
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, SCHEMA)


def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns."""
    long_text = invented(1, 60_000) + " a@b.org " + "z" * 200_000 + "@" * 3000 + "1" * 50_000
    texts = [None, "", "   ", invented(2), invented(2), invented(3), long_text, "one", None]
    ids = [0, 1, 2, 3, 4, None, 6, 7, None]
    sources = ["a", None, "b", "a", "a", None, "c", "a", "a"]
    rows = [(i, t, None, s, None) for i, t, s in zip(ids, texts, sources)]
    rows += [rows[3], rows[3]]
    rows = [(*row, 1, "x", "y", "z", "u", "v") for row in rows]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHES}")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
