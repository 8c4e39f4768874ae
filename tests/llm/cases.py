"""Small documents with every awkward case, and brute-force helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, row string, `a.b` int"


def words(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n)]


def edited(ws: list[str], edits: int, seed: int) -> list[str]:
    r, out = random.Random(seed), list(ws)
    for at in r.sample(range(len(ws)), edits):
        out[at] = f"edit{r.randint(0, 10**6)}"
    return out


def frame(spark, texts: list[tuple]):
    """Documents of (doc_id, text), with extra columns whose names clash with internal ones."""
    return spark.createDataFrame(
        [(i, t, ["en", None, "xx", "fr"][n % 4], None, None if t is None else len(t), "x", "y", 1)
         for n, (i, t) in enumerate(texts)], SCHEMA)


def awkward() -> list[tuple]:
    long = " ".join(words(6000, 1))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "one "), (None, "one"), (None, "lonely text"),
            (6, long), (7, long), (8, "\n".join(words(300, 2))), (9, "the " * 400), (10, "ñandú ÉTÉ 漢字 😀 \x1c\x85 x")]
