"""Fixtures with the awkward cases every operator has to cope with."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cid string, digest int, n string, band int, slot string, kept string, row int"
CLASH = ("x", 1, "y", 2, "z", "w", 3)


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(words))


def near(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"edit{r.randrange(10**9)}" if r.random() < share else w for w in text.split(" "))


def awkward_rows() -> list[tuple]:
    """Copies, near copies, repeated rows, NULLs in any column, empty, blank and very long texts."""
    a, b = prose(1, 120), prose(2, 80)
    rows = [
        (10, a, "en", "s1", 1), (11, a, "en", "s1", 1), (12, a.replace(" ", "\n\t ", 3), "de", "s2", 1),
        (13, near(a, 5, 0.02), "en", "s1", 1), (14, near(a, 6, 0.03), "en", "s1", 1), (15, near(a, 7, 0.5), "en", "s2", 1),
        (20, b, None, None, None), (20, b, None, None, None), (21, b.upper(), "en", "s1", 1),
        (30, None, "en", "s1", 1), (31, "", "en", "s1", 1), (32, " \n\t ", None, "s1", 1), (33, "one two", "en", "s3", 1),
        (34, "one two", "en", "s3", 1), (40, prose(3, 30_000), "en", "s1", 1), (41, "word " * 500, "en", None, 1),
        (42, "ünïcödé — 漢字 テスト " * 30, "xx", "s1", 1), (None, prose(4, 60), "en", "s1", 1), (None, b, "en", "s1", 1),
        (50, "x\x01y  z\r\n\x0b\x0c end", "en", "s1", 1),
    ]
    rows += [(100 + i, near(prose(9, 90), i, 0.04), "en", "hot", 1) for i in range(30)]
    return [(*r, *CLASH) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
