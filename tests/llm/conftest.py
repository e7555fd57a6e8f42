"""Small documents with every odd case, shared by the operators' tests."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = ["tion", "er", "an", "ou", "the", "ré", "st", "ich", "ó", "ble", "nd"]
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty, blank and long texts, copies, ties and repeated rows."""
    long = prose(1, 6000)
    base = prose(2, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (0, prose(3, 80), "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, base, "en", "b", 1),
        (3, " ".join(near), "en", None, None),
        (4, None, "en", "b", 0),
        (5, "", None, "b", 0),
        (6, " \n\t ", "en", "c", 0),
        (7, "Two words", "en", "c", 0),
        (8, "Two words", "en", "c", 0),
        (9, long, "de", "c", 0),
        (10, long[: len(long) // 2] + " " + prose(4, 200), "de", "", 0),
        (11, "line one here\nline one here\n\nline one here\nother", "fr", "d", 0),
        (12, "é" * 300, "fr", "d", 0),
        (None, prose(5, 60), None, "d", 0),
        (13, prose(6, 90), "en", "d", 0),
        (13, prose(6, 90), "en", "d", 0),
        (13, prose(7, 30), "en", "d", 0),
        (14, "a " * 500, "en", "e", 0),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
