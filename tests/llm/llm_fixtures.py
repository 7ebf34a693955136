"""Fixtures of the tests in this folder."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, RID string, hit int"


def passage(seed, n):
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


def fixture_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a long text, shared passages, other columns with clashing names."""
    a, b, long = passage(1, 80), passage(2, 60), passage(3, 4000)
    texts = [(1, a), (2, f"{passage(4, 30)} {a} {passage(5, 20)}"), (3, None), (4, ""), (5, " \t\n "), (6, b), (6, b), (None, b),
             (7, "x"), (8, long), (9, f"{passage(6, 10)}\n{b}\n{passage(7, 5)}\n{a}"), (10, passage(8, 34)), (11, "é " * 120), (12, "é " * 119 + "ü"),
             (13, f"{passage(9, 3)}\n{b}\n{passage(7, 5)}\nend"), (14, "same\nsame\nsame\nsame"), (15, a.replace(" ", "\n")), (16, a.upper()),
             (17, "zero\x00byte" * 30), (18, long[:900])]
    return [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 2}", len(t) if t else None, "r", k) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
