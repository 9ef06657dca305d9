from __future__ import annotations

import pytest

LONG = " ".join(f"w{i % 97}x{i * i % 89}" for i in range(4000))
#: id, text: nulls, empties, white space only, ties, repeated rows, a very long text.
HARD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two"), (5, "one two"),
        (6, LONG), (7, LONG), (None, "no id here"), (None, None), (8, "É🙂 日本 <s> ▁ a b\x1c\x00c"),
        (9, "same words here again " * 40), (10, "same words here again " * 40)]


@pytest.fixture()
def hard(spark):
    """Documents with every awkward case, extra columns with clashing names."""
    rows = [(i, t, 1, "x", 2.0, True, i) for i, t in HARD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, quality int, _rk string, n_words double, kept boolean, seed long").repartition(3)


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, quality int, _rk string")


@pytest.fixture()
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
