from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, q long, kept string, word string"

#: Nulls in every column, empty and blank texts, ties, repeated rows, one very long text.
AWKWARD = [
    (1, None, None, None, None, 7, "x", "w"),
    (2, "", "en", "a", 0, None, None, None),
    (3, " \n\t ", "en", "a", 4, 1, "y", "w"),
    (4, "one two", "en", "a", 7, 1, "y", "w"),
    (5, "same words here " * 30, "en", "a", 0, 1, "y", "w"),
    (6, "same words here " * 30, "de", "b", 0, 1, "y", "w"),
    (6, "same words here " * 30, "de", "b", 0, 1, "y", "w"),
    (7, "Ünïcode — \U0001f600 wörds and spaces  <|endoftext|> it's\r\nok" * 3, "de", "b", 0, 1, "y", "w"),
    (8, " ".join(f"w{i % 977}" for i in range(60_000)), "fr", "c", 0, 1, "y", "w"),
    (None, "no id at all but some words", None, "c", 0, 1, "y", "w"),
    (9, "x" * 300_000, "en", None, 0, 1, "y", "w"),
    (20, "123 456 !!! ...", "en", "b", 0, 1, "y", "w"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    path = Path("/root/testdata/sf0.001/documents.parquet")
    if not path.exists():
        pytest.skip("no test tables")
    return spark.read.parquet(str(path))
