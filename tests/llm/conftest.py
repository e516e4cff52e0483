import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, "
           "h1 string, size string, node string, rank int, label string, number int, task string")
LONG = "lorem ipsum dolor sit amet " * 8000


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), "x", "y", "z", 1, "l", 2, "t")


@pytest.fixture(scope="session")
def make(spark):
    """Documents with extra columns whose names the operators use inside."""
    return lambda rows: spark.createDataFrame([row(*r) for r in rows], COLUMNS)


@pytest.fixture(scope="session")
def odd(make):
    """NULLs in any column, empty and very long texts, ties, repeated rows."""
    line = "This line is shared by many documents of the table"
    return make([
        (1, None), (2, ""), (3, "   \n\t "), (4, LONG), (5, f"{line}\nown words here and there"),
        (6, f" {line.upper()} \n\nother"), (7, f"{line}\n{line}"), (7, f"{line}\n{line}"),
        (8, "12345 !!! 678"), (9, "Ünïcode wörds ßtay", None, None), (None, f"{line}\nno id", "en", None),
        (10, "one", None, None), (11, "a b c d e f g h i j"), (12, "a b c d e f g h i j"), (12, "different text"),
    ])


@pytest.fixture(scope="session")
def empty(make, odd):
    return odd.limit(0)
