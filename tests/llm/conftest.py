import sys
from pathlib import Path

import pytest

from tripforge.session import Workspace

sys.path.insert(0, str(Path(__file__).parent))

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, band string, copy long, _key string"


@pytest.fixture
def work(spark):
    made = Workspace(spark, "test")
    yield made
    made.close()


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and long texts, copies, repeated rows, and columns whose names clash."""
    sentence = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 2
    rows = [
        (1, sentence, "en", "a", 1, "x", 7, "k"),
        (2, sentence.upper(), "en", "a", 1, None, 7, "k"),
        (3, sentence + "and one more", "en", "b", 1, "x", 7, "k"),
        (4, None, None, None, None, None, None, None),
        (5, "", "en", "a", 0, "x", 7, "k"),
        (6, "word " * 60_000, "de", "a", 1, "x", 7, "k"),
        (7, " \t\n", "de", None, 1, "x", 7, "k"),
        (8, "é" * 400 + "\nline\nline", "fr", "b", 1, "x", 7, "k"),
        (8, "é" * 400 + "\nline\nline", "fr", "b", 1, "x", 7, "k"),
        (None, sentence, "en", "a", 1, "x", 7, "k"),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
