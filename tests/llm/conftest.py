import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

LETTERS = "abcdé "


@pytest.fixture
def docs(spark):
    """Documents with nulls in every column, empty and long texts, repeated rows and columns with clashing names."""
    long = "der Hund läuft schnell über die Wiese und bellt laut " * 4000
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 44, "x", 1),
        (2, "the cat sat on the mat and looked at the dog", "en", "a", 44, None, None),
        (2, "the cat sat on the mat and looked at the dog", "en", "a", 44, None, None),
        (3, "der Hund läuft über die Wiese und bellt", "de", None, None, "y", 2),
        (4, None, "en", "a", None, "y", 2), (5, "", "de", "b", 0, "z", 3), (6, " \n\t ", None, None, 4, "z", 3),
        (7, long, "de", "a", len(long), "z", 3), (8, "12345 !!! 678", None, "a", 13, "z", 3),
        (None, "a text without an id that is quite short", "en", "a", 40, "z", 3),
        (10, "x" * 5000, "en", "a", 5000, "z", 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, sequence_id int")


@pytest.fixture
def none(docs):
    return docs.where("false")
