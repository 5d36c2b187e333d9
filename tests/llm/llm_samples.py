"""Tables that the tests share."""

import pytest
from conftest import SMALL

TRICKY = [
    (1, "The cat sat on the mat and looked at the moon all night long"), (2, None), (3, ""), (4, "  \n\t "), (5, "one"),
    (6, "é ü ñ İ K"), (7, "x" * 3000), (8, "the cat sat on the mat and looked at the moon all night long"),
    (1, "The cat sat on the mat and looked at the moon all night long"), (None, "no id at all"), (9, "word " * 30_000),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def tricky(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns whose names results also have."""
    rows = [(i, t, "en", 1.5, "s", 7) for i, t in TRICKY]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double, label string, n_words int")
