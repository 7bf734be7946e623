from __future__ import annotations

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

PLAIN = "the quick brown fox jumps over the lazy dog and runs away from all of them again "
ODD_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, PLAIN * 2, "en", "b", len(PLAIN) * 2),
    (4, PLAIN * 2, "en", "b", len(PLAIN) * 2),
    (5, PLAIN * 2, "en", "b", len(PLAIN) * 2),
    (6, "one", "en", None, 3),
    (7, "é😀 ñandú ß", "es", "c", 10),
    (None, "no id here, but some words in a row", "en", "c", 35),
    (9, "x" * 30_000 + " " + "word " * 5_000, "en", "a", 55_001),
    (10, "1" * 4_000 + " 4111 1111 1111 1111 a@b.co +1 (555) 555-1234 10.0.0.1", "en", "a", 4_060),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in all columns, empty and very long texts, repeated rows, and equal texts of two ids."""
    return spark.createDataFrame(ODD_ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
