from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, score string, label string, kept string, at string"
#: Nulls in every column, empty, blank and very long texts, repeated rows and ties, characters beyond the BMP.
ODD = [
    (1, "a b c d e f g", "en", "s1"),
    (1, "a b c d e f g", "en", "s1"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (None, "x y", None, "s2"),
    (4, "Word number one. " * 60_000, "en", "s1"),
    (5, " \t\n\x0b\x0c\r", "de", "s2"),
    (6, "a b  c d e\nf g", "en", "s1"),
    (7, "\U0001f600 é  ok \x1c", "fr", "s3"),
    (None, None, None, None),
    (8, "x y", "en", None),
    (-9, "12 34 !?", "en", "s2"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 0, 1, "r", "s", "l", "k", "@") for r in ODD], DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}
