import os

import pytest

from tests.oracle import connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Columns named like the operators' own.
EXTRA = ", row_key long, words string, label string, _id long, _key string, row string, key long"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def con():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with clashing columns."""

    def make(rows, extra=True):
        full = []
        for doc_id, text, *rest in rows:
            lang, source = rest or ("en", "src0")
            row = (doc_id, text, lang, source, None if text is None else len(text))
            full.append(row + (1, "w", "l", 2, "k", "r", 3) if extra else row)
        return spark.createDataFrame(full, DOCUMENT + EXTRA if extra else DOCUMENT)

    return make


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, repeated rows, one id with two texts."""
    return [
        (None, "no id at all here"),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n \r\x0b\x0c "),
        (4, LONG),
        (5, "repeated row of a few words"),
        (5, "repeated row of a few words"),
        (6, "one id"),
        (6, "with two texts"),
        (7, "Ünïcode wörds \U0001f600 and no-break separators"),
        (8, "null everywhere", None, None),
    ]
