import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text[, source]) tuples."""

    def make(rows, extra=""):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *r[3:]) for r in rows]
        return spark.createDataFrame(rows, DOCS + (", " + extra if extra else ""))

    return make
