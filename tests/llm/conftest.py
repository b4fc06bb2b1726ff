import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

#: Schema of ``documents`` with a column whose name an operator might use itself.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, SPANS string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from (doc_id, text) pairs."""
    def make(*rows):
        data = [(i, t, "en", "s", len(t) if t is not None else None, "x") for i, t in rows]
        return spark.createDataFrame(data, SCHEMA)
    return make
