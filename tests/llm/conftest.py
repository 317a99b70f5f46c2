import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text) as a table with the columns of documents and some that clash with inner names."""

    def make(rows):
        rows = [(*r, "en", "s1", 0, "x", 1, "y", 2.0) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, n_chars long, id string, n int, label string, score double"
        return spark.createDataFrame(rows, kinds).repartition(3)

    return make
