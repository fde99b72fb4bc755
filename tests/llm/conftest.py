import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def documents(spark):
    """A function from (doc_id, text) rows to a documents table with further, clashing columns."""
    def make(rows):
        wide = [(i, t, "en", None, 7, "x", 1, 2, 3) for i, t in rows]
        return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, _text string, first int, digest int, copies int")
    return make
