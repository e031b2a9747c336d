import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

TEXT = "doc_id long, text string"


@pytest.fixture
def texts(spark):
    """Rows (doc_id, text) as a table with further columns whose names operators use inside."""

    def make(rows, parts=3):
        frame = spark.createDataFrame([(i, t, 1, "x", b"y", 2) for i, t in rows], TEXT + ", n int, label string, key binary, fragment int")
        return frame.repartition(parts) if rows else frame

    return make
