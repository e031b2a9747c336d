"""Every registered query against its DuckDB equivalent, on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_queries  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
#: Needs trained models, for which the smallest tables have too few rows; ``test_models.py`` covers its parts.
TRAINED = {"x8_live_scoring"}
CHECKED = sorted(set(entry.oracle_sql()) - TRAINED)


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(FOLDER)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(CHECKED) > 120


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_oracle(spark, duck, name):
    line = check_queries.compare(spark, duck, FOLDER, name)
    assert line.startswith("ok"), line


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["window_start", "borough"] and df.count() > 0
