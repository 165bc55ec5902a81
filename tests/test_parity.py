"""Every registered query against its DuckDB statement (the driver's gate), at sf0.001."""

import os

import pytest

import __spark_entry__ as entry
from gaugework.plans import registry as catalog
from tools.oracle_compare import compare

SF = os.environ.get("GAUGEWORK_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(catalog.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res.startswith("OK") or res.startswith("rows-only"), res


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["rloi_id", "direction", "station_type", "qualifier", "processed_value", "value_timestamp",
                          "trend", "age_seconds", "por_max_breached", "at_risk", "forecast", "level"]
