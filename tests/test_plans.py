"""Plan-shape tests: the scale properties the design relies on, read from explain()."""

import contextlib
import io

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in entry.queries().items():
        if name != "stream_top5_state":
            out[name] = plan(fn(spark, SF))
    return out


def test_no_cross_products_anywhere(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_top_k_limits_before_the_shuffle(plans):
    p = plans["top5_per_key"]
    tree = p.split("\n\n")[0]
    # partial WindowGroupLimit under the Exchange, final one above it
    assert tree.count("WindowGroupLimit") == 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_latest_per_key_is_an_aggregate(plans):
    tree = plans["latest_per_key"].split("\n\n")[0]
    assert "Window" not in tree
    assert tree.count("Aggregate") >= 2  # partial (map side) + final


def test_coordinate_maths_appears_once(plans):
    # the national-grid conversion has two fixed-step iterations (two aggregate() calls)
    assert plans["station_areas_view"].count("aggregate(") == 2
    assert plans["grid_to_lonlat"].count("aggregate(") == 2


def test_filters_and_columns_reach_the_scan(plans):
    p = plans["readings_json"]
    assert "GreaterThan(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_breach_pre_aggregates_readings(plans):
    p = plans["record_breach"]
    assert "HashAggregate" in p and "max(" in p
