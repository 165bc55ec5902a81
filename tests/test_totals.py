"""Trailing totals by hour sums: borders, NaN, NULL and hot keys, both joins, and no shuffle of raw rows."""

import datetime as dt
import random

import pytest

from gaugework.operators import windows
from gaugework.operators.windows import trailing_totals

T0 = dt.datetime(2023, 2, 6, 13, 37, 11)


def model(rows, hours=(24, 6, 1)):
    out = {}
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        last = max((t for _, t, _ in mine if t is not None), default=None)
        totals = []
        for h in hours:
            vs = [v for _, t, v in mine if t is not None and t > last - dt.timedelta(hours=h) and v is not None and v == v]
            totals.append(round(sum(vs), 6) if vs else None)
        out[k] = (last, *totals)
    return out


def rows():
    rng = random.Random(4)
    out = [(rng.choice(["a", "b", None]), T0 - dt.timedelta(seconds=rng.randrange(100_000)), rng.choice([1.25, 2.5, float("nan"), None])) for _ in range(300)]
    out += [("hot", T0 - dt.timedelta(seconds=7 * k), 0.5) for k in range(2000)]
    out += [("border", T0, 1.0)] + [("border", T0 - dt.timedelta(hours=h, microseconds=us), 10.0 ** h) for h in (1, 6) for us in (-1, 0, 1)]
    out += [("whole hour", dt.datetime(2023, 2, 6, 12), 1.0), ("whole hour", dt.datetime(2023, 2, 6, 11), 2.0), ("whole hour", dt.datetime(2023, 2, 6, 11, 0, 1), 4.0)]
    out += [("nan", T0, float("nan")), ("none", None, 3.0), ("one", T0, 3.0)]
    return out + out[:40]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("few", [0, 500_000])
def test_totals(spark, monkeypatch, kind, few):
    monkeypatch.setattr(windows, "BROADCAST_ROWS", few)
    data = rows()
    df = spark.createDataFrame(data, f"k string, ts {kind}, v double").repartition(5)
    got = {r.k: (r.latest_ts, *[None if x is None else round(x, 6) for x in (r.day_total, r.six_hr_total, r.one_hr_total)])
           for r in trailing_totals(df, "k", "ts", "v").collect()}
    assert got == model(data)


def test_other_hours_and_no_rows(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, ts timestamp, v double")
    got = {r.k: (r.latest_ts, *[None if x is None else round(x, 6) for x in (r.total_3h, r.total_48h)]) for r in trailing_totals(df, "k", "ts", "v", hours=(3, 48)).collect()}
    assert got == model(data, (3, 48))
    assert trailing_totals(df.limit(0), "k", "ts", "v").count() == 0


def test_latest_and_as_of_agree_on_null_keys(spark):
    df = spark.createDataFrame([(None, T0, 2.0), (None, T0 - dt.timedelta(hours=2), 3.0)], "k string, ts timestamp, v double")
    assert trailing_totals(df, "k", "ts", "v").first()["six_hr_total"] == 5.0
    fixed = trailing_totals(df, "k", "ts", "v", hours=(6,), anchor="as_of", as_of=str(T0)).first()
    assert (fixed["k"], fixed["six_hr_total"]) == (None, 5.0)


def test_raw_rows_are_not_shuffled(spark):
    df = spark.createDataFrame(rows(), "k string, ts timestamp, v double").withColumnRenamed("v", "raw")
    plan = trailing_totals(df, "k", "ts", "raw")._jdf.queryExecution().executedPlan().toString()
    raw = plan.index("ExistingRDD")
    assert "BroadcastHashJoin" in plan
    # above the scan of the raw rows: their join with the broadcast cuts, then the partial sums, then an exchange
    above = plan[:raw][::-1]
    assert above.index("BroadcastHashJoin"[::-1]) < above.index("HashAggregate"[::-1]) < above.index("Exchange hash"[::-1])
