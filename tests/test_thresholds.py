"""L15/L16/V13 on payloads rebuilt as our own rows (shapes and golden results of SURVEY §5)."""

import json

from gaugework.plans.views import display_flags
from gaugework.plans.views import display_flags
from gaugework.sources.thresholds import bad_documents, min_thresholds, parse_payload, parse_thresholds


def series(parameter, qualifier, unit, display, thresholds):
    return {"Parameter": parameter, "qualifier": qualifier, "Unit": unit, "DisplayTimeSeries": display,
            "Thresholds": [{"ThresholdType": t, "Level": lv, "FloodWarningArea": a} for t, lv, a in thresholds]}


def station(rloi, wiski, name, ts):
    return [{"RLOIid": str(rloi), "wiskiID": str(wiski), "telemetryID": str(wiski), "Name": name,
             "TimeSeriesMetaData": ts}]


INFO = [("INFO RLOI PORMIN", -0.6, None), ("INFO RLOI PERCENT95", -0.5, None), ("INFO RLOI OTH", -0.2, None)]

SIMPLE = station(2116, 4040, "Stoke", [
    series("Level", "Downstream Stage", "mALD", False, INFO + [
        ("FW RES FAL", 1.3, "033WAF309"), ("FW ACTCON FW", 1.37, "033FWF3TRENT04"), ("FW RES FW", 1.77, "033FWF3TRENT04")]),
    series("Level", "Stage", "mALD", False, INFO + [("INFO RLOI PORMAX", 2.5, None)]),
])

FLOW_LEVELS = [("FW RES FAL", 1.7, "034WAF414"), ("INFO RLOI OTH", 1.7, None), ("FW RES FAL", 2.4, "034WAF415"),
               ("FW RES FAL", 2.6, "034WAF414"), ("FW RES FAL", 2.7, "034WAF415")] + \
    [("FW RES FW", lv, f"034FWFTR{c}") for lv, c in [(2.7, "CAVBRDG"), (2.8, "SWARKST"), (2.95, "BARROW"),
                                                     (2.95, "CASDONKM"), (2.95, "RPTING"), (3.1, "TRENTLK"),
                                                     (3.15, "THRMPTN"), (3.15, "TWYFORD"), (3.45, "SHARDLW"),
                                                     (3.45, "WLLNGTN")]] + \
    [("INFO RLOI PORMAX", 3.455, None), ("FW RES FW", 3.5, "034FWFTRNEWSAWLY"), ("FW RES FW", 3.5, "034FWFTRSAWLEY")]
FLOW = station(2100, 4007, "Shardlow", [
    series("Flow", "", "m3/s", True, [("FW RES FW", 650, "034FWFTRLOCKHEM"), ("FW RES FW", 729, "034FWFTRCASDONN")]),
    series("Level", "Stage", "mALD", True, FLOW_LEVELS),
])


def payload_df(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "json string")


def ordered(df):
    return [(r.fwis_code, r.fwis_type, r.direction, r.value) for r in df.orderBy("seq").collect()]


def test_simple_payload(spark):
    rows = ordered(parse_thresholds(payload_df(spark, SIMPLE)))
    assert rows == [("033WAF309", "A", "d", 1.3), ("033FWF3TRENT04", "W", "d", 1.37), ("033FWF3TRENT04", "W", "d", 1.77)]


def test_simple_minima(spark):
    r = min_thresholds(parse_thresholds(payload_df(spark, SIMPLE))).collect()[0]
    assert (r.downstream_alert, r.downstream_warning, r.upstream_alert, r.upstream_warning) == (1.3, 1.37, None, None)


def test_flow_payload_skips_flow_series(spark):
    rows = ordered(parse_thresholds(payload_df(spark, FLOW)))
    assert len(rows) == 16
    assert all(r[2] == "u" for r in rows)
    assert rows[0] == ("034WAF414", "A", "u", 1.7)
    assert rows[-1] == ("034FWFTRSAWLEY", "W", "u", 3.5)


def test_flow_minima(spark):
    r = min_thresholds(parse_thresholds(payload_df(spark, FLOW))).collect()[0]
    assert (r.downstream_alert, r.downstream_warning, r.upstream_alert, r.upstream_warning) == (None, None, 1.7, 2.7)


def test_missing_parameter_is_kept_and_null_area_rejected(spark):
    doc = station(1, 1, "x", [series(None, "Stage", "m", True, [("FW RES FW", 1.0, "123WAF1"), ("FW RES FW", 2.0, None)])])
    good, rejects = parse_thresholds(payload_df(spark, doc), with_rejects=True)
    assert [r.value for r in good.collect()] == [1.0]
    assert rejects.count() == 1  # kept aside; its sibling survives (§2.11 item 16)


def test_corrupt_payload_does_not_fail_the_batch(spark):
    df = spark.createDataFrame([("{not json",), (json.dumps(SIMPLE),)], "json string")
    assert parse_thresholds(df).count() == 3


def test_display_flags(spark):
    out = {(r.station_id, r.direction): r.display_time_series for r in display_flags(payload_df(spark, SIMPLE, FLOW)).collect()}
    assert out == {(2116, "d"): False, (2116, "u"): False, (2100, "u"): True}


def test_bad_documents_are_rejects_and_an_empty_array_is_valid(spark):
    df = spark.createDataFrame([("not json",), (None,), ("[]",)], "json string")
    assert sorted(r.json or "" for r in bad_documents(parse_payload(df)).collect()) == ["", "not json"]
    assert [r.json for r in parse_payload(df).filter("NOT _corrupt").collect()] == ["[]"]
    assert parse_thresholds(df).count() == 0


def test_documents_are_parsed_once(spark):
    df = spark.createDataFrame([('[{"RLOIid": "1", "TimeSeriesMetaData": []}]',)], "json string").repartition(2)
    for out in (parse_thresholds(df), min_thresholds(parse_thresholds(df)), bad_documents(parse_payload(df)), display_flags(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("from_json") == 1, plan


def test_several_series_and_thresholds(spark):
    payload = """[{"RLOIid": "7", "TimeSeriesMetaData": [
        {"Parameter": "Water Level", "qualifier": "Stage", "Thresholds": [
            {"ThresholdType": "FW ACT FAL", "Level": 2.5, "FloodWarningArea": "061WAF23"},
            {"ThresholdType": "PORMAX", "Level": 9, "FloodWarningArea": "061WAF23"},
            {"ThresholdType": "FW ACT FW", "Level": 3.5, "FloodWarningArea": "061FWF23"}]},
        {"Parameter": "Flow", "qualifier": "Stage", "Thresholds": [{"ThresholdType": "FW ACT FW", "Level": 1, "FloodWarningArea": "061FWF23"}]},
        {"qualifier": "Downstream Stage", "Thresholds": [{"ThresholdType": "FW RES FW", "Level": 4, "FloodWarningArea": "061FWF24"}]},
        {"Parameter": "Water Level", "qualifier": "downstream stage"}]},
        {"RLOIid": "8", "TimeSeriesMetaData": null}, {"RLOIid": "9"}]"""
    df = spark.createDataFrame([(payload,), ("[]",), (None,), ("{",)], "json string")
    rows = parse_thresholds(df).orderBy("seq").collect()
    assert [(r.station_id, r.fwis_code, r.fwis_type, r.direction, r.value) for r in rows] == [
        (7, "061WAF23", "A", "u", 2.5), (7, "061FWF23", "W", "u", 3.5), (7, "061FWF24", "W", "d", 4.0)]
    low = min_thresholds(parse_thresholds(df)).first()
    assert bad_documents(parse_payload(df)).count() == 2 and low.station_id == 7
