"""L1–L5 reading ingest, L7 forecasts, L8 warnings, L10/L12 delimited loads (FIXTURES §4–§7)."""

import json
import os

from pyspark.sql import functions as F

from gaugework.sources.delimited import clean_impacts, load_delimited, with_point
from gaugework.sources.forecasts import forecast_max, ingest_forecasts, ingest_warnings, read_xml_files
from gaugework.sources.readings import ingest_and_clean, read_reading_files


def reading_doc(station, region, sets):
    return {"EATimeSeriesDataExchangeFormat": {"Station": [{
        "$": {"stationReference": station, "region": region},
        "SetofValues": [{"$": {"startDate": "2023-02-06", "startTime": "10:00:00", "endDate": "2023-02-06",
                               "endTime": "12:00:00", "parameter": "Water Level", "qualifier": q, "units": "mAOD"},
                         "Value": [{"_": v, "$": {"date": d, "time": t}} for v, d, t in vals]}
                        for q, vals in sets]}]}}


def context(spark):
    return spark.createDataFrame(
        [("T1", "North East", 1, "S", True, 0.5, 3.0, 3.5, 2.0, 2.5),
         ("T2", "North East", 2, "C", False, None, 3.0, None, 2.0, None),
         ("T3", "North East", 3, "M", False, None, 3.0, 4.0, 2.0, 2.2)],
        "telemetry_id string, region string, rloi_id int, station_type string, post_process boolean, "
        "subtract double, por_max_value double, d_por_max_value double, percentile_5 double, d_percentile_5 double")


def lookup(spark):
    return spark.createDataFrame([(1, "EA North East", "North East")], "id int, region_name string, context_region_name string")


def test_reading_files_end_to_end(spark, tmp_dir):
    docs = {
        "f1.json": reading_doc("T1", "EA North East", [("Stage", [('"1.2"', "2023-02-06", "11:00:00"),
                                                                  ("0.1", "2023-02-06", "11:15:00"),
                                                                  ("abc", "2023-02-06", "11:30:00"),
                                                                  ("1.0", "2023-02-31", "11:45:00")])]),
        "f2.json": reading_doc("T2", "EA North East", [("Tidal", [("-0.4", "2023-02-06", "11:00:00")])]),
        "f3.json": reading_doc("T9", "EA North East", [("Stage", [("1.0", "2023-02-06", "11:00:00")])]),
        "f4.json": reading_doc("T3", "EA North East", [("Downstream Stage", [("2.5", "2023-02-06", "11:00:00")])]),
    }
    lone = reading_doc("T1", "EA North East", [("Stage", [("1.0", "2023-02-06", "11:00:00")])])
    lone["EATimeSeriesDataExchangeFormat"]["Station"] = lone["EATimeSeriesDataExchangeFormat"]["Station"][0]
    docs["f5.json"] = lone  # a lone Station object instead of an array
    for name, d in docs.items():
        with open(os.path.join(tmp_dir, name), "w") as fh:
            json.dump(d, fh)
    with open(os.path.join(tmp_dir, "f6.json"), "w") as fh:
        fh.write("{not json")
    raw = read_reading_files(spark, tmp_dir)
    out = ingest_and_clean(raw, context(spark), lookup(spark))
    parents = {r.filename: r for r in out["parents"].collect()}
    assert set(parents) == {"f1.json", "f2.json", "f4.json"}  # unknown station T9 dropped
    assert parents["f4.json"].por_max_value == 4.0 and parents["f4.json"].percentile_5 == 2.2  # 'd_' columns
    assert str(parents["f1.json"].start_timestamp) == "2023-02-06 10:00:00"
    vals = sorted((r.value, r.processed_value, r.error) for r in out["values"].collect())
    # subtract 0.5 applied on T1: 1.2 → 0.7 ; 0.1 → −0.4 → NULL + error ; coastal −0.4 kept, no error
    assert vals == sorted([(1.2, 0.7, False), (0.1, None, True), (-0.4, -0.4, False), (2.5, 2.5, False)])
    rejects = sorted(r.reject_reason for r in out["rejects"].collect())
    assert rejects == ["bad_timestamp", "bad_value"]
    assert sorted(r.filename for r in out["file_rejects"].collect()) == ["f5.json", "f6.json"]


FORECAST = """<EATimeSeriesDataExchangeFormat xmlns="urn:ts" xmlns:md="urn:md"><md:Date>2023-02-06</md:Date><md:Time>09:00:00</md:Time>
<Station stationReference="W1" stationName="One"><SetofValues parameter="Water Level" qualifier="Stage" units="m"
 startDate="2023-02-06" startTime="09:00:00" endDate="2023-02-07" endTime="09:00:00"><Value date="2023-02-06" time="10:00:00">1.5</Value>
 <Value date="2023-02-06" time="11:00:00">1.9</Value><Value date="2023-02-06" time="12:00:00">1.9</Value></SetofValues>
 <SetofValues parameter="Flow" qualifier="x" units="m3/s"><Value date="2023-02-06" time="10:00:00">99</Value></SetofValues></Station>
<Station stationReference="W2" stationName="Two"><SetofValues parameter="Flow" qualifier="Stage" units="m"/></Station>
<Station stationReference="W9" stationName="Nine"><SetofValues parameter="Water Level" qualifier="Stage" units="m"/></Station>
</EATimeSeriesDataExchangeFormat>"""


def test_forecast_ingest_first_set_wins(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "ffoi-1.xml"), "w") as fh:
        fh.write(FORECAST)
    with open(os.path.join(tmp_dir, "ffoi-2.xml"), "w") as fh:
        fh.write("<broken")
    ctx = spark.createDataFrame([("W1", 11), ("W2", 12)], "wiski_id string, rloi_id int")
    fc = ingest_forecasts(read_xml_files(spark, tmp_dir), ctx)
    rows = fc.collect()
    assert [(r.station_reference, r.rloi_id, r.parameter) for r in rows] == [("W1", 11, "Water Level")]
    assert str(rows[0].forecast_date) == "2023-02-06 09:00:00"
    mx = forecast_max(fc).first()
    assert mx.value == 1.9 and str(mx.value_date) == "2023-02-06 11:00:00"


WARN = """<warningreport xmlns="urn:fwis"><warning fwacode="011FWFNC6K" fwakey="1" severity="Flood Warning" severityvalue="2"
 timeraised="06 02 2023 13 45" severity_changed="06 02 2023 13 45" rim_changed="06 02 2023 13 50" tidal="0"><rim_english>River high</rim_english></warning>
 <warning fwacode="011WAFDW" severityvalue="1" timeraised="06 02 2023 12 00"><rim_english>Alert</rim_english></warning></warningreport>"""


def test_warning_snapshot_rules(spark, tmp_dir):
    old = spark.createDataFrame([("OLD",)], "fwa_code string")
    one = spark.createDataFrame([("fwis-1675691100.xml", WARN)], "filename string, xml string")
    w, audit = ingest_warnings(one, old)
    assert sorted(r.fwa_code for r in w.collect()) == ["011FWFNC6K", "011WAFDW"]
    assert audit.first().load_timestamp == 1675691100
    r = w.filter("fwa_code = '011FWFNC6K'").first()
    assert str(r.time_raised) == "2023-02-06 13:45:00" and r.severity_value == 2 and r.rim == "River high"
    two = spark.createDataFrame([("fwis-1.xml", WARN), ("fwis-2.xml", WARN)], "filename string, xml string")
    assert [r.fwa_code for r in ingest_warnings(two, old)[0].collect()] == ["OLD"]   # two files: skip
    wrong = spark.createDataFrame([("warn-1.xml", WARN)], "filename string, xml string")
    assert [r.fwa_code for r in ingest_warnings(wrong, old)[0].collect()] == ["OLD"]  # wrong prefix: skip


def test_delimited_impacts(spark, tmp_dir):
    path = os.path.join(tmp_dir, "impacts.csv")
    with open(path, "w", newline="") as fh:
        fh.write('id|rloi_id|value|lonlat|comment\r\n1|1001|2.5|"-1.5, 52.25"|"line one\nline two"\r\n2|x|1|"0, 0"|bad\r\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("rloi_id", T.IntegerType()),
                           T.StructField("value", T.DoubleType()), T.StructField("lonlat", T.StringType()),
                           T.StructField("comment", T.StringType())])
    good, bad = load_delimited(spark, path, schema, sep="|", multiline=True)
    rows = with_point(clean_impacts(good)).collect()
    assert len(rows) == 1 and bad.count() == 1
    assert rows[0].comment == "line one line two" and rows[0].geom.lon == -1.5 and rows[0].lat == 52.25
    assert "id" not in rows[0].asDict()


def test_forecast_max_takes_file_and_time_from_one_row(spark):
    from gaugework.sources.forecasts import forecast_max
    rows = [(1, "late.xml", [("2023-02-06 12:00:00", 2.0)]), (1, "early.xml", [("2023-02-06 09:00:00", 2.0)]),
            (1, "low.xml", [("2023-02-06 08:00:00", 1.0)])]
    df = spark.createDataFrame(rows, "rloi_id int, filename string, values array<struct<ts: string, value: double>>")
    r = forecast_max(df).collect()
    assert [(x.value, x.value_date, x.filename) for x in r] == [(2.0, "2023-02-06 09:00:00", "early.xml")]
