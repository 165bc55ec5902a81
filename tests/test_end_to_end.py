"""Reading files → ingest (L1–L5) → split (V2) → overview (V3), as in the README usage."""

import json
import os

from fixtures import CONTEXT_SCHEMA, context_rows
from gaugework.plans import views
from gaugework.sources.readings import ingest_and_clean, read_reading_files
from test_ingest import reading_doc


def test_files_to_overview(spark, tmp_dir):
    doc = reading_doc("T1", "EA North East", [("Stage", [("1.2", "2023-02-06", "11:00:00"),
                                                         ("1.3", "2023-02-06", "11:15:00")])])
    with open(os.path.join(tmp_dir, "a.json"), "w") as fh:
        json.dump(doc, fh)
    ctx = spark.createDataFrame(context_rows(), CONTEXT_SCHEMA)
    lkp = spark.createDataFrame([(1, "EA North East", "North East")], "id int, region_name string, context_region_name string")
    loaded = ingest_and_clean(read_reading_files(spark, os.path.join(tmp_dir, "*.json")), ctx, lkp)
    fs = spark.createDataFrame([(1,)], "rloi_id int")
    ov = views.stations_overview(views.station_split(ctx), loaded["parents"], loaded["values"], fs,
                                 as_of="2023-02-06 14:00:00")
    r = ov.filter("rloi_id = 1").first()
    assert (r.direction, r.processed_value, r.trend, r.forecast, r.level, r.age_seconds) == (
        "u", 1.3, "rising", True, "normal", 9900.0)
    assert r.value == 1.3 and r.parameter and "units" in ov.columns  # the latest reading's own columns
    assert ov.filter("rloi_id = 2").first().trend is None  # no readings: kept, trend NULL
    impact = spark.createDataFrame([(9, 1, 1.25)], "id long, rloi_id int, value double")
    fm = spark.createDataFrame([(r.telemetry_id, 1.0)], "telemetry_id string, value double")
    active = views.impacts(impact, ctx, ov, fm, fs).collect()  # V7 over the rows V3 gives
    assert [(a.impactid, a.rloiid, a.telemetrylatest, a.telemetryactive, a.forecastactive) for a in active] == [
        (9, 1, 1.3, True, False)]
