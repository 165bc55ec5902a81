"""Served views V1–V13 as compositions of gaugework operators.

Each takes DataFrames (already loaded tables) and returns a DataFrame; nothing is collected.
``plans.refresh`` materialises them in dependency order to versioned folders, so readers never see a
half-written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.functions import geo
from gaugework.functions.levels import active_flags
from gaugework.functions.predicates import (after_status_date, direction, in_scope, is_wales, recent,
                                            river_labels, water_level)
from gaugework.functions.timefmt import chart_label, epoch_millis, iso_minutes, with_chart_labels
from gaugework.operators.arrays import ordered_json, parallel_arrays, repeated
from gaugework.operators.ranking import latest_per_key, rank_neighbours, with_ordered_id
from gaugework.operators.sets import split_directions, union_shapes
from gaugework.operators.windows import flag_exists, trailing_totals
from gaugework.session import dealt

# ---------------------------------------------------------------------------------------------
# V1, V2: station context


def station_context(context: DataFrame, region_lookup: DataFrame) -> DataFrame:
    """V1: context ⋈ region lookup (fixed 9-row table, broadcast) + lon/lat centroid and
    GeoJSON coordinates from the national-grid coordinates."""
    lk = F.broadcast(region_lookup.select(F.col("region_name").alias("time_series_region"),
                                          F.col("context_region_name").alias("_ctx_region")))
    j = context.join(lk, context["region"] == lk["_ctx_region"]).drop("_ctx_region")
    j = geo.with_lonlat(j, "x_coord_actual", "y_coord_actual")
    return j.withColumn("coordinates", geo.geojson_point("lon", "lat"))


def station_split(context: DataFrame) -> DataFrame:
    """V2: every station as 'u', multi-gauge ('M') stations again as 'd' with the 'd_'
    measures, plus centroid columns."""
    s = split_directions(context)
    s = geo.with_lonlat(s, "x_coord_actual", "y_coord_actual")
    return s.withColumn("coordinates", geo.geojson_point("lon", "lat"))


# ---------------------------------------------------------------------------------------------
# V3: stations overview


def readings_with_headers(parents: DataFrame, values: DataFrame) -> DataFrame:
    """Header ⋈ values on the parent id (sort-merge on the id; both sides are large)."""
    return values.join(parents, "telemetry_value_parent_id")


def stations_overview(split: DataFrame, parents: DataFrame, values: DataFrame,
                      forecast_stations: DataFrame, as_of: str) -> DataFrame:
    """V3 on the reference's own table shapes (see ``plans.q_stations.stations_overview``
    for the same logic over test tables)."""
    from gaugework.plans.q_stations import stations_overview as core
    wl = readings_with_headers(parents.filter(water_level()), values)
    vals = wl.select("rloi_id", "qualifier", "telemetry_value_id", "value_timestamp", "processed_value",
                     "error", "parameter", "units", "value")
    lim = split.select("rloi_id", "qualifier", "station_type", "por_max_value", "percentile_5", "percentile_95")
    out = core(lim, vals, forecast_stations.select("rloi_id"), as_of)
    extra = split.select("rloi_id", F.col("qualifier").alias("direction"), "telemetry_id", "wiski_id",
                         "agency_name", "area", "catchment", "status")
    return out.join(extra, ["rloi_id", "direction"], "left")


# ---------------------------------------------------------------------------------------------
# V4: rainfall


def rainfall_stations(gauges: DataFrame, parents: DataFrame, values: DataFrame,
                      value_tiebreak: Sequence[str] = ("telemetry_value_id",), with_lonlat: bool = True) -> DataFrame:
    """V4: per rainfall gauge, the latest 'Rainfall' header (by end_timestamp, then id), its
    latest value (NaN → NULL; ties after the timestamp broken by ``value_tiebreak``) and
    24/6/1 h totals relative to the gauge's latest reading across all its Rainfall headers,
    plus lon/lat from easting/northing. Inner joins, as the reference: a gauge needs a
    Rainfall header with at least one value."""
    rp = parents.filter(F.col("parameter") == "Rainfall")  # case-sensitive, as the reference
    hdr = latest_per_key(rp.select("station", "region", "telemetry_value_parent_id", "data_type", "period",
                                   "units", "end_timestamp"),
                         ["station", "region"], "end_timestamp", "telemetry_value_parent_id")
    tb = list(value_tiebreak)
    last_val = latest_per_key(values.select("telemetry_value_parent_id", "value", "value_timestamp",
                                            *[c for c in tb if c != "value"]),
                              "telemetry_value_parent_id", "value_timestamp", tb)
    last_val = last_val.withColumn("value", F.when(~F.isnan("value"), F.col("value"))).select(
        "telemetry_value_parent_id", "value", "value_timestamp")
    rv = values.join(rp.select("telemetry_value_parent_id", "station", "region"), "telemetry_value_parent_id")
    tot = trailing_totals(rv, ["station", "region"], "value_timestamp", "value")
    g = geo.with_lonlat(gauges, "easting", "northing") if with_lonlat else gauges
    out = (g.join(hdr, (g.station_reference == hdr.station) & (g.region == hdr.region))
           .drop(hdr.region).drop("station", "end_timestamp")
           .join(last_val, "telemetry_value_parent_id")
           .join(tot.withColumnRenamed("station", "station_reference").drop("latest_ts"),
                 ["station_reference", "region"], "left")
           .withColumn("type", F.lit("R")))
    return out


# ---------------------------------------------------------------------------------------------
# V5, V6: rivers and the station list


def rivers(split: DataFrame, overview: DataFrame, river_stations: DataFrame, river: DataFrame,
           context: DataFrame, with_ids: bool = True) -> DataFrame:
    """V5: stations with river labels, position on the river and up/down neighbours, in
    scope only, ordered and numbered (W7 by the sort key, §2.11 item 19). ``with_ids=False``
    skips the numbering for consumers that renumber anyway (the station list)."""
    live = river_stations.join(context.select("rloi_id").distinct(), "rloi_id", "left_semi")
    ranked = rank_neighbours(live, "river_id", "rank", "rloi_id")
    rs = (ranked.join(river.select(F.col("id").alias("river_id"), F.col("name").alias("river_name"),
                                   F.col("qualified_name").alias("river_qualified_name")), "river_id")
          .select("rloi_id", "river_id", "river_name", "river_qualified_name", "calc_rank",
                  F.col("up_rloi_id").alias("up"), F.col("down_rloi_id").alias("down")))
    so = overview.select("rloi_id", "direction", F.col("processed_value").alias("value"), "trend",
                         "value_timestamp", F.col("error").alias("value_erred"), "percentile_5", "percentile_95")
    ss = split.select("rloi_id", "qualifier", "telemetry_id", "region", "catchment", "wiski_river_name",
                      "agency_name", "external_name", "station_type", "status", "lon", "lat")
    j = (ss.join(so, (ss.rloi_id == so.rloi_id) & (ss.qualifier == so.direction)).drop(so.rloi_id).drop("direction")
         .join(rs, "rloi_id", "left"))
    j = river_labels(j).filter(in_scope()).withColumn("iswales", is_wales())
    j = j.withColumnRenamed("calc_rank", "rank")
    if not with_ids:
        return j
    keys = ["view_rank", "river_id", "rank", "external_name"]
    order = [F.col(c).asc_nulls_last() for c in keys] + [F.col("qualifier").desc_nulls_first()]
    # then every other column, so the numbering is a total order (fan-out rows differ there)
    order += [F.col(c).asc_nulls_last() for c in sorted(set(j.columns) - set(keys) - {"qualifier"})]
    return with_ordered_id(j, order)


LIST_COLUMNS = ["river_id", "river_name", "river_qualified_name", "navigable", "view_rank", "rank", "rloi_id", "up",
                "down", "telemetry_id", "region", "catchment", "wiski_river_name", "agency_name", "external_name",
                "station_type", "status", "qualifier", "iswales", "value", "value_timestamp", "value_erred", "trend",
                "percentile_5", "percentile_95", "lon", "lat", "day_total", "six_hr_total", "one_hr_total"]


def stations_list(rivers_df: DataFrame, rainfall: DataFrame, order_mode: str = "positional") -> DataFrame:
    """V6: rivers ∪ rainfall gauges outside 'Wales' (case-sensitive), SQL UNION (distinct).

    Rainfall rows: river_id 'rainfall-<region>', river_name 'Rainfall <region>', view_rank 5,
    type 'R', status 'Active', trend 'n/a', not navigable, not Welsh, value_erred false,
    telemetry_id = station reference, agency and external name = station name, with the
    three rainfall totals (NULL on river rows). Ids follow the sort: ``'positional'``
    reproduces the released ORDER BY 4,1,5,13 (navigable, river_id, view_rank,
    wiski_river_name; §2 O2), ``'intended'`` sorts by view_rank, river_id, rank,
    agency_name; the remaining columns break ties so the numbering is total."""
    rdt = dict(rivers_df.dtypes)
    rv = rivers_df.select(*[F.col(c) if c in rdt else F.lit(None).cast("double").alias(c) for c in LIST_COLUMNS])
    typ = dict(rv.dtypes)

    def null(c: str):
        return F.lit(None).cast(typ[c]).alias(c)
    rf = rainfall.filter(F.col("region") != "Wales")
    rf = rf.select(
        F.concat(F.lit("rainfall-"), F.col("region")).alias("river_id"),
        F.concat(F.lit("Rainfall "), F.col("region")).alias("river_name"), null("river_qualified_name"),
        F.lit(False).alias("navigable"), F.lit(5).cast(typ["view_rank"]).alias("view_rank"), null("rank"),
        null("rloi_id"), null("up"), null("down"),
        F.col("station_reference").cast(typ["telemetry_id"]).alias("telemetry_id"), "region", null("catchment"),
        null("wiski_river_name"), F.col("station_name").alias("agency_name"), F.col("station_name").alias("external_name"),
        F.lit("R").alias("station_type"), F.lit("Active").alias("status"), null("qualifier"),
        F.lit(False).alias("iswales"), F.col("value").cast(typ["value"]).alias("value"),
        F.col("value_timestamp").cast(typ["value_timestamp"]).alias("value_timestamp"),
        F.lit(False).alias("value_erred"), F.lit("n/a").alias("trend"), null("percentile_5"), null("percentile_95"),
        *[(F.col(c).cast(typ[c]) if c in rainfall.columns else null(c)).alias(c) for c in ("lon", "lat")],
        *[F.col(c).cast(typ[c]).alias(c) for c in ("day_total", "six_hr_total", "one_hr_total")])
    u = rv.unionByName(rf).distinct()
    keys = (["navigable", "river_id", "view_rank", "wiski_river_name"] if order_mode == "positional"
            else ["view_rank", "river_id", "rank", "agency_name"])
    order = [F.col(c).asc_nulls_last() for c in [*keys, *sorted(set(LIST_COLUMNS) - set(keys))]]
    return with_ordered_id(u, order)


# ---------------------------------------------------------------------------------------------
# V7: impacts


def impacts(impact: DataFrame, context: DataFrame, overview: DataFrame, ffoi_max: DataFrame,
            ffoi_station: DataFrame, order: Sequence[str] = ("value_timestamp",),
            tiebreak: Sequence[str] = ("qualifier",)) -> DataFrame:
    """V7: impacts of active stations (status exactly 'Active') with the gauge name, the
    station's latest upstream reading and forecast maximum, and the two active flags.

    The reference's ``DISTINCT ON (rloi_id)`` has no ORDER BY (arbitrary row, §2.11 item 4);
    here the upstream row with the latest timestamp is taken, then the tiebreak columns."""
    so = overview.filter(F.col("direction") == "u")
    so = latest_per_key(so, "rloi_id", list(order), [c for c in tiebreak if c in so.columns])
    so = so.select(F.col("rloi_id").alias("_rid"), F.col("processed_value").alias("telemetrylatest"),
                   "telemetry_id")
    fm = ffoi_max.select(F.col("telemetry_id").alias("_tid"), F.col("value").alias("forecastmax"))
    ctx = context.filter(F.col("status") == "Active").select(
        F.col("rloi_id").alias("_cid"),
        F.concat(F.col("wiski_river_name"), F.lit(" at "), F.col("agency_name")).alias("gauge"))
    # all that belongs to a gauge is joined by gauge; the impacts come last and are dealt once. Joined by telemetry_id,
    # every impact of a gauge without readings would go to the one task of its null keys
    so = so.join(fm, so.telemetry_id == fm._tid, "left")
    gauges = ctx.join(so, ctx._cid == so._rid, "left")
    gauges = flag_exists(gauges, ffoi_station.select(F.col("rloi_id").alias("_cid")), ["_cid"], "_fs")
    j = impact.join(gauges, impact.rloi_id == gauges._cid)
    tel, fc = active_flags("telemetrylatest", "value", "forecastmax", "_fs")
    served = [F.col(c).alias(IMPACT_NAMES.get(c, c)) for c in impact.columns if c not in ("id", "rloi_id")]
    if "geom" in impact.columns:
        served.append(geo.geojson_point(F.col("geom.lon"), F.col("geom.lat")).alias("coordinates"))
    return j.select(F.col("id").alias("impactid"), "gauge", F.col("rloi_id").alias("rloiid"), *served,
                    "telemetrylatest", tel.alias("telemetryactive"), "forecastmax", fc.alias("forecastactive"))


#: The names under which the impacts view serves its table's columns.
IMPACT_NAMES = {"short_name": "shortname", "obs_flood_year": "obsfloodyear", "obs_flood_month": "obsfloodmonth"}


# ---------------------------------------------------------------------------------------------
# V8: current warnings with their area


def warnings_with_area(fwis: DataFrame, alert_areas: DataFrame, warning_areas: DataFrame, with_centroid: bool = True,
                       rings: str = "geom", code: str = "ta_code", carry: Sequence[str] = ()) -> DataFrame:
    """V8: warnings ⋈ alert areas ∪ warnings ⋈ warning areas on the blank-trimmed code (bpchar equality), distinct, with
    the area's ``gid`` (its key), type and ``carry`` columns, and on request its geometry and centroid.

    Codes and keys are matched and made distinct first; geometries, with a centroid computed once an
    area, come in by the key at the end, so no polygon is compared or copied before."""
    both = [(alert_areas, "a"), (warning_areas, "w")]
    keys = [x.select("gid", F.rtrim("fws_tacode").alias("_code"), *carry, F.lit(kind).alias("area_type")) for x, kind in both]
    found = fwis.join(keys[0].unionByName(keys[1]), F.rtrim(fwis[code]) == F.col("_code")).drop("_code").distinct()
    if not with_centroid:
        return found
    from gaugework.operators.spatial import centroid
    shapes = [x.select("gid", rings, F.lit(kind).alias("area_type")) for x, kind in both]
    return found.join(centroid(shapes[0].unionByName(shapes[1]), rings, "st_centroid"), ["gid", "area_type"])


#: The names under which the older warnings view serves the feed's columns.
LEGACY_NAMES = {"tidal": "flood_type", "severity": "severity_description", "severity_value": "severity", "time_raised": "raised",
                "rim_changed": "message_changed", "rim": "message"}


def legacy_warnings(current_fwis: DataFrame, alert_areas: DataFrame, warning_areas: DataFrame, rings: str = "geom") -> DataFrame:
    """The older warnings view: the same match on ``fwa_code``; the feed's columns under their served names, the area's
    dial number (``area_floodline_quickdial_id``), and its geometry and centroid if the area tables have one."""
    shaped = rings in alert_areas.columns
    dial = ["qdial"] if "qdial" in alert_areas.columns else []
    out = warnings_with_area(current_fwis, alert_areas, warning_areas, shaped, rings, "fwa_code", dial)
    served = [F.col(c).alias(LEGACY_NAMES.get(c, c)) for c in current_fwis.columns]
    served += [F.col("qdial").alias("area_floodline_quickdial_id")] if dial else []
    return out.select(*served, "gid", "area_type", *([rings, "st_centroid"] if shaped else []))


# ---------------------------------------------------------------------------------------------
# Readings reads


def station_readings(split: DataFrame, parents: DataFrame, values: DataFrame, as_of: str,
                     days: int = 5, ts_format: str = "iso") -> DataFrame:
    """V9 set-based: one JSON array per (rloi_id, direction) of {ts, _, err} newest first,
    for water-level readings whose header started within ``days`` of ``as_of`` and that are
    not older than the station's status date. ``ts_format``: 'iso' (ISO minutes, final),
    'epoch' (ms, 1.1.0), 'label' (adds the chart label, v2)."""
    hdr = parents.filter(water_level() & recent("start_timestamp", as_of, days))
    if "start_date" in parents.columns:  # date-partitioned headers: prune whole partitions
        hdr = hdr.filter(F.col("start_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    hdr = hdr.withColumn("direction", direction("qualifier"))
    s = split.select("rloi_id", F.col("qualifier").alias("direction"), "status_date")
    j = (values.join(hdr.select("telemetry_value_parent_id", "rloi_id", "direction"), "telemetry_value_parent_id")
         .join(s, ["rloi_id", "direction"])
         .filter(after_status_date("value_timestamp", "status_date")))
    ts = {"iso": iso_minutes("value_timestamp"), "epoch": epoch_millis("value_timestamp")}.get(ts_format)
    fields = [(ts if ts is not None else iso_minutes("value_timestamp")).alias("ts"),
              F.col("processed_value").alias("_"), F.col("error").alias("err")]
    if ts_format == "label":
        fields.append(chart_label("value_timestamp").alias("label"))
    return ordered_json(j, ["rloi_id", "direction"], ["value_timestamp", "telemetry_value_id"], fields)


def station_readings_with_context(context: DataFrame, parents: DataFrame, values: DataFrame,
                                  prefer: str = "u", as_of: str | None = None, days: int | None = None) -> DataFrame:
    """V10 set-based: one row per station (left join from the context, so stations without
    data keep a row with NULL arrays) for the preferred direction.

    Readings are water level, not older than the status date. Downstream series are only
    shown for multi-gauge ('M') stations, and upstream series of an 'M' station only when
    'u' is preferred. Per (station, qualifier) the readings become parallel arrays ordered by
    time: processed values, timestamps, chart labels (Europe/London; first and last forced to
    the full form), por_max and percentile_5 of the direction (rounded to 2 dp) and error
    flags. The reference then returns the first row by direction (LIMIT 1, arbitrary among
    equal directions); here the preferred direction wins, then the lowest qualifier.

    The reference reads whatever the retention job (L20) left in the table; pass ``as_of`` and
    ``days`` to bound each station's arrays explicitly (readings newer than as_of − days)."""
    ctx = context.select("rloi_id", "station_type", "status_date", "por_max_value", "d_por_max_value",
                         "percentile_5", "d_percentile_5")
    hdr = parents.filter(F.lower(F.col("parameter")) == "water level").select(
        "telemetry_value_parent_id", "rloi_id", "qualifier")
    down = F.instr(F.lower(F.col("qualifier")), "downstream") > 0
    is_m = F.lower(F.col("station_type")) == "m"
    keep = (~down & (F.lit(prefer == "u") | ~is_m)) | (down & is_m)
    if as_of is not None and days is not None:
        values = values.filter(recent("value_timestamp", as_of, days))
    j = (values.join(hdr, "telemetry_value_parent_id").join(ctx, "rloi_id")
         .filter(keep & after_status_date("value_timestamp", "status_date"))
         .withColumn("por_max_value", F.round(F.when(down, F.col("d_por_max_value")).otherwise(F.col("por_max_value")), 2))
         .withColumn("percentile_5", F.round(F.when(down, F.col("d_percentile_5")).otherwise(F.col("percentile_5")), 2))
         .withColumn("direction", F.when(down & is_m, "d").otherwise("u")))
    j = with_chart_labels(j, ["rloi_id", "qualifier"], "value_timestamp")
    arrs = parallel_arrays(j, ["rloi_id", "qualifier", "direction"], ["value_timestamp", "telemetry_value_id"],
                           ["processed_value", "value_timestamp", "label", "por_max_value", "percentile_5", "error"])
    pref = F.when(F.col("direction") == prefer, 0).otherwise(1)
    rest = [c for c in arrs.columns if c != "rloi_id"]
    picked = arrs.groupBy("rloi_id").agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(pref, F.col("qualifier"))).alias("_p"))
    picked = picked.select("rloi_id", *[F.col("_p")[c].alias(c) for c in rest])
    return context.join(picked, "rloi_id", "left")


# ---------------------------------------------------------------------------------------------
# Forecast thresholds


def threshold_rows(thresholds: DataFrame, alert_areas: DataFrame, warning_areas: DataFrame,
                   fwis: DataFrame) -> DataFrame:
    """Thresholds ⟕ alert area ⟕ warning area ⟕ current warning on the exact code;
    area name coalesced, type 'a'/'w'/'', severity default −1.

    Warnings of equal code and severity give equal rows: they are joined as one with their number, and the
    joined row is repeated as often. Thresholds are dealt over all tasks first: each becomes as many rows as its code
    has warnings, and a file's row groups must not decide which task makes them."""
    thresholds = dealt(thresholds)
    a = alert_areas.select(F.col("fws_tacode").alias("_a_code"), F.col("gid").alias("_a_gid"),
                           F.col("ta_name").alias("_a_name"))
    w = warning_areas.select(F.col("fws_tacode").alias("_w_code"), F.col("gid").alias("_w_gid"),
                             F.col("ta_name").alias("_w_name"))
    f = fwis.groupBy(F.col("ta_code").alias("_f_code"), F.col("severity_value").alias("_sev")).agg(F.count("*").alias("_n"))
    j = (thresholds.join(a, thresholds.fwis_code == a._a_code, "left")
         .join(w, thresholds.fwis_code == w._w_code, "left")
         .join(f, thresholds.fwis_code == f._f_code, "left"))
    j = j.select(*thresholds.columns,
                 F.coalesce("_a_name", "_w_name").alias("fwa_name"),
                 F.when(F.col("_a_gid").isNotNull(), "a").when(F.col("_w_gid").isNotNull(), "w")
                  .otherwise("").alias("fwa_type"),
                 F.coalesce(F.col("_sev"), F.lit(-1)).alias("fwa_severity"), "_n")
    return repeated(j, F.coalesce("_n", F.lit(1))).drop("_n")


def forecast_thresholds(ffoi_station: DataFrame, station_thresholds: DataFrame, alert_areas: DataFrame,
                        warning_areas: DataFrame, fwis: DataFrame) -> DataFrame:
    """V11 set-based: one JSON array per station, ordered by type, value, name."""
    t = ffoi_station.join(station_thresholds, "ffoi_station_id")
    rows = threshold_rows(t, alert_areas, warning_areas, fwis)
    fields = [c for c in station_thresholds.columns] + ["fwa_name", "fwa_type", "fwa_severity"]
    return ordered_json(rows, ["rloi_id"], ["fwa_type", "value", "fwa_name"], fields, descending=False)


# ---------------------------------------------------------------------------------------------
# Station to area within 8 km


def station_areas(context: DataFrame, alert_areas: DataFrame, warning_areas: DataFrame,
                  metres: float = 8000.0, rings: str = "geom") -> DataFrame:
    """V12 full build: (rloi_id, fws_tacode) for every station within ``metres`` of an alert
    or warning area. The reference runs the two area types as two INSERTs (UNION ALL); here
    both area sets go through one distance join, so the station coordinates are converted
    and bucketed once."""
    from gaugework.operators.proximity import within_distance
    pts = geo.with_lonlat(context, "x_coord_actual", "y_coord_actual").select("rloi_id", "lon", "lat")
    areas = (alert_areas.select(F.col("fws_tacode"), rings, F.lit("a").alias("_kind"))
             .unionByName(warning_areas.select(F.col("fws_tacode"), rings, F.lit("w").alias("_kind")))
             .select(F.struct("fws_tacode", "_kind").alias("area_id"), rings))
    j = within_distance(pts, areas, metres, point_id="rloi_id", area_id="area_id", rings=rings)
    return j.select("rloi_id", F.col("area_id.fws_tacode").alias("fws_tacode"))


def station_areas_missing(context: DataFrame, done: DataFrame, alert_areas: DataFrame,
                          warning_areas: DataFrame, metres: float = 8000.0, rings: str = "geom") -> DataFrame:
    """V12 incremental (J11): only stations absent from ``done`` and not in Wales; union
    distinct of both branches."""
    todo = context.join(done.select("rloi_id").distinct(), "rloi_id", "left_anti").filter(
        F.coalesce(F.lower(F.col("region")) != "wales", F.lit(True)))
    return station_areas(todo, alert_areas, warning_areas, metres, rings).distinct()


# ---------------------------------------------------------------------------------------------
# Thresholds and display flags from the threshold payload


def threshold_set(payload: DataFrame) -> DataFrame:
    """Flat threshold rows per station."""
    from gaugework.sources.thresholds import parse_thresholds
    return parse_thresholds(payload)


def display_flags(payload: DataFrame) -> DataFrame:
    """V13 (inferred): one display flag per (station, direction) from DisplayTimeSeries;
    a station/direction is displayed when any of its series says so."""
    from gaugework.sources.thresholds import explode_series
    s = explode_series(payload)
    return s.groupBy("station_id", "direction").agg(
        F.bool_or(F.coalesce(F.col("display_time_series"), F.lit(False))).alias("display_time_series"))
