"""Reading classifications: trend (W4), risk (F9), level (F10), age (F11), active flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugework.functions.numeric import col_, is_nan, round_exact


def trend(current: str | Column, previous: str | Column, dp: int = 2,
          previous_is_nan: str | Column | None = None) -> Column:
    """'rising' / 'falling' / 'steady' from round(current, dp) vs round(previous, dp).

    Either side NULL → 'steady'. NaN follows NUMERIC ordering: NaN equals NaN and is greater
    than every number, so a NaN latest reading is 'rising' against a number and a number is
    'falling' against a NaN mean. ``previous`` may be a DOUBLE (NaN allowed) or a DECIMAL,
    in which case its NaN-ness is passed separately.
    """
    cur = col_(current)
    prev = col_(previous)
    cur_nan = is_nan(cur)
    prev_nan = col_(previous_is_nan) if previous_is_nan is not None else is_nan(prev)
    cur_r = round_exact(cur, dp)
    prev_r = F.round(prev.cast("decimal(28,10)"), dp) if previous_is_nan is not None \
        else round_exact(prev, dp)
    return (
        F.when(cur.isNull() | prev.isNull() & ~F.coalesce(prev_nan, F.lit(False)), "steady")
        .when(cur_nan & prev_nan, "steady")
        .when(cur_nan, "rising")
        .when(prev_nan, "falling")
        .when(cur_r > prev_r, "rising")
        .when(cur_r < prev_r, "falling")
        .otherwise("steady")
    )


def at_risk(processed: str | Column, error: str | Column, percentile_5: str | Column) -> Column:
    """True when not error, neither NULL nor NaN, and processed ≥ percentile_5; never NULL."""
    p = col_(processed)
    cond = p.isNotNull() & ~col_(error) & ~F.isnan(p) & (p >= col_(percentile_5))
    return F.when(cond, True).otherwise(False)


def level(processed: str | Column, percentile_5: str | Column, percentile_95: str | Column,
          station_type: str | Column) -> Column:
    """coastal '' ; below p95 'low' ; at/above p5 'high' ; else 'normal' (NaN → 'high')."""
    p = col_(processed)
    return (
        F.when(col_(station_type) == "C", "")
        .when(p < col_(percentile_95), "low")
        .when(p >= col_(percentile_5), "high")
        .otherwise("normal")
    )


def age_seconds(ts: str | Column, as_of: str | Column) -> Column:
    """F11 as seconds (as_of − ts, DOUBLE with microsecond precision); intervals do not
    compare cleanly across engines."""
    a = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of.cast("timestamp")
    t = col_(ts).cast("timestamp")
    return (F.unix_micros(a) - F.unix_micros(t)).cast("double") / 1_000_000


def age(ts: str | Column, as_of: str | Column) -> Column:
    """F11 as a DAY TO SECOND interval."""
    a = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return a - col_(ts).cast("timestamp")


def active_flags(processed: str | Column, impact_value: str | Column, forecast_max: str | Column,
                 is_forecast_station: str | Column) -> tuple[Column, Column]:
    """(telemetry_active, forecast_active), three-valued like the reference."""
    tel = col_(processed) >= col_(impact_value)
    fc = (col_(forecast_max) >= col_(impact_value)) & col_(is_forecast_station)
    return tel, fc
