"""Sunrise and sunset as native Column arithmetic.

The published "sunrise equation" (mean anomaly, equation of centre,
ecliptic longitude, solar transit, declination, hour angle with the
standard -0.833 degree refraction/disc correction). Everything is a built-in
trig expression, so it runs inside whole-stage codegen; no Python per row.
Accuracy is about a minute, like the common astronomy libraries.

Polar day or night (hour-angle cosine outside [-1, 1]) gives NULL.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, functions as F

# Constants of the published sunrise equation.
J2000 = 2451545.0            # Julian date of 2000-01-01 12:00 UT
UNIX_EPOCH_JD = 2440587.5    # Julian date of 1970-01-01 00:00 UT
MEAN_ANOMALY_0 = 357.5291
MEAN_ANOMALY_RATE = 0.98560028
CENTRE_1, CENTRE_2, CENTRE_3 = 1.9148, 0.0200, 0.0003
PERIHELION = 102.9372
TRANSIT_M, TRANSIT_L = 0.0053, 0.0069
OBLIQUITY = 23.4397
HORIZON = -0.833


def _sin_deg(x: Column) -> Column:
    return F.sin(F.radians(x))


def _ntz_from_unix_seconds(secs: Column) -> Column:
    """UTC wall clock of a unix second count, independent of session zone."""
    return F.timestamp_add("SECOND", secs, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def solar_event_unix(date: Column, lat: Column, lon: Column) -> tuple[Column, Column]:
    """(sunrise, sunset) of a local calendar date as unix seconds (double)."""
    n = F.datediff(date, F.lit(_dt.date(2000, 1, 1))).cast("double")
    jstar = n - lon / F.lit(360.0)
    m = F.lit(MEAN_ANOMALY_0) + F.lit(MEAN_ANOMALY_RATE) * jstar
    c = (F.lit(CENTRE_1) * _sin_deg(m) + F.lit(CENTRE_2) * _sin_deg(m * 2)
         + F.lit(CENTRE_3) * _sin_deg(m * 3))
    lam = m + c + F.lit(180.0 + PERIHELION)
    transit = (F.lit(J2000) + jstar + F.lit(TRANSIT_M) * _sin_deg(m)
               - F.lit(TRANSIT_L) * _sin_deg(lam * 2))
    sin_d = _sin_deg(lam) * F.lit(math.sin(math.radians(OBLIQUITY)))
    cos_d = F.cos(F.asin(sin_d))
    cos_w = (F.lit(math.sin(math.radians(HORIZON)))
             - _sin_deg(lat) * sin_d) / (F.cos(F.radians(lat)) * cos_d)
    w = F.when(F.abs(cos_w) <= 1.0, F.degrees(F.acos(cos_w)))
    rise = (transit - w / F.lit(360.0) - F.lit(UNIX_EPOCH_JD)) * F.lit(86400.0)
    sset = (transit + w / F.lit(360.0) - F.lit(UNIX_EPOCH_JD)) * F.lit(86400.0)
    return rise, sset


def sun_columns(date: Column, lat: Column, lon: Column, tz: Column) -> dict[str, Column]:
    """Local sunrise/sunset (NTZ, second precision) and day length."""
    rise, sset = solar_event_unix(date, lat, lon)
    rise_s = F.floor(rise)
    set_s = F.floor(sset)
    utc = F.lit("UTC")
    length = (set_s - rise_s).cast("long")
    return {
        "sunrise": F.convert_timezone(utc, tz, _ntz_from_unix_seconds(rise_s)),
        "sunset": F.convert_timezone(utc, tz, _ntz_from_unix_seconds(set_s)),
        "day_length_s": length,
        "day_hours": (length / 3600).cast("int"),
        "day_minutes": ((length % 3600) / 60).cast("int"),
        "day_seconds": (length % 60).cast("int"),
    }
