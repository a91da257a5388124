"""Observations to one row per station and day.

All measures of a day, including the daylight-only solar mean, come out of a
single ``groupBy(station, date)``. Sunrise and sunset are a dimension, computed
once per station and day (`sun_times`) and joined by both, so no observation is
put through the sun equation; the daylight filter is a conditional aggregate.
For a few days the dimension is small and the engine broadcasts it; for long
spans the join deals the observations by (station, date), which the aggregation
then uses too.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions.rounding import exact_mean_col
from ..functions.sun import sun_columns
from .common import check_date_range


def observed_days(obs: DataFrame) -> tuple[_dt.date, _dt.date]:
    """First and last day of the observations (one row; a scan of one column)."""
    lo, hi = obs.agg(F.min(F.to_date("obs_ts")), F.max(F.to_date("obs_ts"))).first()
    return (lo, hi) if lo is not None else (_dt.date(2000, 1, 1), _dt.date(2000, 1, 1))


def with_daylight(obs: DataFrame, sun: DataFrame) -> DataFrame:
    """Adds the day's sun times (columns of :func:`sun_times`), ``_daylight`` and ``_day_solar``: the
    solar reading between sunrise and sunset, else NULL."""
    day = sun.withColumnRenamed("station", "_station").withColumnRenamed("date", "_date")
    joined = obs.join(day, (F.col("station") == F.col("_station")) & (F.to_date("obs_ts") == F.col("_date")), "left") \
        .drop("_station", "_date")
    return joined.withColumn("_daylight", F.col("obs_ts").between(F.col("sunrise"), F.col("sunset"))) \
        .withColumn("_day_solar", F.when(F.col("_daylight"), F.col("solar_radiation")))


def solar_aggregate(with_stations: bool):
    """The daylight solar mean; NULL without a station registry."""
    solar = exact_mean_col("_day_solar", 1, 1, "DECIMAL(5, 1)") if with_stations else F.lit(None)
    return solar.cast(schemas.D51).alias("solar_radiation_avg")


def day_aggregates() -> list:
    """The 15 day measures of the observation roll-up, typed as the daily DDL."""
    d = dict((f.name, f.dataType) for f in schemas.DAILY.fields)
    return [
        exact_mean_col("temp", 1, 1, "DECIMAL(3, 1)").alias("temp_avg"),
        F.max("temp").cast(d["temp_high"]).alias("temp_high"),
        F.min("temp").cast(d["temp_low"]).alias("temp_low"),
        exact_mean_col("dewpt", 1, 1, "DECIMAL(3, 1)").alias("dewpoint_avg"),
        F.max("dewpt").cast(d["dewpoint_high"]).alias("dewpoint_high"),
        F.min("dewpt").cast(d["dewpoint_low"]).alias("dewpoint_low"),
        exact_mean_col("humidity", 0, 0, "INT").alias("humidity_avg"),
        F.max("humidity").alias("humidity_high"),
        F.min("humidity").alias("humidity_low"),
        exact_mean_col("pressure", 2, 1, "DECIMAL(5, 1)").alias("pressure_avg"),
        F.round(F.max("pressure"), 1).cast(d["pressure_high"]).alias("pressure_high"),
        F.round(F.min("pressure"), 1).cast(d["pressure_low"]).alias("pressure_low"),
        F.max("wind_speed").cast(d["wind_speed_max"]).alias("wind_speed_max"),
        F.max("wind_gust").cast(d["gust_speed_max"]).alias("gust_speed_max"),
        F.round(F.max("precip_total"), 1).cast(d["precipitation_sum"]).alias("precipitation_sum"),
    ]


def daily_rollup(obs: DataFrame, stations: DataFrame | None = None,
                 days: tuple[_dt.date, _dt.date] | None = None, sun: DataFrame | None = None) -> DataFrame:
    """A1 (+ A2/J1 when a station registry is given): the ``daily`` table.

    Without a registry the daylight solar mean is NULL (missing -> NULL). ``days`` is the span the
    observations lie in (found by a scan unless given); ``sun`` may be given instead of the registry.
    """
    if sun is None and stations is not None:
        sun = sun_times(stations, *(days or observed_days(obs)))
    aggs = [*day_aggregates(), solar_aggregate(sun is not None)]
    src = obs if sun is None else with_daylight(obs, sun)
    out = (src.groupBy("station", F.to_date("obs_ts").alias("date")).agg(*aggs))
    return out.select(*[f.name for f in schemas.DAILY.fields])


def daylight_solar(obs: DataFrame, stations: DataFrame, days: tuple[_dt.date, _dt.date] | None = None) -> DataFrame:
    """A2 with its sun times: one row per station and day with observations."""
    src = with_daylight(obs, sun_times(stations, *(days or observed_days(obs))))
    sun = ["sunrise", "sunset", "day_hours", "day_minutes", "day_seconds"]
    return src.groupBy("station", F.to_date("obs_ts").alias("date"), *sun).agg(
        exact_mean_col("_day_solar", 1, 1, "DECIMAL(5, 1)").alias("solar_radiation_avg"),
        F.count(F.when(F.col("_daylight"), 1)).alias("n_daylight_obs"))


def sun_of_days(days: DataFrame, stations: DataFrame) -> DataFrame:
    """Sunrise, sunset (station local time) and day length of the given (station, date)."""
    known = days.select("station", "date").distinct().join(stations.select("station", "lat", "lon", "tz"), "station")
    sun = sun_columns(F.col("date"), F.col("lat"), F.col("lon"), F.col("tz"))
    return known.select("station", "date", *[c.alias(k) for k, c in sun.items()])


def sun_times(stations: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Sunrise, sunset (station local time) and day length per day."""
    days = stations.select("station", "lat", "lon", "tz",
                           F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    sun = sun_columns(F.col("date"), F.col("lat"), F.col("lon"), F.col("tz"))
    return days.select("station", "date", *[c.alias(k) for k, c in sun.items()])


def date_spine(stations: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """One row per station and requested day (a generator, not a join)."""
    return stations.select("station", F.explode(
        F.sequence(F.lit(start), F.lit(end))).alias("date"))


def daily_rollup_range(obs: DataFrame, station_ids: DataFrame, start: _dt.date,
                       end: _dt.date, stations: DataFrame | None = None,
                       today: _dt.date | None = None) -> DataFrame:
    """J4 + F3: every requested day appears, days without data as NULL rows.

    The observation scan is cut to the half-open range [start, end + 1 day)
    so parquet statistics and partition pruning apply.
    """
    check_date_range(start, end, today)
    lo = _dt.datetime.combine(start, _dt.time())
    hi = _dt.datetime.combine(end + _dt.timedelta(days=1), _dt.time())
    cut = obs.filter((F.col("obs_ts") >= F.lit(lo).cast("timestamp_ntz"))
                     & (F.col("obs_ts") < F.lit(hi).cast("timestamp_ntz")))
    rolled = daily_rollup(cut, stations, (start, end))
    spine = date_spine(station_ids, start, end)
    return spine.join(rolled, ["station", "date"], "left").select(
        *[f.name for f in schemas.DAILY.fields])
