import datetime as dt
from decimal import Decimal as D

import pytest

from isobar import schemas
from isobar.config import stations_frame
from isobar.operators import rollup
from isobar.operators.upsert import first_arrival


def _obs(spark, rows):
    full = []
    for r in rows:
        station, ts, temp, solar = r
        full.append((station, ts, temp, 50, None, D("1.20"), D("1013.25"), None, D("3.0"), D("5.0"),
                     None, 180, D("1.0"), None, solar, None))
    return spark.createDataFrame(full, schemas.OBSERVATIONS)


def test_rollup_and_daylight_boundaries(spark):
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    sun = rollup.sun_times(st, dt.date(2024, 1, 15), dt.date(2024, 1, 15)).first()
    rise, sset = sun.sunrise, sun.sunset
    assert dt.time(8, 20) < rise.time() < dt.time(8, 55)
    assert dt.time(17, 0) < sset.time() < dt.time(17, 35)
    rows = [
        ("P", rise, D("1.0"), D("100.0")),                       # at sunrise: included
        ("P", sset, D("3.0"), D("300.0")),                       # at sunset: included
        ("P", rise - dt.timedelta(seconds=1), D("2.0"), D("999.0")),  # before: excluded
        ("P", dt.datetime(2024, 1, 15, 23, 59, 59), D("5.0"), D("0.0")),
        ("P", dt.datetime(2024, 1, 16, 0, 0, 0), D("7.0"), D("0.0")),  # next day
    ]
    d = {r.date: r for r in rollup.daily_rollup(_obs(spark, rows), st).collect()}
    day = d[dt.date(2024, 1, 15)]
    assert day.solar_radiation_avg == D("200.0")
    assert day.temp_high == D("5.0") and day.temp_low == D("1.0")
    assert day.temp_avg == D("2.8")  # (1+3+2+5)/4 = 2.75 -> 2.8 half up
    assert d[dt.date(2024, 1, 16)].temp_avg == D("7.0")


def test_spine_has_empty_days_and_guards(spark):
    st = spark.createDataFrame([("P",)], "station string")
    rows = [("P", dt.datetime(2024, 1, 2, 12, 0), D("4.0"), None)]
    out = rollup.daily_rollup_range(_obs(spark, rows), st, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    got = {r.date: r.temp_avg for r in out.collect()}
    assert got == {dt.date(2024, 1, 1): None, dt.date(2024, 1, 2): D("4.0"), dt.date(2024, 1, 3): None}
    with pytest.raises(ValueError):
        rollup.daily_rollup_range(_obs(spark, rows), st, dt.date(2024, 1, 3), dt.date(2024, 1, 1))
    with pytest.raises(ValueError):
        rollup.daily_rollup_range(_obs(spark, rows), st, dt.date(2024, 1, 1), dt.date(2999, 1, 1))


def test_polar_night_gives_null(spark):
    st = stations_frame(spark, [("N", 80.0, 15.0, "UTC", "x")])
    r = rollup.sun_times(st, dt.date(2024, 12, 21), dt.date(2024, 12, 21)).first()
    assert r.sunrise is None and r.sunset is None


def test_first_arrival_wins(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 1, 1), ("a", 2, 2)], "k string, t int, arrival int")
    got = sorted((r.t, r.arrival) for r in first_arrival(df, ["k", "t"], "arrival").collect())
    assert got == [(1, 1), (2, 2)]
