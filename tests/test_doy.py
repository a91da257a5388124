"""Day-of-year normals: overlapping periods answered from the year arrays."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal as D

import pytest

from isobar import schemas
from isobar.config import Period, load_normals_config, periods_frame
from isobar.operators import doy

COLUMNS = [f for f in schemas.DAILY.fields[2:]]


def daily_rows(years=range(1990, 2028), days=((1, 1), (2, 29), (7, 14)), stations=("A", "B"), seed=1):
    rnd = random.Random(seed)
    rows = []
    for st in stations:
        for y in years:
            for m, d in days:
                if (m, d) == (2, 29) and (y % 4 or rnd.random() < 0.3) or rnd.random() < 0.1:
                    continue
                vals = [None if rnd.random() < 0.2 else rnd.randint(0, 99) if f.dataType.simpleString() == "int"
                        else D(rnd.randint(-300, 400)) / 10 for f in COLUMNS]
                rows.append((st, dt.date(y, m, d), *vals))
    return rows


NINETEEN = [Period(1990 + i, 1990 + i + 18) for i in range(19)]


def half_up(x, digits):
    return x.quantize(D(1).scaleb(-digits), ROUND_HALF_UP)


def direct(rows, periods, name, kind, scale):
    """{(station, period, day): value} of one column."""
    at = 2 + [f.name for f in COLUMNS].index(name)
    groups = {}
    for r in rows:
        for p in periods:
            if p.year_start <= r[1].year <= p.year_end:
                groups.setdefault((r[0], p.period_id, r[1].strftime("%m-%d")), []).append(r[at])
    out = {}
    for k, v in groups.items():
        v = [D(x) for x in v if x is not None]
        if not v:
            out[k] = None
        elif kind == "avg":
            out[k] = half_up(half_up(sum(v) / len(v), (scale or 0) + 4), scale)
        else:
            out[k] = {"sum": sum, "min": min, "max": max}[kind](v)
    return out


def test_nineteen_overlapping_periods(spark):
    rows = daily_rows()
    daily = spark.createDataFrame(rows, schemas.DAILY)
    got = {(r["station"], r["period_id"], r["DayOfYear"]): r
           for r in doy.doy_normals_fixed(daily, periods_frame(spark, NINETEEN)).collect()}
    for field, name, kind, scale in (("AvgTempAvg", "temp_avg", "avg", 1), ("AvgHumidityLow", "humidity_low", "avg", 0),
                                     ("MinTempLow", "temp_low", "min", 1), ("MaxPressureHigh", "pressure_high", "max", 1),
                                     ("AvgPrecipitationSum", "precipitation_sum", "avg", 1)):
        want = direct(rows, NINETEEN, name, kind, scale)
        assert {k: None if r[field] is None else D(r[field]) for k, r in got.items()} == want


def test_lookups_equal_the_expressions_on_repeated_rows(spark):
    daily = spark.createDataFrame(daily_rows(seed=2), schemas.DAILY)
    periods = periods_frame(spark, NINETEEN[::3])
    crossref = dict(load_normals_config().crossref, Plain="AVG(MaxTemp)", Total="sum( Precipitation )", Two="ROUND(AVG(Humidity), 2)")
    fast = doy.doy_normals_config(daily, periods, crossref)
    # an expression that is no lookup sends all of them to the daily rows of every period
    assert doy.crossref_measures(daily, dict(crossref, N="COUNT(MaxTemp)")) is None
    slow = doy.doy_normals_config(daily, periods, dict(crossref, N="COUNT(MaxTemp)")).drop("N")
    assert [(f.name, f.dataType) for f in fast.schema] == [(f.name, f.dataType) for f in slow.schema]
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))


def test_periods_of_their_own_for_each_station(spark):
    rows = daily_rows(stations=("A", "B", "C"), seed=3)
    daily = spark.createDataFrame(rows, schemas.DAILY)
    own = {"A": NINETEEN[:2], "B": NINETEEN[5:6]}
    periods = spark.createDataFrame([(s, p.period_id, p.year_start, p.year_end) for s, ps in own.items() for p in ps],
                                    "station string, period_id string, year_start int, year_end int")
    want = {}
    for s, ps in own.items():
        want.update({k: v for k, v in direct(rows, ps, "temp_high", "max", 1).items() if k[0] == s})
    got = {(r["station"], r["period_id"], r["DayOfYear"]): r["MaxTempHigh"]
           for r in doy.doy_normals_fixed(daily, periods).collect()}
    assert got == want


@pytest.mark.parametrize("build", ["fixed", "config"])
def test_plan_repeats_no_daily_rows(spark, build, tmpdir_path):
    spark.createDataFrame(daily_rows(), schemas.DAILY).write.mode("overwrite").parquet(f"{tmpdir_path}/daily")
    daily, periods = spark.read.parquet(f"{tmpdir_path}/daily"), periods_frame(spark, NINETEEN)
    out = doy.doy_normals_fixed(daily, periods) if build == "fixed" else \
        doy.doy_normals_config(daily, periods, load_normals_config().crossref)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Join" not in plan and plan.count("Exchange") == 1
    # the periods are unfolded above the arrays
    assert plan.index("Generate") < plan.index("collect_list") < plan.index("Window")


def test_repeated_dates_empty_table_and_no_periods(spark):
    rows = daily_rows(years=range(2000, 2004)) * 2
    daily = spark.createDataFrame(rows, schemas.DAILY)
    periods = [Period(2000, 2001), Period(2001, 2003)]
    got = {(r["station"], r["period_id"], r["DayOfYear"]): r["AvgTempAvg"]
           for r in doy.doy_normals_fixed(daily, periods_frame(spark, periods)).collect()}
    assert got == direct(rows, periods, "temp_avg", "avg", 1)
    assert doy.doy_normals_fixed(daily.limit(0), periods_frame(spark, periods)).collect() == []
    assert doy.doy_normals_fixed(daily, periods_frame(spark, [])).collect() == []
