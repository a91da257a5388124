"""Period statistics against a brute-force Python computation on a hand fixture."""

import datetime as dt
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal as D

import pytest

from isobar import schemas
from isobar.config import DAY_COUNT_METRICS, RECORD_METRICS, Period, closed_left_metrics, periods_frame
from isobar.operators import normals


def _row(st, day, avg=None, high=None, low=None, rain=None):
    vals = {"temp_avg": avg, "temp_high": high, "temp_low": low, "precipitation_sum": rain}
    out = [st, day]
    for f in schemas.DAILY.fields[2:]:
        v = vals.get(f.name)
        out.append(None if v is None else D(v))
    return tuple(out)


ROWS = [
    # 2000: boundary lows/highs/rain, 29 February, a tie on the max high
    _row("A", dt.date(2000, 1, 1), "-5.0", "0.0", "-5.0", "1.0"),
    _row("A", dt.date(2000, 1, 2), "0.0", "5.0", "0.0", "5.0"),
    _row("A", dt.date(2000, 2, 29), "5.0", "10.0", "5.0", "4.9"),
    _row("A", dt.date(2000, 6, 1), "12.5", "30.0", "10.0", "0.1"),
    _row("A", dt.date(2000, 7, 1), "22.0", "30.0", "20.0", "20.0"),
    _row("A", dt.date(2000, 7, 2), "25.0", "29.9", "20.1", None),
    # 2001: only NULL rows (the year still counts)
    _row("A", dt.date(2001, 3, 1)),
    _row("A", dt.date(2001, 3, 2)),
    # 2002: no March, another max-high tie, .5 day-count cases
    _row("A", dt.date(2002, 1, 5), "1.0", "4.9", "0.1", "10.0"),
    _row("A", dt.date(2002, 8, 15), "25.0", "30.0", "15.0", "1.0"),
    # second station, one day only
    _row("B", dt.date(2000, 5, 5), "10.0", "15.0", "5.0", None),
]
PERIODS = [Period(2000, 2002), Period(2000, 2001), Period(2001, 2002)]


def _in(m, v):
    if v is None:
        return False
    lo, hi = m.lo, m.hi
    if lo is not None and not (v >= D(str(lo)) if m.lo_closed else v > D(str(lo))):
        return False
    if hi is not None and not (v <= D(str(hi)) if m.hi_closed else v < D(str(hi))):
        return False
    return True


def brute(rows, period, station, metrics):
    data = [r for r in rows if r[0] == station and period.year_start <= r[1].year <= period.year_end]
    if not data:
        return None
    idx = {f.name: i for i, f in enumerate(schemas.DAILY.fields)}
    years = sorted({r[1].year for r in data})
    out = {"n_years": len(years)}

    def mean(col):
        vals = [r[idx[col]] for r in data if r[idx[col]] is not None]
        return float((sum(vals) / len(vals)).quantize(D("0.1"), ROUND_HALF_UP)) if vals else None
    out["Avg_TempAvg"] = mean("temp_avg")
    out["Avg_TempHigh"] = mean("temp_high")
    out["Avg_TempLow"] = mean("temp_low")
    out["Avg_Daily_Precipitation"] = mean("precipitation_sum")
    tot = sum((r[idx["precipitation_sum"]] or D(0)) for r in data)
    out["Yearly_Avg_Precipitation"] = float((tot / len(years)).quantize(D("0.1"), ROUND_HALF_UP))
    for m in metrics:
        n = sum(1 for r in data if _in(m, r[idx[m.column]]))
        out[m.name] = int((D(n) / len(years)).quantize(D("1"), ROUND_HALF_EVEN))
    for r in RECORD_METRICS:
        vals = [x[idx[r.column]] for x in data if x[idx[r.column]] is not None]
        if not vals:
            out[r.name] = []
            continue
        ext = max(vals) if r.kind == "max" else min(vals)
        out[r.name] = sorted((str(x[1]), str(ext)) for x in data if x[idx[r.column]] == ext)
    return out


@pytest.mark.parametrize("metrics", [DAY_COUNT_METRICS, closed_left_metrics()])
def test_period_summary_matches_brute_force(spark, metrics):
    daily = spark.createDataFrame(ROWS, schemas.DAILY)
    per = periods_frame(spark, PERIODS)
    got = {(r.station, r.period_id): r.asDict() for r in
           normals.period_summary(daily, per, metrics).collect()}
    for p in PERIODS:
        for st in ("A", "B"):
            exp = brute(ROWS, p, st, metrics)
            if exp is None:
                assert (st, p.period_id) not in got
                continue
            g = got[(st, p.period_id)]
            for k, v in exp.items():
                if k in {m.name for m in RECORD_METRICS}:
                    assert [(e["Date"], e["Value"]) for e in g[k]] == v, (p, st, k)
                else:
                    assert g[k] == v, (p, st, k, g[k], v)


def test_all_null_year_counts_in_denominator(spark):
    daily = spark.createDataFrame(ROWS, schemas.DAILY)
    per = periods_frame(spark, [Period(2000, 2001)])
    r = normals.period_means(daily, per).filter("station = 'A'").first()
    assert r.n_years == 2
    # 2000 rain total 31.0 over two years
    assert r.Yearly_Avg_Precipitation == 15.5


def test_monthly_normals_missing_month_and_leap_day(spark):
    daily = spark.createDataFrame(ROWS, schemas.DAILY)
    per = periods_frame(spark, [Period(2000, 2002)])
    rows = {(r.station, r.month): r for r in normals.monthly_normals(daily, per).collect()}
    assert ("A", 2) in rows and rows[("A", 2)].Avg_TempAvg == 5.0
    assert rows[("A", 2)].month_name == "February"
    assert ("A", 4) not in rows  # no data in April at all
    jan = rows[("A", 1)]
    assert jan.Max_TempHigh_Max == 5.0 and jan.Max_TempHigh_Min == 0.0
    assert jan.Min_TempLow_Min == -5.0
    # January rain 1.0 + 5.0 (2000) + 10.0 (2002) over 2 years with January rows
    assert jan.Avg_Monthly_Precipitation == 8.0
    assert jan.Avg_Days_Precipitation_1 == 2  # 3 wet days / 2 years = 1.5 -> 2 (half even)


def test_records_tie_and_all_null(spark):
    daily = spark.createDataFrame(ROWS, schemas.DAILY)
    per = periods_frame(spark, [Period(2001, 2001)])
    r = normals.records(daily, per).first()
    assert r.Max_TempHigh == [] and r.Min_TempLow == []
    per = periods_frame(spark, [Period(2000, 2002)])
    r = normals.records(daily, per).filter("station = 'A'").first()
    assert [e.Date for e in r.Max_TempHigh] == ["2000-06-01", "2000-07-01", "2002-08-15"]
    assert {e.Value for e in r.Max_TempHigh} == {"30.0"}
