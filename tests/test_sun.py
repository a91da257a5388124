"""Sun times against another formula and well-known times, and where they are computed."""

import datetime as dt
import math
from zoneinfo import ZoneInfo

import pytest

from isobar import schemas
from isobar.config import stations_frame
from isobar.operators import rollup

PLACES = [("London", 51.5074, -0.1278, "Europe/London"), ("NewYork", 40.7128, -74.0060, "America/New_York"),
          ("Sydney", -33.8688, 151.2093, "Australia/Sydney"), ("Tokyo", 35.6762, 139.6503, "Asia/Tokyo"),
          ("Quito", -0.1807, -78.4678, "America/Guayaquil")]
DAYS = [dt.date(2024, 3, 20), dt.date(2024, 6, 20), dt.date(2024, 9, 22), dt.date(2024, 12, 21)]
# Times of almanacs, to the minute.
KNOWN = {("London", dt.date(2024, 6, 20)): ("04:43", "21:21"), ("London", dt.date(2024, 12, 21)): ("08:04", "15:53"),
         ("NewYork", dt.date(2024, 12, 21)): ("07:17", "16:32"), ("NewYork", dt.date(2024, 6, 20)): ("05:25", "20:31"),
         ("Sydney", dt.date(2024, 12, 21)): ("05:41", "20:05"), ("Tokyo", dt.date(2024, 12, 21)): ("06:47", "16:32")}


def other_formula(day, lat, lon):
    """Sunrise and sunset in minutes of the UTC day, by apparent longitude and the equation of time
    in Julian centuries."""
    def at(minutes):
        t = ((day - dt.date(2000, 1, 1)).days - 0.5 + minutes / 1440) / 36525
        mean, anomaly = math.radians(280.46646 + 36000.76983 * t), math.radians(357.52911 + 35999.05029 * t)
        e = 0.016708634 - 0.000042037 * t
        centre = (1.914602 - 0.004817 * t) * math.sin(anomaly) + 0.019993 * math.sin(2 * anomaly) + 0.000289 * math.sin(3 * anomaly)
        node = math.radians(125.04 - 1934.136 * t)
        apparent = mean + math.radians(centre - 0.00569 - 0.00478 * math.sin(node))
        tilt = math.radians(23.439291 - 0.0130042 * t + 0.00256 * math.cos(node))
        y = math.tan(tilt / 2) ** 2
        eq = 4 * math.degrees(y * math.sin(2 * mean) - 2 * e * math.sin(anomaly) + 4 * e * y * math.sin(anomaly) * math.cos(2 * mean)
                              - 0.5 * y * y * math.sin(4 * mean) - 1.25 * e * e * math.sin(2 * anomaly))
        return eq, math.asin(math.sin(tilt) * math.sin(apparent))
    out = []
    for sign in (1, -1):
        minutes = 720 - 4 * lon
        for _ in range(3):
            eq, dec = at(minutes)
            ha = math.degrees(math.acos((math.cos(math.radians(90.833)) - math.sin(math.radians(lat)) * math.sin(dec))
                                        / (math.cos(math.radians(lat)) * math.cos(dec))))
            minutes = 720 - 4 * (lon + sign * ha) - eq
        out.append(minutes)
    return out


@pytest.fixture(scope="module")
def times(spark):
    st = stations_frame(spark, [(*p, "x") for p in PLACES])
    return {(r.station, r.date): r for d in DAYS for r in rollup.sun_times(st, d, d).collect()}


def test_sun_times_against_another_formula(times):
    for name, lat, lon, tz in PLACES:
        for day in DAYS:
            for got, minutes in zip((times[name, day].sunrise, times[name, day].sunset), other_formula(day, lat, lon)):
                utc = dt.datetime.combine(day, dt.time(), dt.timezone.utc) + dt.timedelta(minutes=minutes)
                want = utc.astimezone(ZoneInfo(tz)).replace(tzinfo=None)
                assert abs((got - want).total_seconds()) < 120, (name, day, got, want)


def test_sun_times_against_almanacs(times):
    for key, known in KNOWN.items():
        for got, text in zip((times[key].sunrise, times[key].sunset), known):
            want = dt.datetime.combine(key[1], dt.time.fromisoformat(text))
            assert abs((got - want).total_seconds()) <= 120, (key, got, text)


def test_no_trigonometry_above_the_observations(spark, tmpdir_path):
    spark.createDataFrame([], schemas.OBSERVATIONS).write.mode("overwrite").parquet(f"{tmpdir_path}/obs")
    st = stations_frame(spark, [(*p, "x") for p in PLACES])
    out = rollup.daily_rollup(spark.read.parquet(f"{tmpdir_path}/obs"), st, (DAYS[0], DAYS[1]))
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    scan = next(i for i, line in enumerate(plan) if "solar_radiation" in line and "parquet" in line)
    trig = [i for i, line in enumerate(plan) if "ACOS(" in line.upper()]
    # all of it in the join's other branch, below the observations' scan in the printed plan
    assert trig and min(trig) > scan > join
