import datetime as dt
import json
import os
from decimal import Decimal as D

from isobar import schemas
from isobar.config import stations_frame
from isobar.operators import jobs
from isobar.sources import tables


def _obs(spark, rows):
    full = [(st, ts, D(t)) + (None,) * 13 for st, ts, t in rows]
    return spark.createDataFrame(full, schemas.OBSERVATIONS)


def test_refresh_days_idempotent_and_skip_empty(spark, tmpdir_path):
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    daily = os.path.join(tmpdir_path, "daily")
    obs = _obs(spark, [("P", dt.datetime(2024, 1, 1, 10), "2.0"), ("P", dt.datetime(2024, 1, 2, 10), "4.0")])
    for _ in range(2):
        jobs.refresh_days(spark, obs, daily, dt.date(2024, 1, 1), dt.date(2024, 1, 3), st)
        got = {r.date: r.temp_avg for r in spark.read.parquet(daily).collect()}
        assert got == {dt.date(2024, 1, 1): D("2.0"), dt.date(2024, 1, 2): D("4.0"), dt.date(2024, 1, 3): None}
    # a later run without the 2nd day's data: NULLs overwrite unless skip_empty
    obs1 = _obs(spark, [("P", dt.datetime(2024, 1, 1, 10), "3.0")])
    jobs.refresh_days(spark, obs1, daily, dt.date(2024, 1, 1), dt.date(2024, 1, 2), st, skip_empty=True)
    got = {r.date: r.temp_avg for r in spark.read.parquet(daily).collect()}
    assert got[dt.date(2024, 1, 1)] == D("3.0") and got[dt.date(2024, 1, 2)] == D("4.0")
    jobs.refresh_days(spark, obs1, daily, dt.date(2024, 1, 1), dt.date(2024, 1, 2), st)
    got = {r.date: r.temp_avg for r in spark.read.parquet(daily).collect()}
    assert got[dt.date(2024, 1, 2)] is None


def test_selectors():
    assert jobs.yesterday_range(dt.date(2024, 3, 1)) == (dt.date(2024, 2, 29), dt.date(2024, 2, 29))
    assert jobs.today_range(dt.date(2024, 3, 1)) == (dt.date(2024, 3, 1), dt.date(2024, 3, 1))


def test_station_registry_from_json(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "stations.json")
    with open(p, "w") as fh:
        json.dump({"db1": {"weatherStation": "IVILLE1", "latitude": 48.7, "longitude": 2.2,
                           "timezone": "Europe/Paris"},
                   "db2": {"weatherStation": "ILILLE2", "latitude": 50.6, "longitude": 3.1,
                           "timezone": "Europe/Paris"}}, fh)
    got = {r.station: (r.lat, r.tz) for r in tables.stations_from_json(spark, p).collect()}
    assert got == {"IVILLE1": (48.7, "Europe/Paris"), "ILILLE2": (50.6, "Europe/Paris")}
