import datetime as dt
import glob
import json
import os
import time

import pytest

from isobar import schemas
from isobar.config import stations_frame
from isobar.operators import changes, jobs, rollup
from isobar.streaming import pipeline


def _msg(t, temp, arrival=None, solar=100.0, epoch=None):
    m = {"observations": [{"stationID": "P", "obsTimeLocal": t, "humidity": 50.0, "epoch": epoch,
                           "solarRadiation": solar,
                           "metric": {"temp": temp, "windSpeed": 2.0, "pressure": 1010.0}}]}
    return m | ({"arrival": arrival} if arrival is not None else {})


def _land(path, name, msgs):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in msgs))
    time.sleep(0.02)      # files land one after the other


def _run(spark, land, obs, ck, **more):
    pipeline.run_ingest(spark, land, obs, ck, **more).awaitTermination()


def _daily(spark, path):
    return changes.read_merged(spark, path, schemas.DAILY_KEYS, pipeline.DAILY_PARTS)


def _temps(spark, obs):
    return {(r.obs_ts.day, r.obs_ts.hour): float(r.temp) for r in spark.read.parquet(obs).collect()}


def test_first_arrival_across_batches_and_daily_refresh(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    # the later arrival is in the first file: the earlier one must still win
    _land(land, "a.json", [_msg("2024-01-10 12:00:00", 5.0, 9), _msg("2024-01-10 13:00:00", 7.0, 3)])
    _land(land, "b.json", [_msg("2024-01-10 12:00:00", 1.0, 2), _msg("2024-01-11 12:00:00", 3.0, 4),
                           _msg("2024-01-10 14:00:00", 4.0, 5)])
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    obs, daily = os.path.join(tmpdir_path, "obs"), os.path.join(tmpdir_path, "daily")
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"), daily_path=daily, stations=st, files_per_trigger=1)
    got = {(r.obs_ts.hour, r.obs_ts.day): (float(r.temp), r.arrival) for r in spark.read.parquet(obs).collect()}
    assert got == {(12, 10): (1.0, 2), (13, 10): (7.0, 3), (12, 11): (3.0, 4), (14, 10): (4.0, 5)}
    days = {r.date: r for r in _daily(spark, daily).collect()}
    assert float(days[dt.date(2024, 1, 10)].temp_avg) == 4.0
    assert float(days[dt.date(2024, 1, 10)].solar_radiation_avg) == 100.0
    # a replay of the same files (new checkpoint) changes nothing
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck2"), daily_path=daily, stations=st)
    assert spark.read.parquet(obs).count() == 4
    batch = rollup.daily_rollup(spark.read.parquet(obs).drop("obs_date", *pipeline.ARRIVAL), st)
    assert {r.date: r.temp_avg for r in batch.collect()} == \
        {r.date: r.temp_avg for r in _daily(spark, daily).collect()}
    changes.compact(spark, daily, schemas.DAILY_KEYS, pipeline.DAILY_PARTS)
    assert {r.date: r.temp_avg for r in batch.collect()} == {r.date: r.temp_avg for r in spark.read.parquet(daily).collect()}


@pytest.mark.parametrize("temps", [(1.0, 9.0), (9.0, 1.0)])
def test_first_wins_without_arrival_and_on_replay(spark, tmpdir_path, temps):
    land, obs = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "obs")
    _land(land, "z.json", [_msg("2024-01-10 12:00:00", temps[0])])
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"))
    _land(land, "a.json", [_msg("2024-01-10 12:00:00", temps[1]), _msg("2024-01-10 13:00:00", 2.0)])
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"))
    want = {(10, 12): temps[0], (10, 13): 2.0}
    assert _temps(spark, obs) == want
    for n, files in ((2, 1), (3, None)):      # replays from scratch, file by file and all at once
        _run(spark, land, obs, os.path.join(tmpdir_path, f"ck{n}"), files_per_trigger=files)
        assert _temps(spark, obs) == want
    fresh = os.path.join(tmpdir_path, "fresh")
    _run(spark, land, fresh, os.path.join(tmpdir_path, "ck4"))
    assert _temps(spark, fresh) == want


def test_same_file_is_ordered_by_epoch(spark, tmpdir_path):
    land, obs = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "obs")
    _land(land, "a.json", [_msg("2024-01-10 12:00:00", 5.0, epoch=20), _msg("2024-01-10 12:00:00", 6.0, epoch=10)])
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"))
    assert _temps(spark, obs) == {(10, 12): 6.0}


def test_stored_files_stay_and_scratch_goes(spark, tmpdir_path):
    land, obs = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "obs")
    daily, ck = os.path.join(tmpdir_path, "daily"), os.path.join(tmpdir_path, "ck")
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    scratch = spark.conf.get("spark.checkpoint.dir").replace("file:", "") + "/isobar-*"
    before = set(glob.glob(scratch))
    _land(land, "a.json", [_msg("2024-01-10 12:00:00", 5.0), _msg("2024-03-11 12:00:00", 6.0)])
    _run(spark, land, obs, ck, daily_path=daily, stations=st, compact_every=1)
    stored = set(glob.glob(f"{obs}/*/*.parquet"))
    january = set(glob.glob(f"{daily}/year=2024/month=1/*.parquet"))
    _land(land, "b.json", [_msg("2024-03-11 13:00:00", 8.0), _msg("2024-01-10 12:00:00", 1.0)])
    _run(spark, land, obs, ck, daily_path=daily, stations=st, compact_every=1)
    assert stored < set(glob.glob(f"{obs}/*/*.parquet"))
    assert january == set(glob.glob(f"{daily}/year=2024/month=1/*.parquet")) and january
    assert {r.date.month: float(r.temp_avg) for r in spark.read.parquet(daily).collect()} == {1: 5.0, 3: 7.0}
    assert set(glob.glob(scratch)) == before


def test_bad_messages_are_kept_aside(spark, tmpdir_path):
    land, obs = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "obs")
    _land(land, "a.json", [_msg("2024-01-10 12:00:00", 5.0), '{"observations": [broken', _msg("2024-01-10 13:00:00", 150.0)])
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"))
    assert _temps(spark, obs) == {(10, 12): 5.0}
    bad = spark.read.parquet(pipeline.rejected_path(obs)).collect()
    assert sorted(r.reason for r in bad) == ["not parsed", "out of range"]
    assert [r._corrupt for r in bad if r.reason == "not parsed"] == ['{"observations": [broken']


def test_batches_prune_the_stored_days(spark, tmpdir_path):
    from isobar.operators.upsert import in_partitions
    land, obs = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "obs")
    _land(land, "a.json", [_msg(f"2024-01-{d:02} 12:00:00", 5.0) for d in range(1, 20)])
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"))
    t = spark.read.parquet(obs)
    one = t.filter("obs_date = DATE'2024-01-07'")
    plan = in_partitions(t, one, pipeline.OBS_PARTS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-07" in plan.split("PartitionFilters")[1]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_finalized_days_in_append_mode(spark, tmpdir_path, zone):
    land = os.path.join(tmpdir_path, "landing")
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    _land(land, "a.json", [_msg("2024-01-02 00:30:00", 1.0), _msg("2024-01-02 12:00:00", 3.0, solar=50.0),
                           _msg("2024-01-02 23:30:00", 5.0), _msg("2024-01-03 00:00:00", 9.0),
                           _msg("2024-01-09 10:00:00", 9.0)])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = pipeline.observation_rows(pipeline.read_landed(spark, land))
        out = os.path.join(tmpdir_path, "days")
        for _ in range(2):    # the second run emits what the first one's watermark closed
            (pipeline.finalized_daily(rows, "2 days", rollup.sun_times(st, dt.date(2024, 1, 1), dt.date(2024, 1, 10))).writeStream.outputMode("append")
             .format("parquet").option("path", out).trigger(availableNow=True)
             .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).start().awaitTermination())
        got = spark.read.parquet(out).orderBy("date").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [(str(r.date), float(r.temp_avg)) for r in got] == [("2024-01-02", 3.0), ("2024-01-03", 9.0)]
    assert float(got[0].solar_radiation_avg) == 50.0 and got[1].solar_radiation_avg is None


def test_dry_run_returns_changes_and_writes_nothing(spark, tmpdir_path):
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    daily = os.path.join(tmpdir_path, "daily")
    from decimal import Decimal as D
    obs = spark.createDataFrame([("P", dt.datetime(2024, 1, 1, 10), D("2.0")) + (None,) * 13], schemas.OBSERVATIONS)
    args = (dt.date(2024, 1, 1), dt.date(2024, 1, 2), st)
    first = jobs.refresh_days(spark, obs, daily, *args, dry_run=True)
    assert sorted(r.action for r in first.collect()) == ["insert", "insert"] and not os.path.exists(daily)
    jobs.refresh_days(spark, obs, daily, *args)
    again = spark.createDataFrame([("P", dt.datetime(2024, 1, 1, 10), D("3.0")) + (None,) * 13], schemas.OBSERVATIONS)
    changes = {r.date.day: (r.action, r.changed) for r in jobs.refresh_days(spark, again, daily, *args, dry_run=True).collect()}
    assert changes == {1: ("update", "temp_avg,temp_high,temp_low"), 2: ("update", "")}


def test_dry_run_names_what_the_run_does(spark, tmpdir_path):
    from decimal import Decimal as D
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    daily = os.path.join(tmpdir_path, "daily")
    obs = spark.createDataFrame([("P", dt.datetime(2024, 1, 2, 10), D("2.0")) + (None,) * 13], schemas.OBSERVATIONS)
    args = (spark, obs, daily, dt.date(2024, 1, 1), dt.date(2024, 1, 4), st)
    promised = jobs.refresh_days(*args, skip_empty=True, dry_run=True)
    assert [(r.date.day, r.action) for r in promised.collect()] == [(2, "insert")]
    jobs.refresh_days(*args, skip_empty=True)
    assert [r.date.day for r in spark.read.parquet(daily).collect()] == [2]


def test_finalized_days_keep_the_first_arrival(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    # the earliest arrival comes last, in a later file; its copies differ
    _land(land, "a.json", [dict(_msg("2024-01-02 12:00:00", 7.0), arrival=30), dict(_msg("2024-01-02 12:00:00", 9.0), arrival=20)])
    _land(land, "b.json", [dict(_msg("2024-01-02 12:00:00", 3.0), arrival=10), dict(_msg("2024-01-02 13:00:00", 5.0), arrival=40)])
    _land(land, "c.json", [dict(_msg("2024-02-01 00:00:00", 0.0), arrival=50)])
    rows = pipeline.observation_rows(pipeline.read_landed(spark, land, files_per_trigger=1))
    out = os.path.join(tmpdir_path, "days")
    for _ in range(2):
        (pipeline.finalized_daily(rows, "20 days").writeStream.outputMode("append").format("parquet").option("path", out)
         .trigger(availableNow=True).option("checkpointLocation", os.path.join(tmpdir_path, "ck")).start().awaitTermination())
    assert [(str(r.date), float(r.temp_low), float(r.temp_high)) for r in spark.read.parquet(out).collect()] == [("2024-01-02", 3.0, 5.0)]
    with pytest.raises(ValueError, match="arrival"):
        pipeline.finalized_daily(rows.drop("arrival", "landed_file", "epoch"))


def test_messages_are_judged_once_and_days_only_for_the_daily_table(spark, tmpdir_path, monkeypatch):
    tables = {}

    class Recorded(pipeline.Scratch):
        def table(self, df, name, *args):
            tables[name] = df.columns
            return super().table(df, name, *args)
    monkeypatch.setattr(pipeline, "Scratch", Recorded)
    land, obs = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "obs")
    _land(land, "a.json", [_msg("2024-01-10 12:00:00", 5.0), "not json", _msg("2024-01-10 13:00:00", 1e9)])
    _run(spark, land, obs, os.path.join(tmpdir_path, "ck"))
    assert "reason" in tables["messages"] and "touched" not in tables
    assert _temps(spark, obs) == {(10, 12): 5.0}
    reasons = [r.reason for r in spark.read.parquet(pipeline.rejected_path(obs)).orderBy("reason").collect()]
    assert reasons == ["not parsed", "out of range"]
    st = stations_frame(spark, [("P", 48.85, 2.35, "Europe/Paris", "x")])
    daily = os.path.join(tmpdir_path, "daily")
    _run(spark, land, obs + "2", os.path.join(tmpdir_path, "ck2"), daily_path=daily, stations=st)
    assert "touched" in tables and _daily(spark, daily).count() == 1


def test_landed_texts_are_made_by_the_tasks_that_write_them(spark, tmpdir_path):
    from isobar.plans import bindings
    spark.sql("SELECT id AS event_id, id % 7 AS user_id, TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts "
              "FROM range(200)").coalesce(1).write.parquet(f"{tmpdir_path}/events.parquet")
    dealt = bindings.observation_messages(spark, tmpdir_path, with_arrival=True, files=3)
    assert dealt.rdd.getNumPartitions() == 3
    plan = dealt._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("json") < plan.index("repartition")
    whole = bindings.observation_messages(spark, tmpdir_path, with_arrival=True)
    assert sorted(r.value for r in dealt.collect()) == sorted(r.value for r in whole.collect())
