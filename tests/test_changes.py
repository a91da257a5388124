"""Change files: what they cost, what they read, and that they give the upsert's table."""

import datetime as dt
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import changes, jobs, upsert

KEYS, PARTS = schemas.DAILY_KEYS, jobs.DAILY_PARTITIONS


def rows(spark, stations, days, temp="1.0", **more):
    out = []
    for s in stations:
        for d in days:
            values = {"temp_avg": D(temp)} | more
            out.append((s, d, *[values.get(f.name) for f in schemas.DAILY.fields[2:]]))
    return jobs.by_month(spark.createDataFrame(out, schemas.DAILY))


def listing(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


DAYS = [dt.date(y, m, d) for y in (2020, 2021) for m in (1, 7, 12) for d in range(1, 11)]


@pytest.fixture()
def lake(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "daily")
    jobs.write_daily_lake(rows(spark, [f"S{i:04d}" for i in range(300)], DAYS).drop("year", "month"), path)
    return path


def partitions_read(df):
    """Partitions that the scans of a plan without exchanges listed."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i).metrics().apply("numPartitions").value() for i in range(leaves.size())]


def test_two_far_days_read_two_partitions(spark, lake):
    table = spark.read.parquet(lake)
    batch = rows(spark, ["S0001"], [dt.date(2020, 1, 3), dt.date(2021, 12, 5)])
    assert table.select("year", "month").distinct().count() == 6
    near = upsert.in_partitions(table, batch, PARTS)
    assert partitions_read(near.select("station")) == [2]
    assert near.select("year", "month").distinct().count() == 2
    # December to January is two months, not all of them
    near = upsert.in_partitions(table, rows(spark, ["S0001"], [dt.date(2020, 12, 31), dt.date(2021, 1, 1)]), PARTS)
    assert partitions_read(near.select("station")) == [2]
    # more partitions than may be named: bounds and a join, the same rows
    few = upsert.in_partitions(table, batch, PARTS, limit=1)
    assert few.select("year", "month").distinct().count() == 2
    assert upsert.in_partitions(table, batch.limit(0), PARTS).count() == 0


def test_a_batch_of_one_station_writes_its_own_bytes(spark, lake):
    before = listing(lake)
    batch = rows(spark, ["S0007"], [dt.date(2020, 7, 4)], "9.5")
    changes.write_changes(lake, batch, KEYS, PARTS)
    assert listing(lake) == before
    written = sum(listing(changes.changes_path(lake)).values())
    month = sum(n for f, n in before.items() if "year=2020/month=7/" in f)
    assert written < 12_000 and len(listing(changes.changes_path(lake))) == 1 and month > 0
    got = changes.read_merged(spark, lake, KEYS, PARTS)
    assert got.count() == 300 * len(DAYS)
    assert [(r.station, r.date) for r in got.filter("temp_avg = 9.5").collect()] == [("S0007", dt.date(2020, 7, 4))]
    # the compaction rewrites that month only and leaves no change files
    assert changes.compact(spark, lake, KEYS, PARTS) == 1 and changes.compact(spark, lake, KEYS, PARTS) == 0
    kept = {f for f in before if "year=2020/month=7/" not in f}
    assert kept <= set(listing(lake)) and not listing(changes.changes_path(lake))
    table = spark.read.parquet(lake)
    assert table.count() == 300 * len(DAYS) and table.filter("temp_avg = 9.5").count() == 1


def table_of(spark, lake):
    return sorted(map(str, changes.read_merged(spark, lake, KEYS, PARTS).select(*schemas.DAILY.fieldNames()).collect()))


def test_sequence_fields_replay_and_compaction_against_the_upsert(spark, lake):
    steps = [("a", rows(spark, ["S0001", "NEW"], DAYS[:4], "2.0"), None),
             ("b", rows(spark, ["S0001", "OTHER"], DAYS[2:6], "3.0", humidity_low=7), ["humidity_low"]),
             ("c", rows(spark, ["NEW", "OTHER"], DAYS[3:5], "4.0", humidity_low=None), None)]
    expect = spark.read.parquet(lake)
    for _, batch, fields in steps:
        expect = upsert.upsert_table(expect, batch, KEYS, fields, PARTS)
    want = sorted(map(str, expect.select(*schemas.DAILY.fieldNames()).collect()))
    for name, batch, fields in steps:
        changes.write_changes(lake, batch, KEYS, PARTS, fields, name)
    assert table_of(spark, lake) == want
    # an earlier batch written again stays before the later ones
    changes.write_changes(lake, steps[0][1], KEYS, PARTS, None, "a")
    assert table_of(spark, lake) == want
    changes.compact(spark, lake, KEYS, PARTS)
    assert table_of(spark, lake) == want


def test_a_failed_compaction_can_be_repeated(spark, lake, monkeypatch):
    changes.write_changes(lake, rows(spark, ["S0001"], DAYS[:2], "2.0", humidity_low=3), KEYS, PARTS, ["humidity_low"], "a")
    want = table_of(spark, lake)
    monkeypatch.setattr(changes, "delete_path", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        changes.compact(spark, lake, KEYS, PARTS)
    assert table_of(spark, lake) == want
    monkeypatch.undo()
    assert changes.compact(spark, lake, KEYS, PARTS) == 1
    assert table_of(spark, lake) == want


def test_first_batches_bad_keys_and_no_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "none")
    with pytest.raises(ValueError, match="no table"):
        changes.read_merged(spark, path, KEYS, PARTS)
    batch = rows(spark, ["A"], DAYS[:2])
    undated = batch.withColumn("date", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match="repeated keys"):
        changes.write_changes(path, batch.unionByName(batch), KEYS, PARTS)
    twice = batch.withColumn("n", F.lit(1)).unionByName(
        batch.withColumn("temp_avg", F.lit(D("5.0")).cast(schemas.D31)).withColumn("n", F.lit(2)))
    assert changes.write_changes(path, twice.unionByName(undated.withColumn("n", F.lit(3))), KEYS, PARTS, order_by="n") == 2
    got = changes.read_merged(spark, path, KEYS, PARTS)
    assert sorted(r.temp_avg for r in got.collect()) == [D("5.0")] * 2
    with pytest.raises(ValueError, match="Invalid fields"):
        changes.write_changes(path, batch, KEYS, PARTS, ["nothing"])
    changes.compact(spark, path, KEYS, PARTS)
    assert spark.read.parquet(path).count() == 2
