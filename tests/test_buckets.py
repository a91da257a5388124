"""The daily table in buckets by station: aggregations and joins without an exchange of its rows."""

import datetime as dt
import uuid
from decimal import Decimal as D

import pytest

from isobar import schemas
from isobar.config import Period, periods_frame
from isobar.operators import jobs, normals, upsert
from isobar.sources import tables


def rows(spark, stations, years, temp="1.0"):
    out = [(s, dt.date(y, m, 1), *[D(temp) + m if f.name.startswith("temp") else None for f in schemas.DAILY.fields[2:]])
           for s in stations for y in years for m in range(1, 13)]
    return spark.createDataFrame(out, schemas.DAILY)


@pytest.fixture()
def table(spark, tmpdir_path):
    name = f"daily_{uuid.uuid4().hex[:8]}"
    jobs.write_daily_buckets(rows(spark, [f"S{i}" for i in range(40)], range(2000, 2006)), name, 8, f"{tmpdir_path}/daily")
    old = {k: spark.conf.get(k, None) for k in (jobs.CO_PARTITION, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set(jobs.CO_PARTITION, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def path_to_scans(df, name):
    """For every scan of the table: the operators between it and the plan's root."""
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].split("\n")
    found = []
    for i, line in enumerate(text):
        if name in line and "FileScan" in line:
            depth, above = len(line) - len(line.lstrip(" :+-")), []
            for up in reversed(text[:i]):
                d = len(up) - len(up.lstrip(" :+-"))
                if up.strip() and d < depth:
                    depth, above = d, above + [up.strip(" :+-").split(" ")[0].split("(")[0]]
            found.append(above)
    return found


def test_month_statistics_and_records_exchange_no_daily_rows(spark, table):
    daily = tables.read_daily_lake(spark, table)
    stats = path_to_scans(normals.month_stats(daily), table)
    assert len(stats) == 1 and "Exchange" not in stats[0] and "HashAggregate" in "".join(stats[0])
    periods = periods_frame(spark, [Period(2000, 2003), Period(2002, 2005)])
    for above in path_to_scans(normals.records(daily, periods), table):
        # the rows themselves reach an aggregation or the join with the wanted months first
        first = next(op for op in above if op.startswith(("Exchange", "SortMergeJoin", "HashAggregate", "ObjectHash", "SortAggregate")))
        assert first != "Exchange"
    got = {(r.station, r.period_id): r.Max_TempHigh for r in normals.records(daily, periods).collect()}
    assert len(got) == 80 and all([e.Value for e in v] == ["13.0"] * 4 for v in got.values())


def test_upsert_join_exchanges_the_source_only(spark, table):
    target = tables.read_daily(spark, table)
    source = rows(spark, ["S1", "NEW"], [2005, 2006], "5.0")
    out = upsert.upsert_table(target, source, schemas.DAILY_KEYS)
    assert all("Exchange" not in above for above in path_to_scans(out, table))
    got = {(r.station, r.date.year, r.date.month): r.temp_avg for r in out.collect()}
    assert len(got) == 40 * 72 + 12 + 24 and got["S1", 2005, 3] == D("8.0") and got["S2", 2005, 3] == D("4.0")
