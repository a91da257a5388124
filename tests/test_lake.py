"""Normals and upserts on the partitioned lake, keys, files and job shapes."""

import datetime as dt
import json
import os
from decimal import Decimal as D

import pytest

from isobar import schemas, session
from isobar.config import Period, load_normals_config, load_station_config, periods_frame
from isobar.operators import catalog, doy, ingest, jobs, normals, upsert
from isobar.sources import files, tables


def daily_rows(spark, years=(2001, 2002, 2003), station="A"):
    rows = []
    for y in years:
        for m in (1, 2, 7):
            for d in (1, 2, 28):
                t = D(y - 2000) + D(m) / 10
                rows.append((station, dt.date(y, m, d), t, t + 5, t - 5) + (None,) * 11 + (D("1.0"), None))
    return spark.createDataFrame(rows, schemas.DAILY)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lake(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "lake")
    jobs.write_daily_lake(daily_rows(spark, range(1991, 2011)), path)
    return path


def test_normals_on_the_lake_equal_those_of_the_rows(spark, lake):
    periods = periods_frame(spark, [Period(2001, 2003), Period(2002, 2005)])
    stored, plain = tables.read_daily_lake(spark, lake), tables.read_daily(spark, lake)
    for f in (normals.period_means, normals.day_counts, normals.records, normals.period_summary,
              normals.monthly_normals, doy.doy_normals_fixed):
        a, b = f(stored, periods), f(plain, periods)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    top = {r.period_id: r.Max_TempHigh for r in normals.records(stored, periods).collect()}
    assert [e.Date for e in top["2001_2003"]] == ["2003-07-01", "2003-07-02", "2003-07-28"]


def test_period_queries_prune_years(spark, lake):
    periods = periods_frame(spark, [Period(2001, 2001)])
    stored = tables.read_daily_lake(spark, lake)
    for df in (normals.period_means(stored, periods), normals.records(stored, periods),
               normals.monthly_normals(stored, periods), doy.doy_normals_fixed(stored, periods),
               doy.doy_normals_config(stored, periods, load_normals_config().crossref)):
        text = plan(df)
        assert ">= 2001)" in text.split("PartitionFilters:")[1] and "<= 2001)" in text.split("PartitionFilters:")[1]


def test_upserts_prune_and_keep_other_files(spark, lake):
    src = jobs.by_month(daily_rows(spark, [2005], "B"))
    t = spark.read.parquet(lake)
    text = plan(upsert.upsert(t, src, schemas.DAILY_KEYS, None, jobs.DAILY_PARTITIONS))
    assert "year#" in text.split("PartitionFilters:")[1] and "= 2005)" in text.split("PartitionFilters:")[1]
    before = {f for d, _, fs in os.walk(lake) for f in fs if "year=2005" not in d}
    upsert.write_upsert(lake, src, schemas.DAILY_KEYS, jobs.DAILY_PARTITIONS)
    assert before == {f for d, _, fs in os.walk(lake) for f in fs if "year=2005" not in d}
    assert spark.read.parquet(lake).count() == 20 * 9 + 9


def test_repeated_and_null_keys(spark, lake):
    src = jobs.by_month(daily_rows(spark, [2005]))
    twice = src.unionByName(src)
    with pytest.raises(ValueError, match="repeated keys"):
        upsert.write_upsert(lake, twice, schemas.DAILY_KEYS, jobs.DAILY_PARTITIONS)
    from pyspark.sql import functions as F
    rows = src.withColumn("seq", F.lit(2)).unionByName(
        src.withColumn("temp_avg", F.lit(D("-9.0")).cast(schemas.D31)).withColumn("seq", F.lit(1))).unionByName(
        src.withColumn("date", F.lit(None).cast("date")).withColumn("seq", F.lit(3)))
    for _ in range(2):
        assert upsert.write_upsert(lake, rows, schemas.DAILY_KEYS, jobs.DAILY_PARTITIONS, order_by="seq") == 9
        out = spark.read.parquet(lake)
        assert out.count() == 180 and out.filter("date IS NULL").count() == 0
        assert out.filter("year = 2005 AND temp_avg < 0").count() == 0


def test_append_if_absent_reads_its_partitions(spark, lake):
    new = jobs.by_month(daily_rows(spark, [2003, 2011]))
    assert upsert.append_if_absent(lake, new, schemas.DAILY_KEYS, jobs.DAILY_PARTITIONS) == 9
    assert upsert.append_if_absent(lake, new, schemas.DAILY_KEYS, jobs.DAILY_PARTITIONS) == 0
    rows = upsert.insert_if_absent(spark.read.parquet(lake), new.filter("year = 2003"), schemas.DAILY_KEYS, None,
                                   jobs.DAILY_PARTITIONS)
    assert "= 2003)" in plan(rows).split("PartitionFilters:")[1]


def test_combined_official_file_keeps_rows_and_headers(spark, tmpdir_path):
    left = ["AAAAMMJJ", "NUM_POSTE", "NOM_USUEL", "RR", "TN"]
    right = ["NUM_POSTE", "PMERM", "PMERMIN", "UN", "UX", "UM"]
    with open(os.path.join(tmpdir_path, "a.csv"), "w") as f:
        f.write(";".join(left + right) + "\n")
        f.write("20200101;1;X;0.5;1.0;1;1010;1000;10;20;15\n")
        f.write(";1;X;9.9;1.0;1;1010;1000;10;20;15\n")
    with open(os.path.join(tmpdir_path, "b.csv"), "w") as f:
        f.write(";".join(["AAAAMMJJ", "NUM_POSTE", "TN", "RR"] + right[1:]) + "\n")
        f.write("20200102;2;3.0;0.7;1011;1001;11;21;16\n")
    rr, other = files.read_official_combined(spark, tmpdir_path)
    assert sorted((r.AAAAMMJJ or "", r.NUM_POSTE, r.RR, r.TN) for r in rr.collect()) == [
        ("", "1", "9.9", "1.0"), ("20200101", "1", "0.5", "1.0"), ("20200102", "2", "0.7", "3.0")]
    assert sorted(r.PMERM for r in other.collect()) == ["1010", "1010", "1011"]


def test_unparsable_messages(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "m.json")
    with open(p, "w") as f:
        f.write('{"observations": []}\n{"observations": [x\n')
    kept = files.read_observation_messages(spark, p, keep_corrupt=True).cache()
    assert kept.count() == 2 and kept.filter("_corrupt IS NOT NULL").count() == 1
    with pytest.raises(Exception):
        files.read_observation_messages(spark, p).collect()


def test_history_date_from_file_and_folder(spark, tmpdir_path):
    for name in ("hist_20240105.json", "d20240106/part-0.json"):
        p = os.path.join(tmpdir_path, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write('{"observations": [{"humidityHigh": 5}]}')
    got = {str(r.request_date) for r in files.read_history_messages(
        spark, os.path.join(tmpdir_path, "hist_20240105.json")).collect()}
    got |= {str(r.request_date) for r in files.read_history_messages(spark, os.path.join(tmpdir_path, "d20240106")).collect()}
    assert got == {"2024-01-05", "2024-01-06"}


@pytest.mark.parametrize("lines", [1, 2, 3, 100])
def test_runs_of_a_long_file_are_stitched(spark, lines):
    days = [1, 1, 2, 2, 2, 1, 3, 3, None, None, 3, 3, 4]
    rows = [("S", "f", i, dt.date(2024, 1, d) if d else None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "station string, source_file string, No long, date date")
    got = [r.run for r in ingest.console_runs(df, ["station", "source_file"], lines).orderBy("No").collect()]
    want, run, last = [], 0, "none"
    for d in days:
        run, last = (run, last) if d == last else (run + 1, d)
        want.append(run)
    assert got == want


def test_console_lines_keep_their_station(spark, tmpdir_path):
    df = spark.createDataFrame([("S1", dt.date(2024, 1, 2), "b"), ("S1", dt.date(2024, 1, 1), "a"),
                                ("S2", dt.date(2024, 1, 1), "c")], "station string, date date, line string")
    path = os.path.join(tmpdir_path, "stats")
    ingest.write_console_stats(df, path)
    got = {(r.station, r.value) for r in spark.read.text(path).collect()}
    assert got == {("S1", "a"), ("S1", "b"), ("S2", "c")}


def test_console_lines_of_many_stations_in_few_files(spark, tmpdir_path):
    from pyspark.sql import functions as F
    df = spark.range(5000).select(F.concat(F.lit("S"), F.col("id")).alias("station"), F.lit("2024-01-01").cast("date").alias("date"),
                                  F.concat(F.lit('1;2,5;"q"'), F.col("id")).alias("line"))
    path = os.path.join(tmpdir_path, "lines")
    ingest.write_console_lines(df, path)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) <= 8
    got = ingest.read_console_lines(spark, path)
    assert got.filter("source_file IS NOT NULL").count() == 0
    assert sorted(map(tuple, got.select("station", "line").collect())) == sorted((f"S{i}", f'1;2,5;"q"{i}') for i in range(5000))


def test_registry_and_job_files_in_both_shapes(spark, tmpdir_path):
    e = {"a": {"weatherStation": "W1", "latitude": 1.0, "longitude": 2.0, "timezone": "UTC"},
         "b": {"latitude": 3.0, "longitude": 4.0, "timezone": "Europe/Paris", "other": [1]}}
    for name, body in (("flat.json", e), ("nested.json", {"dbConfigs": e, "x": 1})):
        p = os.path.join(tmpdir_path, name)
        with open(p, "w") as f:
            json.dump(body, f)
        assert {tuple(r) for r in tables.stations_from_json(spark, p).collect()} == {
            ("W1", 1.0, 2.0, "UTC", "a"), ("b", 3.0, 4.0, "Europe/Paris", "b")}
        assert load_station_config(p, "a")["weatherStation"] == "W1"
        with pytest.raises(ValueError):
            load_station_config(p, "c")
    p = os.path.join(tmpdir_path, "job.json")
    with open(p, "w") as f:
        json.dump({"source_db": {"host": "h", "database": "raw", "table": "weather"},
                   "destination_db": {"database": "out", "table": "n_<year_start>"},
                   "period": {"start_year": 2001, "end_year": 2003}, "crossref": {"X": "MAX(AvgTemp)"}}, f)
    job = load_normals_config(p)
    assert (job.source_table, job.target_name(job.periods[0])) == ("raw.weather", "out.n_2001")


def test_save_table_keys(spark):
    name = "isobar_test_save_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    catalog.save_table(df, name, "append", ["k"])          # absent: created
    with pytest.raises(ValueError, match="exists"):
        catalog.save_table(df, name, "create", ["k"])
    with pytest.raises(ValueError, match="duplicate"):
        catalog.save_table(df.limit(1), name, "append", ["k"])
    new = spark.createDataFrame([(3, "c"), (3, "d")], "k int, v string")
    with pytest.raises(ValueError, match="duplicate"):
        catalog.save_table(new, name, "append", ["k"])
    with pytest.raises(ValueError, match="NULL"):
        catalog.save_table(spark.createDataFrame([(None, "c")], "k int, v string"), name, "append", ["k"])
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_quality_codes(spark):
    from isobar.operators.official import import_official
    cols = schemas.OFFICIAL_RR_COLUMNS
    base = {"NUM_POSTE": "1", "NOM_USUEL": "X", "AAAAMMJJ": "20200101", "RR": "1.0", "TN": "1", "TX": "2", "TM": "1.5"}
    rows = [tuple((base | {"QRR": q, "AAAAMMJJ": f"2020010{i}"}).get(c) for c in cols) for i, q in enumerate("129", 1)]
    rr = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    assert import_official(rr).count() == 3
    assert sorted(r.date.day for r in import_official(rr, quality=(0, 1, 9)).collect()) == [1, 3]


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def getConf(self):
            return self
    fake = type("S", (), {"conf": Conf(), "sparkContext": type("C", (), {
        "master": "spark://x:7077", "getConf": lambda self: Conf()})()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)
