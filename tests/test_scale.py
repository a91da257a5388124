"""What keeps time and memory of a task in proportion to its input."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.config import Period, periods_frame
from isobar.llm import collocations as C
from isobar.operators import doy, normals
from isobar.plans import bindings as B, registry
from isobar.sources import files


@pytest.fixture()
def orders(spark, tmpdir_path):
    spark.range(3000).selectExpr("id AS o_orderkey", "id % 400 AS o_custkey", "date_add(DATE '1995-01-01', CAST(id % 2000 AS INT)) AS o_orderdate") \
        .write.parquet(f"{tmpdir_path}/orders.parquet")
    return tmpdir_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_queries_compile_wide_plans_in_a_plain_session(spark, orders):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        registry.QUERIES["doy_normals_config"](spark, orders)
        assert spark.conf.get(name) == "8000"
    finally:
        spark.conf.set(name, before)


def test_daily_rows_are_made_in_bounded_parts_by_station(spark, orders, monkeypatch):
    whole = sorted(map(str, B.daily(spark, orders).collect()))
    monkeypatch.setattr(B, "DAILY_ROWS", 50)
    daily = B.daily(spark, orders)
    assert daily.rdd.getNumPartitions() == max(60, spark.sparkContext.defaultParallelism)
    # the tasks that read hold no groups: the exchange is below both aggregates
    assert plan(daily).rindex("HashAggregate") < plan(daily).index("Exchange")
    assert sorted(map(str, daily.collect())) == whole


def test_rows_that_lie_by_station_are_not_exchanged_for_days_of_the_year(spark, orders):
    out = doy.doy_normals_fixed(B.daily(spark, orders), periods_frame(spark, [Period(1995, 1997), Period(1996, 1998)]))
    assert plan(out).count("Exchange") == 1


def test_means_are_scaled_by_a_product(spark):
    found = spark.sql("SELECT " + ", ".join(f"{doy._scaled('CAST(-1234567890123 AS BIGINT)', s)} AS s{s}" for s in (0, 1, 5, 9))).first()
    assert [str(x) for x in found] == ["-1234567890123", "-123456789012.3", "-12345678.90123", "-1234.567890123"]


def test_console_export_of_many_stations_in_few_files(spark, tmpdir_path):
    lines = spark.range(600).select(F.concat(F.lit("S"), F.col("id") % 300).alias("station"),
                                    *[F.concat(F.lit(f"{c}-"), "id").alias(c) for c in schemas.CONSOLE_COLUMNS])
    lines.repartition(3, "station").write.option("sep", "\t").option("header", True).option("encoding", "UTF-16LE").csv(f"{tmpdir_path}/export")
    assert len([n for n in os.listdir(f"{tmpdir_path}/export") if n.startswith("part-")]) <= 3
    back = files.read_console_export(spark, f"{tmpdir_path}/export", "UTF-16LE", ["station"])
    assert sorted(map(tuple, back.drop("source_file").collect())) == sorted(map(tuple, lines.collect()))


def test_console_files_has_no_folder_for_each_station(spark, tmpdir_path, monkeypatch):
    spark.range(200).selectExpr("id AS event_id", "id AS user_id", "TIMESTAMP '2024-01-05 10:00:00' AS ts") \
        .write.parquet(f"{tmpdir_path}/events.parquet")
    monkeypatch.setattr(registry, "_root", lambda spark, name: f"{tmpdir_path}/{name}")
    out = registry.QUERIES["console_files"](spark, tmpdir_path)
    assert out.select("station").distinct().count() == 200
    assert not [n for n in os.listdir(f"{tmpdir_path}/console/export") if "=" in n]


def test_stripes_are_sent_in_bounded_batches():
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["de"] * len(texts), "raw": [t.encode() for t in texts]})

    def each(words, vocabulary, lang):
        yield pa.RecordBatch.from_pydict({"w": words[words != 0]})
    sent = list(C._each_stretch([batch], 1 << 20, each))
    assert sum(b.num_rows for b in sent) == 60_000 and max(b.num_rows for b in sent) <= C.ROWS
    # a batch of many texts is several stretches
    calls = []
    list(C._each_stretch([batch], 1000, lambda w, v, x: calls.append(len(w)) or iter(())))
    assert len(calls) > 1 and max(calls) < 61 * C.TEXTS + 1000
    assert all(a.dtype == np.int32 for a in C.word_numbers([b"a b", b"c"], C.Vocabulary()))


def test_months_are_not_dealt_by_year_to_meet_the_periods(spark, orders):
    out = normals.monthly_normals(B.daily(spark, orders), periods_frame(spark, [Period(1995, 1997), Period(1996, 1998)]), sort=False)
    assert "BroadcastHashJoin" in plan(out) and "hashpartitioning(year" not in plan(out)


def test_stored_months_are_dealt_in_bounded_parts(spark, orders, monkeypatch):
    monkeypatch.setattr(normals, "MONTH_ROWS", 100)
    months = normals.month_stats(B.daily(spark, orders))
    stored = normals.stored_months(months)
    n = months.count()
    assert stored.rdd.getNumPartitions() == max(-(-n // 100), spark.sparkContext.defaultParallelism)
    assert plan(normals.year_stats(stored)).count("Exchange") == 1
    assert sorted(map(str, stored.collect())) == sorted(map(str, months.collect()))
