import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from isobar import schemas
from isobar.operators import upsert


def _daily(spark, rows):
    full = []
    for st, day, low, rain in rows:
        vals = [st, day] + [None] * len(schemas.DAILY_MEASURES)
        vals[2 + schemas.DAILY_MEASURES.index("temp_low")] = None if low is None else D(low)
        vals[2 + schemas.DAILY_MEASURES.index("precipitation_sum")] = None if rain is None else D(rain)
        vals[2 + schemas.DAILY_MEASURES.index("temp_high")] = D("9.9")
        full.append(tuple(vals))
    return spark.createDataFrame(full, schemas.DAILY)


T = [("A", dt.date(2020, 1, 1), "1.0", "2.0"), ("A", dt.date(2020, 1, 2), "3.0", "4.0"),
     ("B", dt.date(2021, 1, 1), "5.0", "6.0")]
S = [("A", dt.date(2020, 1, 2), "7.0", None),       # match; NULL rain must win
     ("A", dt.date(2020, 1, 3), "8.0", "1.0")]      # new key


def _get(df):
    return {(r.station, r.date): (r.temp_low, r.precipitation_sum, r.temp_high) for r in df.collect()}


def test_full_upsert_null_wins(spark):
    t, s = _daily(spark, T), _daily(spark, S)
    out = _get(upsert.upsert_table(t, s, schemas.DAILY_KEYS))
    assert out[("A", dt.date(2020, 1, 2))][:2] == (D("7.0"), None)
    assert out[("A", dt.date(2020, 1, 3))][:2] == (D("8.0"), D("1.0"))
    assert out[("B", dt.date(2021, 1, 1))][:2] == (D("5.0"), D("6.0"))
    assert len(out) == 4


def test_partial_fields(spark):
    t = _daily(spark, T)
    s = _daily(spark, S).withColumn("temp_high", F.lit(D("1.1")).cast("decimal(3,1)"))
    out = _get(upsert.upsert_table(t, s, schemas.DAILY_KEYS, fields=["temp_low"]))
    # on a match only temp_low is written
    assert out[("A", dt.date(2020, 1, 2))] == (D("7.0"), D("4.0"), D("9.9"))
    # a new key gets every column
    assert out[("A", dt.date(2020, 1, 3))] == (D("8.0"), D("1.0"), D("1.1"))


def test_unknown_field_raises(spark):
    t, s = _daily(spark, T), _daily(spark, S)
    with pytest.raises(ValueError, match="Invalid fields: nope, other"):
        upsert.upsert(t, s, schemas.DAILY_KEYS, fields=["temp_low", "nope", "other"])


def test_change_set(spark):
    t, s = _daily(spark, T), _daily(spark, S)
    got = {(r.date, r.action, r.changed) for r in upsert.change_set(t, s, schemas.DAILY_KEYS).collect()}
    assert got == {(dt.date(2020, 1, 2), "update", "temp_low,precipitation_sum"),
                   (dt.date(2020, 1, 3), "insert", None)}


def test_write_upsert_is_idempotent_and_keeps_partitions(spark, tmpdir_path):
    path = f"{tmpdir_path}/daily"
    t = _daily(spark, T).withColumn("year", F.year("date"))
    t.write.partitionBy("station", "year").parquet(path)
    s = _daily(spark, S).withColumn("year", F.year("date"))
    for _ in range(2):
        upsert.write_upsert(path, s, schemas.DAILY_KEYS, ["station", "year"])
        got = _get(spark.read.parquet(path))
        assert len(got) == 4
        assert got[("B", dt.date(2021, 1, 1))][:2] == (D("5.0"), D("6.0"))
        assert got[("A", dt.date(2020, 1, 2))][:2] == (D("7.0"), None)


def test_insert_if_absent(spark, tmpdir_path):
    tgt = spark.createDataFrame([("a", 1, 10)], "k string, t int, v int")
    new = spark.createDataFrame([("a", 1, 99, 1), ("a", 2, 20, 3), ("a", 2, 21, 2)],
                                "k string, t int, v int, arrival int")
    got = sorted(tuple(r) for r in upsert.insert_if_absent(tgt, new, ["k", "t"], "arrival").collect())
    assert got == [("a", 2, 21)]
    path = f"{tmpdir_path}/obs"
    tgt.write.parquet(path)
    assert upsert.append_if_absent(path, new, ["k", "t"], order_col="arrival") == 1
    assert upsert.append_if_absent(path, new, ["k", "t"], order_col="arrival") == 0
    assert spark.read.parquet(path).count() == 2
