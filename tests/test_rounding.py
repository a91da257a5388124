from decimal import Decimal
from decimal import Decimal as D

from pyspark.sql import functions as F

from isobar.functions.rounding import (exact_mean_col, ratio_half_even_int, ratio_half_up,
                                       truncate_toward_zero)


def test_exact_mean_avoids_double_rounding(spark):
    # 1.0 x2 + 1.1 x1 ... mean 1.0499999.. must round to 1.0, not 1.1
    vals = [Decimal("1.0")] * 9999 + [Decimal("1.1")] * 4999 + [Decimal("1.0")] * 1
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(3,1)")
    exact = sum(vals) / len(vals)
    got = df.agg(exact_mean_col("x", 1, 1, "DECIMAL(3, 1)").alias("m")).first()["m"]
    assert got == Decimal(str(exact.quantize(Decimal("0.1"), rounding="ROUND_HALF_UP")))


def test_half_up_and_half_even(spark):
    df = spark.createDataFrame([(5, 2), (7, 2), (3, 2), (1, 0)], "n long, d long")
    out = df.select(ratio_half_even_int(F.col("n"), F.col("d")).alias("e"),
                    ratio_half_up(F.col("n"), F.col("d"), 0).alias("u")).collect()
    assert [r.e for r in out] == [2, 4, 2, None]
    assert [r.u for r in out][:3] == [3, 4, 2]


def test_truncation_toward_zero(spark):
    df = spark.createDataFrame([("-0.25",), ("0.45",), ("-3.99",), ("7.0",)], "x string")
    got = [r.t for r in df.select(truncate_toward_zero(F.col("x").cast("decimal(8,2)")).alias("t")).collect()]
    assert got == [Decimal("-0.2"), Decimal("0.4"), Decimal("-3.9"), Decimal("7.0")]


def test_exact_mean_negative_and_integer(spark):
    df = spark.createDataFrame([(D("-0.1"),), (D("-0.2"),)], "x decimal(3,1)")
    # mean -0.15 rounds half away from zero to -0.2
    assert df.agg(exact_mean_col("x", 1, 1, "DECIMAL(3, 1)").alias("m")).first().m == D("-0.2")
    h = spark.createDataFrame([(50,), (51,)], "h int")
    assert h.agg(exact_mean_col("h", 0, 0, "INT").alias("m")).first().m == 51
