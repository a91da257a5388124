"""Climate normals over reference periods, many stations and periods at once.

Plan shape (the point of this module):

1. One pass over ``daily``, cut to the years of the periods by literal bounds
   on the date and on the year partition: a ``groupBy(station, year, month)``
   with partial aggregation keeps only *sufficient statistics* (sums, counts,
   range counts, monthly extremes). No window over daily rows.
2. Everything after works on month/year rows (stations x years x 12). The
   periods are expanded to (period, year) pairs and joined on ``year``: an
   equi-join instead of a nested-loop range join. Overlapping periods never
   duplicate daily rows, only year summaries.
3. Records join back the days of just those months that reach an extreme.

Semantics follow the executed statistics script: means ignore NULLs and round
half up to 0.1 in exact decimal; yearly totals and day counts are divided by
the number of distinct years that have any row (an all-NULL year counts);
day counts are rounded half to even; records keep every tied date.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..config import DAY_COUNT_METRICS, MONTH_NAMES, RECORD_METRICS, RangeMetric, RecordMetric
from ..functions.rounding import ratio_half_even_int, ratio_half_up
from ..session import materialize
from .common import NO_YEARS, in_years, period_years, year_span

MEAN_COLUMNS = ["temp_avg", "temp_high", "temp_low", "precipitation_sum"]
RAIN = "precipitation_sum"

RECORD_ENTRY = T.ArrayType(T.StructType([
    T.StructField("Date", T.StringType()), T.StructField("Value", T.StringType())]))


def _num(v) -> str:
    """A decimal literal in Spark SQL (unsuffixed decimals parse as DECIMAL)."""
    t = f"{Decimal(str(v)):f}"
    return t if "." in t else t + ".0"


def range_predicate_sql(m: RangeMetric) -> str:
    parts = [f"{m.column} IS NOT NULL"]
    if m.lo is not None:
        parts.append(f"{m.column} {'>=' if m.lo_closed else '>'} {_num(m.lo)}")
    if m.hi is not None:
        parts.append(f"{m.column} {'<=' if m.hi_closed else '<'} {_num(m.hi)}")
    return " AND ".join(parts)


def _dated(daily: DataFrame) -> DataFrame:
    """Daily rows with ``year`` and ``month``; a stored year (partition column) is kept."""
    year = F.col("year").cast("int") if "year" in daily.columns else F.year("date")
    return daily.select(*[c for c in daily.columns if c not in ("year", "month")],
                        year.alias("year"), F.month("date").alias("month"))


def month_stats(daily: DataFrame, ranges: list[RangeMetric] = DAY_COUNT_METRICS,
                records: list[RecordMetric] = RECORD_METRICS,
                years: tuple[int, int] | None = None) -> DataFrame:
    """Sufficient statistics per (station, year, month), one partial aggregation.

    ``years`` (inclusive) cuts the scan by date and year partition.
    """
    d = _dated(in_years(daily, years))
    # aggregate list as SQL text: one parse per expression instead of a
    # chain of Column calls (plan construction stays cheap on the driver)
    aggs = ["count(1) AS n_rows"]
    for c in MEAN_COLUMNS:
        aggs += [f"sum({c}) AS s_{c}", f"count({c}) AS n_{c}"]
    aggs.append(f"coalesce(sum({RAIN}), 0.0) AS rain_total")
    aggs += [f"count_if({range_predicate_sql(m)}) AS c_{m.name}" for m in ranges]
    aggs.append(f"count_if({RAIN} >= 1.0) AS wet1")
    for c in ("temp_high", "temp_low"):
        aggs += [f"max({c}) AS mmax_{c}", f"min({c}) AS mmin_{c}"]
    aggs += [f"{r.kind}({r.column}) AS rv_{r.name}" for r in records]
    return d.groupBy("station", "year", "month").agg(*[F.expr(a) for a in aggs])


# Month rows of one task of what follows from them.
MONTH_ROWS = 50_000


def stored_months(months: DataFrame) -> DataFrame:
    """The month rows written once and dealt by station in parts of a bounded number of rows: the tasks
    that read them hold no groups, and years, periods and months are grouped without another exchange."""
    stored = materialize(months, "month-stats")
    n = max(months.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // MONTH_ROWS))
    return stored.repartition(n, "station")


def year_stats(months: DataFrame, ranges: list[RangeMetric] = DAY_COUNT_METRICS) -> DataFrame:
    """Month rows folded to (station, year); the rows are already tiny."""
    sums = ["n_rows", "rain_total", "wet1"] + [f"s_{c}" for c in MEAN_COLUMNS] + \
        [f"n_{c}" for c in MEAN_COLUMNS] + [f"c_{m.name}" for m in ranges]
    return months.groupBy("station", "year").agg(*[F.expr(f"sum({c}) AS {c}") for c in sums])


def _join_periods(rows: DataFrame, periods: DataFrame) -> DataFrame:
    py = period_years(periods)
    keys = ["year"]
    if "station" in periods.columns:
        keys = ["station", "year"]
    return rows.join(py, keys, "inner")


def _mean(sum_col: str, n_col: str) -> Column:
    return ratio_half_up(F.sum(sum_col), F.sum(n_col), 1).cast(T.DoubleType())


def _mean_aggs() -> list[Column]:
    ny = F.count(F.lit(1))
    return [
        ny.alias("n_years"),
        _mean("s_temp_avg", "n_temp_avg").alias("Avg_TempAvg"),
        _mean("s_temp_high", "n_temp_high").alias("Avg_TempHigh"),
        _mean("s_temp_low", "n_temp_low").alias("Avg_TempLow"),
        ratio_half_up(F.sum("rain_total"), ny, 1).cast(T.DoubleType()).alias("Yearly_Avg_Precipitation"),
        _mean(f"s_{RAIN}", f"n_{RAIN}").alias("Avg_Daily_Precipitation"),
    ]


def _count_aggs(ranges: list[RangeMetric]) -> list[Column]:
    return [F.expr(f"CAST(bround(CAST(sum(c_{m.name}) AS DECIMAL(30, 8)) / "
                   f"CAST(count(1) AS DECIMAL(20, 0)), 0) AS BIGINT) AS {m.name}")
            for m in ranges]


def _years(periods: DataFrame) -> tuple[int, int]:
    """The span that the periods cover; an empty span without periods."""
    return year_span(periods) or NO_YEARS


def _period_years(daily: DataFrame, periods: DataFrame, ranges, months=None) -> DataFrame:
    months = months if months is not None else month_stats(daily, ranges, [], _years(periods))
    return _join_periods(year_stats(months, ranges), periods)


def period_means(daily: DataFrame, periods: DataFrame) -> DataFrame:
    """A5, A7, A17 per (station, period)."""
    return _period_years(daily, periods, []) \
        .groupBy("station", "period_id", "year_start", "year_end").agg(*_mean_aggs())


def day_counts(daily: DataFrame, periods: DataFrame,
               ranges: list[RangeMetric] = DAY_COUNT_METRICS) -> DataFrame:
    """Average days per year in each range, per (station, period)."""
    return _period_years(daily, periods, ranges).groupBy("station", "period_id") \
        .agg(F.count(F.lit(1)).alias("n_years"), *_count_aggs(ranges))


def records(daily: DataFrame, periods: DataFrame,
            metrics: list[RecordMetric] = RECORD_METRICS, months: DataFrame | None = None) -> DataFrame:
    """Each record as ``array<struct<Date, Value>>`` per (station, period).

    Two stages: the extremes come from the month statistics (max and min with
    partial aggregation); then only the days of the months that reach an
    extreme are joined back, and those equal to it are kept, with all ties.
    """
    months = months if months is not None else month_stats(daily, [], metrics, _years(periods))
    keys = ["station", "period_id"]
    rows = _join_periods(months.select("station", "year", "month", *[f"rv_{m.name}" for m in metrics]), periods) \
        .select(*keys, "year", "month", *[f"rv_{m.name}" for m in metrics])
    best = rows.groupBy(*keys).agg(*[F.expr(f"{m.kind}(rv_{m.name}) AS x_{m.name}") for m in metrics])
    reached = F.array_compact(F.array(*[
        F.when(F.col(f"rv_{m.name}") == F.col(f"x_{m.name}"),
               F.struct(F.lit(m.name).alias("metric"), F.col("period_id"),
                        F.col(f"rv_{m.name}").cast(T.StringType()).alias("value"))) for m in metrics]))
    wanted = rows.join(best, keys).select("station", "year", "month", F.explode(reached).alias("r")) \
        .groupBy("station", "year", "month").agg(F.collect_list("r").alias("wanted"))
    of_day = F.lit(None).cast("string")
    for m in metrics:
        of_day = F.when(F.col("w.metric") == m.name, F.col(m.column).cast(T.StringType())).otherwise(of_day)
    days = _dated(in_years(daily, _years(periods))) \
        .select("station", "year", "month", "date", *sorted({m.column for m in metrics})) \
        .join(wanted, ["station", "year", "month"]).withColumn("w", F.explode("wanted")) \
        .filter(of_day == F.col("w.value"))
    entry = F.struct(F.col("date").cast(T.StringType()).alias("Date"), F.col("w.value").alias("Value"))
    found = days.groupBy("station", F.col("w.period_id").alias("period_id")).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("w.metric") == m.name, entry))).alias(m.name) for m in metrics])
    none = F.array().cast(RECORD_ENTRY)
    return best.select(*keys).join(found, keys, "left") \
        .select(*keys, *[F.coalesce(F.col(m.name), none).alias(m.name) for m in metrics])


def records_long(daily: DataFrame, periods: DataFrame,
                 metrics: list[RecordMetric] = RECORD_METRICS) -> DataFrame:
    """A9 exploded: one row per (station, period, metric, date)."""
    r = records(daily, periods, metrics)
    stacked = F.array(*[F.struct(F.lit(m.name).alias("metric"), F.col(m.name).alias("entries"))
                        for m in metrics])
    return (r.select("station", "period_id", F.explode(stacked).alias("m"))
            .select("station", "period_id", F.col("m.metric").alias("metric"),
                    F.explode("m.entries").alias("e"))
            .select("station", "period_id", "metric",
                    F.col("e.Date").alias("Date"), F.col("e.Value").alias("Value")))


def monthly_normals(daily: DataFrame, periods: DataFrame, sort: bool = True,
                    months: DataFrame | None = None) -> DataFrame:
    """One row per (station, period, month) with data, months in order.

    ``months`` may be a :func:`month_stats` frame shared with other outputs
    of the same job, so the daily table is aggregated once.
    """
    months = months if months is not None else month_stats(daily, [], [], _years(periods))
    pm = _join_periods(months, periods)
    ny = F.count(F.lit(1))
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    out = pm.groupBy("station", "period_id", "month").agg(
        _mean("s_temp_avg", "n_temp_avg").alias("Avg_TempAvg"),
        _mean("s_temp_high", "n_temp_high").alias("Avg_TempHigh"),
        _mean("s_temp_low", "n_temp_low").alias("Avg_TempLow"),
        F.max("mmax_temp_high").cast(T.DoubleType()).alias("Max_TempHigh_Max"),
        F.min("mmin_temp_high").cast(T.DoubleType()).alias("Max_TempHigh_Min"),
        F.max("mmax_temp_low").cast(T.DoubleType()).alias("Min_TempLow_Max"),
        F.min("mmin_temp_low").cast(T.DoubleType()).alias("Min_TempLow_Min"),
        ratio_half_up(F.sum("rain_total"), ny, 1).cast(T.DoubleType()).alias("Avg_Monthly_Precipitation"),
        ratio_half_even_int(F.sum("wet1"), ny).alias("Avg_Days_Precipitation_1"),
    )
    out = out.withColumn("month_name", F.element_at(names, F.col("month")))
    return out.orderBy("station", "period_id", "month") if sort else out


def period_summary(daily: DataFrame, periods: DataFrame,
                   ranges: list[RangeMetric] = DAY_COUNT_METRICS,
                   metrics: list[RecordMetric] = RECORD_METRICS,
                   months: DataFrame | None = None) -> DataFrame:
    """One wide row per (station, period): means, records, day counts."""
    if months is None:
        # two branches read the month rows: written once, not aggregated twice
        months = stored_months(month_stats(daily, ranges, metrics, _years(periods)))
    keys = ["station", "period_id"]
    means = _period_years(daily, periods, ranges, months) \
        .groupBy(*keys, "year_start", "year_end").agg(*_mean_aggs(), *_count_aggs(ranges))
    return means.join(records(daily, periods, metrics, months), keys)
