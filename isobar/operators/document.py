"""Statistics documents: build, flatten to (metric, value), describe, write.

A document is one JSON object per (station, period): ``_comments``, the
period metrics in document order, then one object per month. It is built
with ``to_json`` on executors; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..config import DAY_COUNT_METRICS, METRIC_DESCRIPTIONS, MONTH_NAMES, RECORD_METRICS

MEAN_FIELDS = ["Avg_TempAvg", "Avg_TempHigh", "Avg_TempLow", "Yearly_Avg_Precipitation"]
# Document order of the period metrics (means, records, day counts).
PERIOD_FIELDS = (MEAN_FIELDS[:3] + ["Yearly_Avg_Precipitation", "Max_Daily_Precipitation",
                                    "Avg_Daily_Precipitation"]
                 + [m.name for m in RECORD_METRICS if m.name != "Max_Daily_Precipitation"]
                 + [m.name for m in DAY_COUNT_METRICS])


def descriptions_frame(spark: SparkSession) -> DataFrame:
    """Metric name -> description, as a small DataFrame."""
    rows = list(METRIC_DESCRIPTIONS.items())
    return spark.createDataFrame(rows, "metric string, description string")


def _comments_map() -> Column:
    return F.create_map(*[x for k, v in METRIC_DESCRIPTIONS.items() for x in (F.lit(k), F.lit(v))])


def build_documents(daily: DataFrame, periods: DataFrame) -> DataFrame:
    """Period summary and monthly normals from one shared month aggregate.

    The month-level statistics (stations x years x 12 rows, whatever the size
    of ``daily``) feed two outputs; they are checkpointed to the shared
    checkpoint folder so the daily table is scanned once, not per output.
    """
    from . import normals
    months = normals.stored_months(normals.month_stats(daily, years=normals.year_span(periods) or normals.NO_YEARS))
    return statistics_documents(normals.period_summary(daily, periods, months=months),
                                normals.monthly_normals(daily, periods, sort=False, months=months))


def month_struct(monthly: DataFrame) -> DataFrame:
    """Monthly normals rows -> one row per (station, period) with 12 struct fields."""
    body = F.struct(
        F.col("Avg_TempAvg"), F.col("Avg_TempHigh"), F.col("Avg_TempLow"),
        F.struct(F.col("Max_TempHigh_Max").alias("Max"), F.col("Max_TempHigh_Min").alias("Min"))
        .alias("Max_TempHigh"),
        F.struct(F.col("Min_TempLow_Max").alias("Max"), F.col("Min_TempLow_Min").alias("Min"))
        .alias("Min_TempLow"),
        F.col("Avg_Monthly_Precipitation"), F.col("Avg_Days_Precipitation_1"))
    aggs = [F.first(F.when(F.col("month") == i + 1, body), ignorenulls=True).alias(name)
            for i, name in enumerate(MONTH_NAMES)]
    return monthly.groupBy("station", "period_id").agg(*aggs)


def statistics_documents(summary: DataFrame, monthly: DataFrame) -> DataFrame:
    """(station, period_id, doc) with ``doc`` the nested struct.

    The month objects are merged after the period metrics; their keys are
    month names and never collide with metric names, so the right-wins
    merge of the two objects is a plain concatenation of fields.
    """
    months = month_struct(monthly)
    joined = summary.join(months, ["station", "period_id"], "left")
    doc = F.struct(_comments_map().alias("_comments"),
                   *[F.col(f) for f in PERIOD_FIELDS],
                   *[F.col(m) for m in MONTH_NAMES])
    return joined.select("station", "period_id", doc.alias("doc"))


def document_json(docs: DataFrame) -> DataFrame:
    return docs.select("station", "period_id", F.to_json("doc").alias("json"))


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON text file per (station, period) under ``station=/period_id=``."""
    (document_json(docs).repartition("station", "period_id").write.mode("overwrite")
     .partitionBy("station", "period_id").text(path))


def write_document_lines(docs: DataFrame, path: str) -> None:
    """The documents as JSON lines with their station, in one folder per period:
    for many stations, where a file per document would be too many files."""
    line = F.to_json(F.struct("station", "doc.*")).alias("json")
    (docs.select("period_id", "station", line).repartitionByRange("period_id", "station")
     .select("period_id", "json").write.mode("overwrite").partitionBy("period_id").text(path))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _leaves(dtype: T.DataType, ref: str, key: str, sep: str) -> list[str]:
    """SQL for the (metric, value) arrays of one field, recursing like flatten_dict.

    Nested structs are walked, map entries become ``<key><sep><map key>``,
    arrays stay whole as JSON text, scalars are cast to text.
    """
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            k = f"{key}{sep}{f.name}" if key else f.name
            out.extend(_leaves(f.dataType, f"{ref}.{_q(f.name)}", k, sep))
        return out
    if isinstance(dtype, T.MapType):
        return [f"transform(map_entries({ref}), e -> named_struct('metric', "
                f"concat({_lit(key + sep)}, e.key), 'value', CAST(e.value AS STRING)))"]
    val = f"to_json({ref})" if isinstance(dtype, T.ArrayType) else f"CAST({ref} AS STRING)"
    return [f"named_struct('metric', {_lit(key)}, 'value', {val})"]


def flatten_document(docs: DataFrame, sep: str = "_") -> DataFrame:
    """Nested document -> (metric, value) rows; lists stay whole (JSON).

    The whole walk is one generated SQL expression (one parse, one analysis)
    rather than hundreds of Column calls.
    """
    parts = _leaves(docs.schema["doc"].dataType, "doc", "", sep)
    scalars = [p for p in parts if p.startswith("named_struct")]
    arrays = [p for p in parts if not p.startswith("named_struct")]
    expr = "concat(" + ", ".join([f"array({', '.join(scalars)})"] + arrays) + ")"
    return docs.select("station", "period_id", F.explode(F.expr(expr)).alias("kv")) \
        .select("station", "period_id", F.col("kv.metric").alias("metric"),
                F.col("kv.value").alias("value"))


def describe(flat: DataFrame) -> DataFrame:
    """Attach the metric description (P23) where one exists."""
    desc = descriptions_frame(flat.sparkSession)
    return flat.join(desc, "metric", "left")
