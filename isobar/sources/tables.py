"""Table sources: catalog tables, parquet paths, JDBC, configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A catalog table name, or a path (parquet) when it contains '/'."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """An observation or daily table kept in a SQL database.

    Give ``partition_column``/bounds so the read is split into parallel
    range queries instead of one connection pulling the whole table.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", partitions or 8))
    return r.load()


def read_daily(spark: SparkSession, source: str) -> DataFrame:
    """The daily table by column name (never by position), typed as DDL."""
    df = read_table(spark, source)
    missing = [f.name for f in schemas.DAILY.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"daily table lacks columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.DAILY.fields])


def read_daily_lake(spark: SparkSession, source: str) -> DataFrame:
    """The daily table with its partition columns, so that year filters prune."""
    df = read_table(spark, source)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.DAILY.fields],
                     *[c for c in ("year", "month") if c in df.columns])


def read_observations(spark: SparkSession, source: str) -> DataFrame:
    """The observation table by column name, typed as DDL."""
    df = read_table(spark, source)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in schemas.OBSERVATIONS.fields])


def stations_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Station registry file as a ``stations`` DataFrame, one row per entry.

    The entries ``{weatherStation, latitude, longitude, timezone, ...}`` stand
    under ``dbConfigs``, or at the top level. Any keys, any entry order: the
    registry is parsed as a map of structs.
    """
    entry = "struct<weatherStation:string, latitude:double, longitude:double, timezone:string>"
    text = spark.read.option("wholetext", True).text(path)
    top = F.from_json("value", f"struct<dbConfigs:map<string, {entry}>>")["dbConfigs"]
    entries = F.coalesce(top, F.from_json("value", f"map<string, {entry}>"))
    e = text.select(F.explode(entries).alias("key", "v"))
    return e.select(F.coalesce("v.weatherStation", "key").alias("station"), F.col("v.latitude").alias("lat"),
                    F.col("v.longitude").alias("lon"), F.col("v.timezone").alias("tz"), F.col("key").alias("region"))
