"""End-to-end maintenance jobs over partitioned parquet tables.

Each job is a handful of DataFrame operations ending in a dynamic partition
overwrite, so re-running it (after a failure, or for a late-data backfill)
rewrites the same partitions with the same rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..config import NormalsJob, periods_frame
from ..session import Scratch, materialize, read_parquet_if_exists
from ..sources.tables import read_daily_lake
from .catalog import save_table
from .common import check_date_range
from .doy import doy_normals_config
from .ingest import map_history
from .official import import_official
from .rollup import daily_rollup_range
from .upsert import change_set, write_partitions, write_upsert

# Year and month directories, rows clustered by station inside: a station-level
# directory split would create millions of tiny files with many stations.
DAILY_PARTITIONS = ["year", "month"]


def today_range(today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """F4 ``-T``: today only (the live, still-changing day)."""
    d = today or _dt.date.today()
    return d, d


def yesterday_range(today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """F4 ``-Y``: yesterday only (the finalised day)."""
    d = (today or _dt.date.today()) - _dt.timedelta(days=1)
    return d, d


def by_month(daily: DataFrame) -> DataFrame:
    """The rows with the partition columns of the daily lake."""
    return daily.withColumn("year", F.year("date")).withColumn("month", F.month("date"))


def write_daily_lake(daily: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The daily table as parquet partitioned by year and month, clustered by station.

    Rows are range-partitioned on (year, month, station) and sorted by (station,
    date): each task writes a contiguous slice, so parquet statistics prune by
    station and date and no task holds a whole year.
    """
    d = by_month(daily)
    if mode == "overwrite":
        write_partitions(d, path, DAILY_PARTITIONS, ["station", "date"])
    else:
        (d.repartitionByRange(*DAILY_PARTITIONS, "station").sortWithinPartitions("station", "date")
         .write.mode(mode).partitionBy(*DAILY_PARTITIONS).parquet(path))


# Lets a join by (station, date) use a table that is bucketed by station alone.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def write_daily_buckets(daily: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """W9 as a catalog table in ``buckets`` buckets by station, sorted by station and date.

    For tables that are mostly read: aggregations by station and more (month statistics, records, days
    of the year) and joins by station and date read the buckets as they lie, without an exchange of the
    table; joins need `CO_PARTITION` set to false. A bucket holds whole stations, so choose so many that
    one fits a task. No partitions by year: each would hold a file per bucket.
    """
    w = daily.select(*[f.name for f in schemas.DAILY.fields]).repartition(buckets, "station") \
        .sortWithinPartitions("station", "date").write.mode("overwrite").bucketBy(buckets, "station").sortBy("station", "date")
    (w.option("path", path) if path else w).saveAsTable(name)


def refresh_days(spark: SparkSession, obs: DataFrame, daily_path: str, start: _dt.date,
                 end: _dt.date, stations: DataFrame, fields: list[str] | None = None,
                 skip_empty: bool = False, today: _dt.date | None = None,
                 dry_run: bool = False) -> DataFrame | None:
    """Entry 1 / T4: roll a date range of observations up and upsert it.

    Every requested day of every station gets a row (J4); days without data
    overwrite with NULLs unless ``skip_empty`` (D16). ``dry_run`` writes nothing
    and returns the change set instead (W4).
    """
    check_date_range(start, end, today)
    days = by_month(daily_rollup_range(obs, stations.select("station"), start, end, stations, today))
    if dry_run:
        target = read_parquet_if_exists(spark, daily_path)
        days = materialize(days, "refresh-days")
        target = target if target is not None else days.limit(0)
        return change_set(target, days, schemas.DAILY_KEYS, fields, DAILY_PARTITIONS, skip_empty)
    write_upsert(daily_path, days, schemas.DAILY_KEYS, DAILY_PARTITIONS, fields, skip_empty)
    return None


def load_official(daily_path: str, rr: DataFrame, other: DataFrame | None = None,
                  stations: list[str] | None = None, years: tuple[int, int] | None = None,
                  mean_fallback: str = "truncate", quality: tuple[int, ...] | None = None) -> int:
    """Official daily rows upserted into the daily table (no SQL text);
    returns the number of rows rejected for a missing station or date."""
    rows = import_official(rr, other, stations, years, mean_fallback, quality)
    return write_upsert(daily_path, by_month(rows), schemas.DAILY_KEYS, DAILY_PARTITIONS)


HISTORY_KEYS = ["station", "date"]


def load_history(history_path: str, messages: DataFrame, station: str | None = None) -> int:
    """Daily-history replies upserted into the history table; returns the rejected rows."""
    return write_upsert(history_path, by_month(map_history(messages, station)), HISTORY_KEYS, DAILY_PARTITIONS)


def load_normals(spark: SparkSession, job: NormalsJob, mode: str = "create",
                 location: str | None = None) -> list[str]:
    """The normals job of a configuration: per period one table of day-of-year normals.

    The configured daily table is read once; every period's rows go to the table
    its name template gives (``create``: only if absent, ``recreate`` or ``append``), its files under
    ``location`` where one is given.
    """
    daily = read_daily_lake(spark, job.source_table)
    names = []
    with Scratch(spark) as scratch:
        rows = scratch.table(doy_normals_config(daily, periods_frame(spark, job.periods), job.crossref), "normals", ["period_id"])
        for p in job.periods:
            name = job.target_name(p)
            save_table(rows.filter(F.col("period_id") == p.period_id).drop("period_id"), name, mode,
                       ["station", "DayOfYear"], f"{location.rstrip('/')}/{name}" if location else None)
            names.append(name)
    return names
