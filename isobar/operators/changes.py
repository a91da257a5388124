"""Change files of a partitioned table: appended per batch, read merged, compacted now and then.

An upsert that rewrites the partitions it touches writes a month of all stations for a batch of
one. Here a batch writes its own rows only, as files beside the table::

    <table>/year=/month=/...                            the compacted rows
    <table>_changes/seq=<number>_<batch>/year=/month=/  one folder per batch

``read_merged`` gives the table as it stands: of the batches' rows with one key the last by
sequence counts, per column for batches that wrote some fields only (a key's first row writes all
its columns). Only keys with changes are merged; the other rows pass by a join against the changed
keys, which are few between two compactions. ``compact`` writes the merged rows of the partitions
that have changes and deletes the folders it took in; it may be repeated after a failure, as
merging a change twice gives the same rows. A batch that is written again under its name replaces
its own folder. One writer at a time, as for the table itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import Scratch, delete_path, list_folder, read_parquet_if_exists
from .common import validate_fields
from .upsert import in_partitions, prepared, with_keys, write_partitions

FIELDS = "_fields"


def changes_path(path: str) -> str:
    return path.rstrip("/") + "_changes"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches' folders, in sequence."""
    return sorted(n for n in list_folder(spark, changes_path(path)) if n.startswith("seq="))


def write_changes(path: str, source: DataFrame, keys: list[str], partition_cols: list[str],
                  fields: list[str] | None = None, batch: str | None = None, skip_empty: bool = False,
                  order_by: str | list[str] | None = None) -> int:
    """W2/W3 as a change batch; returns the number of rows rejected for a NULL in the key.

    ``batch`` names the batch: written again, it replaces its folder and keeps its place in the
    sequence. Repeated source keys need ``order_by``, else they raise. The table is not read.
    """
    spark = source.sparkSession
    order = [order_by] if isinstance(order_by, str) else order_by or []
    columns = [c for c in source.columns if c in keys or c not in order]
    validate_fields(fields, columns)
    batch = batch or uuid.uuid4().hex[:12]
    known = _folders(spark, path)
    folder = next((n for n in known if n.split("_", 1)[1] == batch), None)
    if folder is None:
        last = int(known[-1][4:].split("_")[0]) if known else 0
        folder = f"seq={last + 1:012d}_{batch}"
    with Scratch(spark) as scratch:
        src = scratch.table(source, "changes-source")
        rejected = src.count() - with_keys(src, keys).count()
        if not order and with_keys(src, keys).groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError(f"repeated keys ({', '.join(keys)}) in the source and no order to choose by")
        rows = prepared(src, columns, keys, partition_cols, skip_empty, order_by)
        names = F.array(*[F.lit(c) for c in fields]) if fields is not None else F.lit(None).cast("array<string>")
        clustering = [k for k in keys if k not in partition_cols]
        (rows.withColumn(FIELDS, names).repartitionByRange(*partition_cols, *clustering[:1]).sortWithinPartitions(*clustering)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_cols)
         .parquet(f"{changes_path(path)}/{folder}"))
    return rejected


def _read_changes(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    return spark.read.option("basePath", changes_path(path)).parquet(*[f"{changes_path(path)}/{n}" for n in folders])


def merge(stored: DataFrame | None, changes: DataFrame, keys: list[str], partition_cols: list[str]) -> DataFrame:
    """The rows of the changed keys after all changes; ``stored``: their rows in the table."""
    columns = [c for c in changes.columns if c not in (FIELDS, "seq")]
    rows = changes.select(*columns, FIELDS, "seq")
    if stored is not None:
        # before every sequence
        rows = stored.select(*columns, F.lit(None).cast("array<string>").alias(FIELDS), F.lit("").alias("seq")).unionByName(rows)
    # partition columns follow from the key
    fixed = keys + [c for c in partition_cols if c not in keys]
    rows = rows.withColumn("_first", F.min("seq").over(Window.partitionBy(*fixed)))

    def last(c):
        writes = F.col(FIELDS).isNull() | F.array_contains(FIELDS, c) | (F.col("seq") == F.col("_first"))
        return F.max_by(F.struct(c), F.when(writes, F.col("seq")))[c].alias(c)
    return rows.groupBy(*fixed).agg(*[last(c) for c in columns if c not in fixed]).select(*columns)


def read_merged(spark: SparkSession, path: str, keys: list[str], partition_cols: list[str]) -> DataFrame:
    """The table with all change batches applied."""
    table, folders = read_parquet_if_exists(spark, path), _folders(spark, path)
    if not folders:
        if table is None:
            raise ValueError(f"no table and no changes at {path}")
        return table
    changes = _read_changes(spark, path, folders)
    if table is None:
        return merge(None, changes, keys, partition_cols)
    # the partition columns are part of the join, so that partitions without changes need no keys
    on = partition_cols + [k for k in keys if k not in partition_cols]
    changed = changes.select(*on).distinct()
    merged = merge(table.join(changed, on, "left_semi"), changes, keys, partition_cols)
    return table.join(changed, on, "left_anti").unionByName(merged.select(*table.columns))


def compact(spark: SparkSession, path: str, keys: list[str], partition_cols: list[str]) -> int:
    """Take the change batches into the table; returns how many there were.

    Only partitions with changes are read and rewritten. The folders are deleted after the write.
    """
    folders = _folders(spark, path)
    if not folders:
        return 0
    changes, table = _read_changes(spark, path, folders), read_parquet_if_exists(spark, path)
    clustering = [k for k in keys if k not in partition_cols]
    with Scratch(spark) as scratch:
        if table is None:
            rows = merge(None, changes, keys, partition_cols)
        else:
            near = in_partitions(table, changes, partition_cols)
            on = partition_cols + clustering
            changed = changes.select(*on).distinct()
            rows = near.join(changed, on, "left_anti").unionByName(
                merge(near.join(changed, on, "left_semi"), changes, keys, partition_cols).select(*table.columns))
        # written to scratch first: the write replaces files that the merge reads
        write_partitions(scratch.table(rows, "compact"), path, partition_cols, clustering)
    for n in folders:
        delete_path(spark, f"{changes_path(path)}/{n}")
    return len(folders)
