"""Keyed table maintenance without MERGE: dedup, insert-if-absent, upserts.

Plain parquet tables have no MERGE, so an upsert is a keyed full outer join
of the *touched part* of the target with the source, followed by a dynamic
partition overwrite of exactly those partitions. The join carries a
``matched`` flag per row: a source NULL must overwrite a target value, so the
merge cannot be a ``coalesce``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..session import Scratch, read_parquet_if_exists
from .common import validate_fields


def first_arrival(df: DataFrame, keys: list[str], order_col: str | list[str]) -> DataFrame:
    """Keep the earliest arrival per key (ties broken by the further order columns)."""
    order = [order_col] if isinstance(order_col, str) else order_col
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def last_by_key(df: DataFrame, keys: list[str], order_by: str | list[str]) -> DataFrame:
    """One row per key: the last in the given order, as in a row-by-row upsert loop."""
    order = [order_by] if isinstance(order_by, str) else order_by
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is complete; a NULL key can match no stored row."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


# Partitions named one by one in a filter; beyond, their bounds are given.
MAX_PARTITIONS = 2000


def in_partitions(target: DataFrame, source: DataFrame, partition_cols: list[str] | None,
                  limit: int = MAX_PARTITIONS) -> DataFrame:
    """Target rows in the partitions the source has rows in.

    The distinct partition values come to the driver (days or months, at most ``limit``) and
    become literals, so that a scan of the target lists just those partitions. Beyond the limit the
    columns' bounds prune and a join settles the rest. ``source`` should be a written table: it is
    read for the values.
    """
    if not partition_cols:
        return target
    parts = with_keys(source.select(*partition_cols), partition_cols).distinct()
    found = parts.limit(limit + 1).collect()
    if len(found) > limit:
        for c in partition_cols:
            lo, hi = parts.agg(F.min(c), F.max(c)).first()
            target = target.filter(F.col(c).between(F.lit(lo), F.lit(hi)))
        return target.join(parts, partition_cols, "left_semi")
    # values of the last column, per values of those before it
    groups: dict[tuple, list] = {}
    for r in sorted(found):
        groups.setdefault(tuple(r)[:-1], []).append(r[-1])
    cases = [reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(partition_cols, head)]
                    + [F.col(partition_cols[-1]).isin(last)]) for head, last in groups.items()]
    return target.filter(reduce(lambda a, b: a | b, cases) if cases else F.lit(False))


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str],
                     order_col: str | list[str] | None = None,
                     partition_cols: list[str] | None = None) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``target`` (first wins).

    Returns only the rows to append; existing rows are never touched. With
    ``partition_cols`` (present in both frames) only the target partitions the
    new rows fall into are read for the anti join.
    """
    if order_col is not None:
        order = [order_col] if isinstance(order_col, str) else order_col
        new = first_arrival(new, keys, order).drop(*order)
    else:
        new = new.dropDuplicates(keys)
    existing = in_partitions(target, new, partition_cols).select(*keys)
    return new.join(existing, keys, "left_anti")


def _merge_columns(columns: list[str], keys: list[str], fields: list[str] | None):
    """Per-column merge rule.

    * not matched (source only): source value, every column (D17).
    * target only: target value.
    * matched: source value for updated columns (all, or ``fields``),
      target value for the others.
    """
    exprs = []
    for c in columns:
        if c in keys:
            exprs.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
            continue
        in_src = F.col("s._in_src").isNotNull()
        in_tgt = F.col("t._in_tgt").isNotNull()
        take_src = in_src & (~in_tgt | F.lit(fields is None or c in fields))
        exprs.append(F.when(take_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return exprs


def prepared(source: DataFrame, columns: list[str], keys: list[str], partition_cols: list[str] | None = None,
             skip_empty: bool = False, order_by: str | list[str] | None = None) -> DataFrame:
    """The source rows that an upsert applies: complete keys, the last row per key by ``order_by``,
    and with ``skip_empty`` only rows with a measure."""
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns: {', '.join(missing)}")
    src = with_keys(source, keys)
    src = (last_by_key(src, keys, order_by) if order_by else src).select(*columns)
    if skip_empty:
        measures = [c for c in columns if c not in keys and c not in (partition_cols or [])]
        src = src.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in measures]))
    return src


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           fields: list[str] | None = None, partition_cols: list[str] | None = None,
           skip_empty: bool = False, order_by: str | list[str] | None = None) -> DataFrame:
    """Merged rows of the affected part of ``target``.

    Of several source rows with one key the last by ``order_by`` counts; without
    it the keys must be unique (:func:`write_upsert` checks that). Source rows
    with a NULL in the key are rejected.

    ``fields`` restricts the columns written on a match (W3); an unknown
    field raises ``ValueError``. With ``partition_cols`` only the target
    partitions present in the source are read and returned, which is what a
    dynamic partition overwrite must rewrite. ``skip_empty`` keeps stored
    values when a source row has no measure at all (D16 option).
    """
    columns = target.columns
    validate_fields(fields, columns)
    src = prepared(source, columns, keys, partition_cols, skip_empty, order_by)
    tgt = in_partitions(target, src, partition_cols)
    t = tgt.withColumn("_in_tgt", F.lit(True)).alias("t")
    s = src.withColumn("_in_src", F.lit(True)).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    j = t.join(s, cond, "full_outer")
    return j.select(*_merge_columns(columns, keys, fields))


def upsert_table(target: DataFrame, source: DataFrame, keys: list[str],
                 fields: list[str] | None = None, partition_cols: list[str] | None = None,
                 skip_empty: bool = False, order_by: str | list[str] | None = None) -> DataFrame:
    """The whole table after the upsert: untouched partitions plus merged ones."""
    merged = upsert(target, source, keys, fields, partition_cols, skip_empty, order_by)
    if not partition_cols:
        return merged
    parts = with_keys(source, keys).select(*partition_cols).distinct()
    untouched = target.join(parts, partition_cols, "left_anti")
    return untouched.unionByName(merged)


def change_set(target: DataFrame, source: DataFrame, keys: list[str],
               fields: list[str] | None = None,
               partition_cols: list[str] | None = None, skip_empty: bool = False,
               order_by: str | list[str] | None = None) -> DataFrame:
    """W4 dry run: what an upsert would do, per source key; nothing is written.

    The source goes through the same preparation as in :func:`upsert`. ``action`` is ``insert`` for a new key and ``update`` for an existing
    one; ``changed`` lists the written columns whose value differs.
    """
    columns = target.columns
    validate_fields(fields, columns)
    written = [c for c in columns if c not in keys and c not in (partition_cols or [])
               and (fields is None or c in fields)]
    s = prepared(source, columns, keys, partition_cols, skip_empty, order_by)
    t = in_partitions(target, s, partition_cols) \
        .select(*keys, *[F.col(c).alias(f"_t_{c}") for c in written]) \
        .withColumn("_in_tgt", F.lit(True))
    j = s.join(t, keys, "left")
    matched = F.coalesce(F.col("_in_tgt"), F.lit(False))
    diffs = F.filter(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_t_{c}")), F.lit(c))
                               for c in written]), lambda x: x.isNotNull())
    return j.select(*keys,
                    F.when(matched, F.lit("update")).otherwise(F.lit("insert")).alias("action"),
                    F.when(matched, F.array_join(diffs, ",")).alias("changed"))


def write_upsert(target_path: str, source: DataFrame, keys: list[str],
                 partition_cols: list[str], fields: list[str] | None = None,
                 skip_empty: bool = False, order_by: str | list[str] | None = None) -> int:
    """Apply an upsert to a partitioned parquet table in place; returns the
    number of source rows rejected for a NULL in the key.

    Only the partitions the source touches are read (named by literals) and
    rewritten (dynamic partition overwrite). The merged rows are written to
    scratch first so the write never reads the files it is replacing; a retried
    job recomputes the same rows, so the write is idempotent. Repeated source
    keys need ``order_by`` (the last row wins), else they raise.
    """
    spark = source.sparkSession
    clustering = [k for k in keys if k not in partition_cols]
    with Scratch(spark) as scratch:
        src = scratch.table(source, "upsert-source")
        n, complete = src.count(), with_keys(src, keys)
        rejected = n - complete.count()
        if order_by is not None:
            complete = scratch.table(last_by_key(complete, keys, order_by), "upsert-last")
        elif complete.groupBy(*keys).count().filter("count > 1").limit(1).count():
            raise ValueError(f"repeated keys ({', '.join(keys)}) in the source and no order to choose by")
        target = read_parquet_if_exists(spark, target_path)
        if target is None:  # first load: nothing to merge with
            validate_fields(fields, complete.columns)
            order = [order_by] if isinstance(order_by, str) else order_by or []
            columns = [c for c in complete.columns if c in keys or c not in order]
            write_partitions(prepared(complete, columns, keys, partition_cols, skip_empty), target_path, partition_cols, clustering)
        else:
            merged = scratch.table(upsert(target, complete, keys, fields, partition_cols, skip_empty), "upsert")
            write_partitions(merged, target_path, partition_cols, clustering)
    return rejected


def write_partitions(df: DataFrame, path: str, partition_cols: list[str],
                     clustering: list[str]) -> None:
    """Dynamic partition overwrite of the partitions present in ``df``.

    Rows are range-partitioned on (partition columns, first clustering key)
    and sorted by the clustering keys: every task writes a contiguous slice,
    files stay few per partition, and parquet statistics prune on the keys.
    """
    (df.repartitionByRange(*partition_cols, *clustering[:1])
     .sortWithinPartitions(*clustering).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def append_rows(rows: DataFrame, path: str, partition_cols: list[str], clustering: list[str]) -> None:
    """Append to a partitioned table without touching its files."""
    (rows.repartitionByRange(*partition_cols, *clustering[:1]).sortWithinPartitions(*clustering)
     .write.mode("append").partitionBy(*partition_cols).parquet(path))


def append_if_absent(target_path: str, new: DataFrame, keys: list[str],
                     partition_cols: list[str] | None = None,
                     order_col: str | list[str] | None = None) -> int:
    """W1 on a parquet table: append only unseen keys; returns rows appended.

    With ``partition_cols`` only the partitions the new rows fall into are read.
    """
    spark = new.sparkSession
    target = spark.read.parquet(target_path)
    with Scratch(spark) as scratch:
        new = scratch.table(with_keys(new, keys), "append-new")
        rows = scratch.table(insert_if_absent(target, new, keys, order_col, partition_cols), "append")
        n = rows.count()
        if not n:
            return 0
        if partition_cols:
            append_rows(rows, target_path, partition_cols, [k for k in keys if k not in partition_cols])
        else:
            rows.write.mode("append").parquet(target_path)
    return n
