"""Table discovery and consolidation."""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def discover_tables(spark: SparkSession, pattern: str, databases: str | None = None) -> list[str]:
    """Catalog tables/views whose name matches a glob; none is an error.

    With ``databases``, a glob too, the tables of all matching databases, as ``database.table``;
    else those of the current one. ``_`` is matched literally (unlike a SQL LIKE pattern).
    """
    def fits(name, glob):
        return fnmatch.fnmatchcase(name.lower(), glob.lower())
    if databases is None:
        names = sorted(t.name for t in spark.catalog.listTables() if fits(t.name, pattern))
    else:
        names = sorted(f"{d.name}.{t.name}" for d in spark.catalog.listDatabases() if fits(d.name, databases)
                       for t in spark.catalog.listTables(d.name) if not t.isTemporary and fits(t.name, pattern))
    if not names:
        raise ValueError(f"no table matches {pattern!r}" + (f" in {databases!r}" if databases else ""))
    return names


def consolidate(spark: SparkSession, names: list[str], prefix: str | None = None) -> DataFrame:
    """Union of same-shaped tables with their source name.

    The source name is ``prefix`` and the table's name; without a prefix a table of another
    database (``database.table``) has the database's name and ``_`` before its own. The list comes
    from the catalog (a handful of tables), so the driver-side ``reduce`` builds one Union node, not
    a data loop.
    """
    def source(name):
        database, _, table = name.rpartition(".")
        return prefix + table if prefix is not None else f"{database}_{table}" if database else table
    parts = [spark.table(n).withColumn("source_table", F.lit(source(n))) for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def save_table(df: DataFrame, name: str, mode: str = "create", keys: list[str] | None = None,
               path: str | None = None) -> None:
    """``create`` (only where absent, else an error), ``recreate`` (overwrite) or
    ``append`` (creates the table where absent). ``keys`` is the primary key: it
    must be complete and unique in the new rows, and new to the stored ones.
    ``path`` keeps the table's files there instead of in the warehouse.
    """
    spark = df.sparkSession
    if mode not in ("create", "recreate", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    exists = spark.catalog.tableExists(name)
    if mode == "create" and exists:
        raise ValueError(f"table {name} exists")
    if keys:
        if df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).limit(1).count():
            raise ValueError(f"NULL in the key of {name}: {', '.join(keys)}")
        twice = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
        if not twice and mode == "append" and exists:
            twice = df.select(*keys).join(spark.table(name).select(*keys), keys, "left_semi").limit(1).count()
        if twice:
            raise ValueError(f"duplicate key in {name}: {', '.join(keys)}")
    w = df.write.option("path", path) if path else df.write
    w.mode({"create": "errorifexists", "recreate": "overwrite", "append": "append"}[mode]).saveAsTable(name)
