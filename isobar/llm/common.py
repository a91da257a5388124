"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isobar.session import scratch_path

# A word is a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL and for texts of white space only."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key without NULLs that keeps NULL and '' apart."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def packed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder, with zstd: for tables of texts."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    The package's sources (some 100 KB) are sent through Spark's own file
    distribution, once per application.
    """
    sc = spark.sparkContext
    if getattr(sc, "_isobar_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="isobar-py-")) / "isobar_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._isobar_shipped = True
