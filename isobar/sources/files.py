"""Typed readers for the landed file formats (batch and streaming).

All readers take an explicit schema (no inference) and read whole
directories, so Spark splits the work by file (and by block where the format
allows it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas


def read_observation_messages(spark: SparkSession, path: str, stream: bool = False,
                              keep_corrupt: bool = False) -> DataFrame:
    """Current-observation JSON messages, one per line or file.

    A line that does not parse stops the job, unless ``keep_corrupt``: then it is
    a row whose ``_corrupt`` column holds its text (NULL in good rows), so that
    the caller can store and count it.
    """
    reader = spark.readStream if stream else spark.read
    if not keep_corrupt:
        return reader.schema(schemas.OBS_MESSAGE).option("mode", "FAILFAST").json(path)
    schema = T.StructType(list(schemas.OBS_MESSAGE.fields) + [T.StructField("_corrupt", T.StringType(), True)])
    return reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_history_messages(spark: SparkSession, path: str) -> DataFrame:
    """Daily-history JSON messages with ``request_date``.

    The date comes from the file's name (``..._<yyyyMMdd>.json``) or its
    folder's; a ``station`` that the landing job adds to the message is kept.
    """
    fields = [f for f in schemas.HIST_MESSAGE.fields if f.name != "station"]
    df = spark.read.schema(T.StructType(fields + [T.StructField("station", T.StringType(), True)])).json(path)
    file = F.col("_metadata.file_path")
    # the last date of the path: in the file's name, else in its folder's
    ymd = F.coalesce(F.nullif(F.regexp_extract(file, r"(\d{8})[^/]*\.json[^/]*$", 1), F.lit("")),
                     F.regexp_extract(file, r"(\d{8})/[^/]*$", 1))
    return df.select("*", F.to_date(F.nullif(ymd, F.lit("")), "yyyyMMdd").alias("request_date"))


def read_console_export(spark: SparkSession, path: str, encoding: str | None = None,
                        front: list[str] | None = None) -> DataFrame:
    """S3: console export, UTF-16, tab separated, one header line.

    With the byte order given (``UTF-16LE`` or ``UTF-16BE``, with or without a mark) lines are found
    by their encoded end, so that a file is read by as many tasks as its size asks for; the mark goes
    with the header. Without it the mark decides per file, which takes one task for each file. The
    file name is kept as ``source_file`` for per-file run grouping. ``front`` names text columns that
    stand before the export's own, as in files that hold many stations.
    """
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in front or []] + list(schemas.CONSOLE_SCHEMA.fields))
    r = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", True).schema(schema)
    if encoding is None:
        df = r.option("encoding", "UTF-16").option("multiLine", True).csv(path)
    elif encoding.upper() in ("UTF-16LE", "UTF-16BE"):
        df = r.option("encoding", encoding.upper()).option("lineSep", "\n").csv(path)
        last = df.columns[-1]
        # lines may end with a carriage return as well
        df = df.withColumn(last, F.rtrim(F.col(last), F.lit("\r")))
    else:
        raise ValueError(f"not a UTF-16 byte order: {encoding}")
    return df.withColumn("source_file", F.input_file_name())


# The station number's column is also printed under this name.
_PRINTED_AS = {"UM_POSTE": "NUM_POSTE"}


def read_by_header(spark: SparkSession, path: str, columns: list[str], required: list[str] | None = None,
                   marker: str = "AAAAMMJJ") -> DataFrame:
    """';' separated text files as string columns, taken by the names of each file's own header.

    A header line is one that holds ``marker``; of repeated names the first counts, columns that
    are not asked for are left out, empty values are NULL. A file without a header, or whose header
    lacks one of the ``required`` columns (all, unless given), stops the job that reads its rows with an
    error naming them.
    """
    text = F.translate("value", "\ufeff\r", "")
    cells = F.transform(F.split(text, ";", -1), lambda x: F.nullif(F.trim(x), F.lit("")))
    lines = spark.read.text(path).select(cells.alias("cells"), F.col("_metadata.file_path").alias("file"))
    is_header = F.array_contains("cells", marker)
    named = F.transform("cells", lambda x: F.coalesce(
        F.element_at(F.create_map(*[F.lit(n) for kv in _PRINTED_AS.items() for n in kv]), x), x))
    headers = lines.filter(is_header).groupBy("file").agg(F.first(named).alias("names")).select(
        "file", F.array(*[F.array_position("names", c).cast("int") for c in columns]).alias("at"),
        F.array_except(F.array(*[F.lit(c) for c in required or columns]), "names").alias("missing"))
    body = lines.filter(~F.coalesce(is_header, F.lit(False)) & F.exists("cells", lambda x: x.isNotNull())) \
        .join(headers, "file", "left")
    # every value goes through the check, so that no choice of columns leaves it out
    at = F.when(F.col("at").isNull(), F.raise_error(F.concat(F.lit("official file without a header line: "), "file"))) \
        .when(F.size("missing") > 0, F.raise_error(F.concat(
            F.lit("official file lacks columns: "), F.array_join("missing", ", "), F.lit(" in "), "file"))) \
        .otherwise(F.col("at"))
    return body.select("cells", at.alias("at")).select(*[
        F.get("cells", F.nullif(F.get("at", F.lit(i)), F.lit(0)) - 1).alias(c) for i, c in enumerate(columns)])


def read_official_daily(spark: SparkSession, path: str) -> DataFrame:
    """Official daily files (temperature, rain, wind), by each file's header."""
    return read_by_header(spark, path, schemas.OFFICIAL_RR_COLUMNS)


def read_official_other(spark: SparkSession, path: str) -> DataFrame:
    """Second parameter set (pressure, humidity) of the official files, by each file's header."""
    return read_by_header(spark, path, schemas.OFFICIAL_OTHER_COLUMNS)


def read_official_combined(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Combined wide files (date first, two column blocks).

    The second block repeats ``NUM_POSTE NOM_USUEL LAT LON ALTI``; the first of repeated names
    counts, and a measure that a file does not have is NULL. The halves come back as the two inputs
    of :func:`isobar.operators.official.import_official`.
    """
    keys = ["NUM_POSTE", "AAAAMMJJ"]
    return (read_by_header(spark, path, schemas.OFFICIAL_RR_COLUMNS, keys),
            read_by_header(spark, path, schemas.OFFICIAL_OTHER_COLUMNS, keys))


def read_statistics_document(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Statistics documents, one JSON object per file, or one per line."""
    return spark.read.option("multiLine", not lines).json(path)
