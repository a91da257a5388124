"""Small planning helpers shared by the operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


# A span that holds no year.
NO_YEARS = (2000, 1999)


def period_years(periods: DataFrame) -> DataFrame:
    """One row per (period, year): turns the period range join into an equi-join.

    Its size is the sum of period lengths. Periods of all stations alike are
    a few rows of configuration and broadcast: dealt by year, the rows they are
    joined with would be as many tasks as there are years. For periods by
    station the engine decides by the measured size.
    """
    rows = _period_years(periods)
    return rows if "station" in periods.columns else F.broadcast(rows)


def _period_years(periods: DataFrame) -> DataFrame:
    extra = ["station"] if "station" in periods.columns else []
    cols = extra + ["period_id", "year_start", "year_end"]
    if periods.isLocal():
        # configuration built on the driver: expand it there, keeping the
        # result a local relation whose size check needs no Spark job
        rows = [tuple(r[c] for c in cols) + (y,)
                for r in periods.select(*cols).collect()
                for y in range(r["year_start"], r["year_end"] + 1)]
        schema = T.StructType([periods.schema[c] for c in cols]
                              + [T.StructField("year", T.IntegerType(), False)])
        return periods.sparkSession.createDataFrame(rows, schema)
    return periods.select(
        *cols, F.explode(F.sequence(F.col("year_start"), F.col("year_end"))).alias("year"))


def year_span(periods: DataFrame) -> tuple[int, int] | None:
    """First and last year of all periods (one row), None without periods."""
    r = periods.agg(F.min("year_start"), F.max("year_end")).first()
    return None if r[0] is None else (int(r[0]), int(r[1]))


def in_years(daily: DataFrame, years: tuple[int, int] | None, date_col: str = "date") -> DataFrame:
    """The rows of the years, as literal bounds on the date and, where the table
    is partitioned by year, on the partition column, so that the scan prunes."""
    if years is None:
        return daily
    cond = (F.col(date_col) >= F.lit(_dt.date(years[0], 1, 1))) & (F.col(date_col) <= F.lit(_dt.date(years[1], 12, 31)))
    if "year" in daily.columns:
        cond = cond & (F.col("year") >= years[0]) & (F.col("year") <= years[1])
    return daily.filter(cond)


def check_date_range(start: _dt.date, end: _dt.date, today: _dt.date | None = None) -> None:
    """Job date-range guards: start <= end and nothing in the future."""
    today = today or _dt.date.today()
    if start > today or end > today:
        raise ValueError("Dates cannot be in the future")
    if start > end:
        raise ValueError("Start date must be before or equal to end date")


def validate_fields(fields, columns) -> None:
    """Unknown fields raise ``ValueError`` naming all of them."""
    if fields:
        bad = [f for f in fields if f not in columns]
        if bad:
            raise ValueError(f"Invalid fields: {', '.join(bad)}")
