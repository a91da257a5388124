"""Column-level cleaning and conversion expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from .rounding import half_up, truncate_toward_zero

# The console writes these in place of a missing measure.
CONSOLE_SENTINELS = ["--.-", "--"]

# The two layouts of the console "Time" field
# (date then time, or time then date), year first.
MIXED_DATETIME_FORMATS = [
    "yyyy-MM-dd HH:mm", "HH:mm yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss", "HH:mm:ss yyyy-MM-dd",
    "yyyy/MM/dd HH:mm", "HH:mm yyyy/MM/dd",
]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sentinel_to_null(col: Column | str, to: T.DataType = T.DoubleType()) -> Column:
    """Console text measure: sentinel or unparsable text becomes NULL."""
    c = F.trim(_c(col))
    kept = F.when(~c.isin(*CONSOLE_SENTINELS) & (c != ""), c)
    return kept.try_cast(to)


def parse_mixed_datetime(col: Column | str) -> Column:
    """``<date> <time>`` or ``<time> <date>`` to a local (NTZ) timestamp."""
    c = F.trim(_c(col))
    parsed = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in MIXED_DATETIME_FORMATS]
    return F.coalesce(*parsed).cast(T.TimestampNTZType())


def compact_date(col: Column | str) -> Column:
    """``AAAAMMJJ`` (yyyyMMdd) text to a date; bad text gives NULL."""
    return F.try_to_timestamp(F.trim(_c(col)), F.lit("yyyyMMdd")).cast(T.DateType())


def empty_to_null(col: Column | str) -> Column:
    c = F.trim(_c(col))
    return F.when(c != "", c)


def decimal_text(col: Column | str, to: T.DecimalType) -> Column:
    """Empty or unparsable text to NULL, else a decimal of the given type."""
    return empty_to_null(col).try_cast(T.DecimalType(12, 4)).cast(to)


def mean_temperature(tm: Column, tn: Column, tx: Column, mode: str = "truncate",
                     to: T.DecimalType = T.DecimalType(3, 1)) -> Column:
    """Daily mean: TM when given, else (TX + TN) / 2.

    ``mode='truncate'`` cuts toward zero to 0.1 (the executed import);
    ``mode='round'`` rounds half away from zero (the documented intent).
    """
    mid = (tx.cast(T.DecimalType(8, 2)) + tn.cast(T.DecimalType(8, 2))) / F.lit(2)
    if mode == "truncate":
        fallback = truncate_toward_zero(mid, 1, to)
    elif mode == "round":
        fallback = half_up(mid, 1, to)
    else:
        raise ValueError(f"unknown fallback mode: {mode!r}")
    return F.coalesce(tm.cast(to), fallback)


def high_pressure(pmerm: Column, pmermin: Column,
                  to: T.DecimalType = T.DecimalType(5, 1)) -> Column:
    """Reconstructed daily high: ``2*PMERM - PMERMIN`` (NULL if either is)."""
    return (F.lit(2) * pmerm.cast(T.DecimalType(8, 2)) - pmermin.cast(T.DecimalType(8, 2))).cast(to)


def ms_to_kmh(col: Column | str, to: T.DecimalType = T.DecimalType(4, 1)) -> Column:
    """Metres per second to km/h, cut toward zero to 0.1."""
    return truncate_toward_zero(_c(col).cast(T.DecimalType(8, 2)) * F.lit(3.6).cast(T.DecimalType(3, 1)), 1, to)


def mm_to_cm(col: Column | str, scale: int = 2) -> Column:
    """Rain in mm to cm, rounded half up to ``scale`` decimals."""
    return F.round(_c(col).cast(T.DecimalType(10, 3)) / F.lit(10), scale)


def decimal_comma(col: Column | str) -> Column:
    """Number to text with a decimal comma (NULL stays NULL)."""
    return F.translate(_c(col).cast(T.StringType()), ".", ",")


def wind_calibrated(col: Column | str, factor: float = 1.5) -> Column:
    """Station wind correction factor (1.5 in the deployed ingest)."""
    return _c(col) * F.lit(float(factor))
