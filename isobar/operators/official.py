"""Official daily climate files to the daily table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import cleaning as C


def select_station_years(rr: DataFrame, stations: list[str] | None = None,
                         years: tuple[int, int] | None = None) -> DataFrame:
    """station name equality and inclusive year range (both optional)."""
    out = rr
    if stations is not None:
        out = out.filter(F.col("NOM_USUEL").isin(*stations))
    if years is not None:
        y = F.substring(F.trim(F.col("AAAAMMJJ")), 1, 4).try_cast(T.IntegerType())
        out = out.filter(y.between(int(years[0]), int(years[1])))
    return out


def quality_filter(rr: DataFrame, measures: list[str], codes=(0, 1, 9)) -> DataFrame:
    """F12 (off by default): keep rows whose quality codes are accepted."""
    out = rr
    for m in measures:
        q = F.col("Q" + m).try_cast(T.IntegerType())
        out = out.filter(q.isNull() | q.isin(*codes))
    return out


def import_official(rr: DataFrame, other: DataFrame | None = None,
                    stations: list[str] | None = None,
                    years: tuple[int, int] | None = None,
                    mean_fallback: str = "truncate",
                    quality: tuple[int, ...] | None = None) -> DataFrame:
    """Official rows to ``daily`` rows (dew point and solar stay NULL).

    TM falls back to (TX + TN) / 2 cut toward zero to 0.1 (``'round'`` for
    half-up); the daily high pressure is ``2*PMERM - PMERMIN``; FXY/FXI are
    m/s converted to km/h and cut to 0.1. The second parameter set is joined
    on (station number, date); a missing partner row gives NULL measures.
    ``quality`` keeps only rows whose quality codes are among the given ones (F12).
    """
    d = dict((f.name, f.dataType) for f in schemas.DAILY.fields)
    base = select_station_years(rr, stations, years)
    if quality is not None:
        base = quality_filter(base, ["RR", "TN", "TX", "TM"], quality)
    x = base.select(
        F.trim("NUM_POSTE").alias("NUM_POSTE"),
        F.trim("NOM_USUEL").alias("station"),
        F.trim("AAAAMMJJ").alias("AAAAMMJJ"),
        C.compact_date("AAAAMMJJ").alias("date"),
        *[C.decimal_text(c, T.DecimalType(8, 2)).alias(c) for c in ("RR", "TN", "TX", "TM", "FXY", "FXI")],
    )
    if other is not None:
        o = other.select(
            F.trim("NUM_POSTE").alias("NUM_POSTE"), F.trim("AAAAMMJJ").alias("AAAAMMJJ"),
            *[C.decimal_text(c, T.DecimalType(8, 2)).alias(c) for c in ("PMERM", "PMERMIN", "UN", "UX", "UM")])
        x = x.join(o, ["NUM_POSTE", "AAAAMMJJ"], "left")
    else:
        for c in ("PMERM", "PMERMIN", "UN", "UX", "UM"):
            x = x.withColumn(c, F.lit(None).cast(T.DecimalType(8, 2)))

    def hum(c):
        return F.round(F.col(c), 0).cast(T.IntegerType())
    return x.select(
        "station", "date",
        C.mean_temperature(F.col("TM"), F.col("TN"), F.col("TX"), mean_fallback, d["temp_avg"]).alias("temp_avg"),
        F.col("TX").cast(d["temp_high"]).alias("temp_high"),
        F.col("TN").cast(d["temp_low"]).alias("temp_low"),
        F.lit(None).cast(d["dewpoint_avg"]).alias("dewpoint_avg"),
        F.lit(None).cast(d["dewpoint_high"]).alias("dewpoint_high"),
        F.lit(None).cast(d["dewpoint_low"]).alias("dewpoint_low"),
        hum("UM").alias("humidity_avg"),
        hum("UX").alias("humidity_high"),
        hum("UN").alias("humidity_low"),
        F.col("PMERM").cast(d["pressure_avg"]).alias("pressure_avg"),
        C.high_pressure(F.col("PMERM"), F.col("PMERMIN"), d["pressure_high"]).alias("pressure_high"),
        F.col("PMERMIN").cast(d["pressure_low"]).alias("pressure_low"),
        C.ms_to_kmh("FXY", d["wind_speed_max"]).alias("wind_speed_max"),
        C.ms_to_kmh("FXI", d["gust_speed_max"]).alias("gust_speed_max"),
        F.col("RR").cast(d["precipitation_sum"]).alias("precipitation_sum"),
        F.lit(None).cast(d["solar_radiation_avg"]).alias("solar_radiation_avg"),
    )
