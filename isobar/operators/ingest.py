"""Message and file payloads to typed observation / daily rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import cleaning as C
from ..functions.rounding import exact_mean_col


# --- observation messages -----------------------------------------------------

def flatten_observations(messages: DataFrame, wind_factor: float = 1.5,
                         keep: list[str] | None = None) -> DataFrame:
    """First observation of each message to an ``observations`` row.

    An empty array (or ``{}``) yields no row; later elements are ignored.
    Wind speed and gust are multiplied by the station calibration factor.
    Values are typed as the observation table (decimal rounding half up).
    ``keep`` lists envelope columns carried along (e.g. an arrival sequence).
    """
    keep = keep or []
    # explode of the first-element slice: an empty or missing array gives no
    # row, and the parsed message is evaluated once (a filter on it would be
    # pushed below the projection and parse the payload twice).
    first = F.slice(F.coalesce(F.col("observations"), F.array()), 1, 1)
    o = messages.select(*keep, F.explode(first).alias("o"))
    m = "o.metric."
    d = dict((f.name, f.dataType) for f in schemas.OBSERVATIONS.fields)

    def num(src, name):
        return F.col(src).cast(d[name]).alias(name)
    return o.select(
        F.col("o.stationID").alias("station"),
        F.col("o.obsTimeLocal").alias("obs_ts"),
        num(m + "temp", "temp"),
        F.round(F.col("o.humidity")).cast(T.IntegerType()).alias("humidity"),
        num(m + "precipRate", "precip_rate"),
        num(m + "precipTotal", "precip_total"),
        num(m + "pressure", "pressure"),
        num(m + "heatIndex", "heat_index"),
        C.wind_calibrated(m + "windSpeed", wind_factor).cast(d["wind_speed"]).alias("wind_speed"),
        C.wind_calibrated(m + "windGust", wind_factor).cast(d["wind_gust"]).alias("wind_gust"),
        num(m + "windChill", "wind_chill"),
        F.col("o.winddir").alias("wind_dir"),
        num(m + "dewpt", "dewpt"),
        num(m + "elev", "elev"),
        num("o.solarRadiation", "solar_radiation"),
        num("o.uv", "uv"),
        F.col("o.obsTimeUtc").alias("obs_time_utc"),
        F.col("o.epoch").alias("epoch"),
        *keep,
    )


_NUMBERS = {"metric.temp": "temp", "metric.precipRate": "precip_rate", "metric.precipTotal": "precip_total",
            "metric.pressure": "pressure", "metric.heatIndex": "heat_index", "metric.windChill": "wind_chill",
            "metric.dewpt": "dewpt", "metric.elev": "elev", "solarRadiation": "solar_radiation", "uv": "uv"}


def out_of_range(wind_factor: float = 1.5) -> Column:
    """Whether the first reading of a message has a value its column cannot hold."""
    d = dict((f.name, f.dataType) for f in schemas.OBSERVATIONS.fields)
    first = F.get(F.col("observations"), 0)

    def field(path):
        c = first
        for part in path.split("."):
            c = c.getField(part)
        return c
    pairs = [(field(src), name) for src, name in _NUMBERS.items()]
    pairs += [(field("metric.windSpeed") * wind_factor, "wind_speed"), (field("metric.windGust") * wind_factor, "wind_gust")]
    bad = F.lit(False)
    for value, name in pairs:
        bad = bad | (value.isNotNull() & value.try_cast(d[name]).isNull())
    return F.coalesce(bad, F.lit(False))


# --- daily-history messages ---------------------------------------------------

def map_history(messages: DataFrame, station: str | None = None) -> DataFrame:
    """P4 (+D11): first history element to a ``daily_history`` row.

    ``request_date`` (and ``station`` when present) must be columns of
    ``messages``; rain arrives in mm and is stored in cm.
    """
    first = F.slice(F.coalesce(F.col("observations"), F.array()), 1, 1)
    st = F.coalesce(F.col("station"), F.lit(station)) if "station" in messages.columns else F.lit(station)
    h = messages.select(st.alias("station"), F.col("request_date").alias("date"),
                        F.explode(first).alias("o"))
    d = dict((f.name, f.dataType) for f in schemas.DAILY_HISTORY.fields)
    m = "o.metric."

    def i(src):
        return F.round(F.col(src)).cast(T.IntegerType())
    return h.select(
        "station", "date",
        F.col(m + "tempHigh").cast(d["temperature_high_c"]).alias("temperature_high_c"),
        F.col(m + "tempAvg").cast(d["temperature_avg_c"]).alias("temperature_avg_c"),
        F.col(m + "tempLow").cast(d["temperature_low_c"]).alias("temperature_low_c"),
        F.col(m + "dewptHigh").cast(d["dewpoint_high_c"]).alias("dewpoint_high_c"),
        F.col(m + "dewptAvg").cast(d["dewpoint_avg_c"]).alias("dewpoint_avg_c"),
        F.col(m + "dewptLow").cast(d["dewpoint_low_c"]).alias("dewpoint_low_c"),
        i("o.humidityHigh").alias("humidity_high"),
        i("o.humidityAvg").alias("humidity_avg"),
        i("o.humidityLow").alias("humidity_low"),
        i(m + "pressureMax").alias("pressure_max_hpa"),
        i(m + "pressureMin").alias("pressure_min_hpa"),
        i(m + "windspeedHigh").alias("wind_speed_max_kmh"),
        i(m + "windspeedAvg").alias("wind_speed_avg_kmh"),
        i(m + "windgustHigh").alias("gust_speed_max_kmh"),
        C.mm_to_cm(m + "precipTotal", 2).cast(d["precipitation_sum_cm"]).alias("precipitation_sum_cm"),
    )


# --- console export -------------------------------------------------------------

CONSOLE_MEASURES = {
    "OutdoorTemperature": "temp", "OutdoorHumidity": "humidity", "DewPoint": "dewpt",
    "RELBarometer": "pressure", "Wind": "wind", "Gust": "gust", "DailyRain": "rain",
}
_CONSOLE_NUM = T.DecimalType(10, 2)


def parse_console(raw: DataFrame) -> DataFrame:
    """Sentinels to NULL, mixed-order time text to a timestamp."""
    keep = [c for c in ("station", "source_file") if c in raw.columns]
    return raw.select(
        *keep, F.col("No").try_cast(T.LongType()).alias("No"),
        C.parse_mixed_datetime("Time").alias("ts"),
        *[C.sentinel_to_null(src, _CONSOLE_NUM).alias(dst) for src, dst in CONSOLE_MEASURES.items()],
    ).withColumn("date", F.to_date("ts"))


def _console_aggs() -> list:
    dbl = T.DoubleType()
    return [
        F.max("temp").cast(dbl).alias("temp_max"),
        exact_mean_col("temp", 2, 1, "DOUBLE").alias("temp_avg"),
        F.min("temp").cast(dbl).alias("temp_min"),
        F.max("humidity").cast(dbl).alias("humidity_max"),
        exact_mean_col("humidity", 2, 1, "DOUBLE").alias("humidity_avg"),
        F.min("humidity").cast(dbl).alias("humidity_min"),
        F.max("dewpt").cast(dbl).alias("dewpoint_max"),
        exact_mean_col("dewpt", 2, 1, "DOUBLE").alias("dewpoint_avg"),
        F.min("dewpt").cast(dbl).alias("dewpoint_min"),
        F.max("pressure").cast(dbl).alias("pressure_max"),
        F.min("pressure").cast(dbl).alias("pressure_min"),
        F.max("wind").cast(dbl).alias("wind_max"),
        exact_mean_col("wind", 2, 1, "DOUBLE").alias("wind_avg"),
        F.max("gust").cast(dbl).alias("gust_max"),
        C.mm_to_cm(F.max("rain"), 2).cast(dbl).alias("rain_cm"),
    ]


STAT_FIELDS = ["temp_max", "temp_avg", "temp_min", "humidity_max", "humidity_avg", "humidity_min",
               "dewpoint_max", "dewpoint_avg", "dewpoint_min", "pressure_max", "pressure_min",
               "wind_max", "wind_avg", "gust_max", "rain_cm"]


def stat_line(df: DataFrame) -> DataFrame:
    """The 16-field ``;`` line with a decimal comma."""
    fields = [F.date_format("date", "dd/MM/yyyy")] + \
        [F.coalesce(C.decimal_comma(F.col(c)), F.lit("None")) for c in STAT_FIELDS]
    return df.withColumn("line", F.concat_ws(";", *fields))


# Lines of a console file that are compared in one window group.
RUN_LINES = 100_000


def console_runs(parsed: DataFrame, part: list[str], lines: int = RUN_LINES) -> DataFrame:
    """Adds ``run``, the number of date changes up to a line of its file.

    A file is cut into stretches of ``lines`` line numbers, so a long file is
    many window groups; the stretches are stitched by their first and last dates,
    one row each.
    """
    p = parsed.withColumn("_stretch", F.coalesce(F.expr(f"No div {int(lines)}"), F.lit(-1).cast("long")))
    w = Window.partitionBy(*part, "_stretch").orderBy("No")
    p = p.withColumn("_first", F.row_number().over(w) == 1)
    new = F.when(F.col("_first") | F.lag("date").over(w).eqNullSafe(F.col("date")), 0).otherwise(1)
    p = p.withColumn("_new", new).withColumn("_in", F.sum("_new").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = p.groupBy(*part, "_stretch").agg(
        F.sum("_new").alias("_n"), F.min_by("date", F.struct("_in", "No")).alias("_from"),
        F.max_by("date", F.struct("_in", "No")).alias("_to"))
    along = Window.partitionBy(*part).orderBy("_stretch")
    starts = F.when(F.lag("_to").over(along).eqNullSafe(F.col("_from")) & F.lag("_stretch").over(along).isNotNull(),
                    0).otherwise(1)
    ends = ends.withColumn("_s", starts)
    base = F.sum(F.col("_n") + F.col("_s")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = ends.select(*[F.col(c).alias(f"_k_{c}") for c in [*part, "_stretch"]],
                       (base - F.col("_n")).alias("_base"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*part, "_stretch"]]
    return p.join(ends, same).select(*parsed.columns, (F.col("_in") + F.col("_base")).alias("run"))


def console_daily(parsed: DataFrame, by: str = "date") -> DataFrame:
    """A3 (+A4): console statistics per day.

    ``by='date'`` groups by calendar date (equal to the change-detected
    groups on time-ordered files). ``by='run'`` reproduces change detection:
    a new group starts whenever the date differs from the previous row of
    the same file (ordered by ``No``); a date reappearing later is a new run.
    """
    keys = [c for c in ("station",) if c in parsed.columns]
    if by == "date":
        out = parsed.groupBy(*keys, "date").agg(*_console_aggs())
    elif by == "run":
        part = keys + (["source_file"] if "source_file" in parsed.columns else [])
        runs = console_runs(parsed, part)
        out = runs.groupBy(*part, "run", "date").agg(*_console_aggs())
    else:
        raise ValueError(f"unknown grouping: {by!r}")
    return stat_line(out)


def write_console_stats(stats: DataFrame, path: str) -> None:
    """The statistics lines as text without a header, one folder per station
    (and file, where runs are given), in the order of the dates: for few stations."""
    parts = [c for c in ("station", "source_file") if c in stats.columns]
    order = [c for c in ("run",) if c in stats.columns] + ["date"]
    out = stats.repartitionByRange(*parts, *order) if parts else stats.repartitionByRange(*order)
    w = out.sortWithinPartitions(*parts, *order).select(*parts, "line").write.mode("overwrite")
    (w.partitionBy(*parts) if parts else w).text(path)


STAT_FILE = "station string, source_file string, line string"
LINES_PER_FILE = 5_000_000


def write_console_lines(stats: DataFrame, path: str) -> None:
    """W7 for many stations: lines that carry their station (and file, where runs are given) in front,
    separated by tabs, dealt by range in the order of the stations and dates. The number of files
    follows the bytes and not the stations."""
    parts = [c for c in ("station", "source_file") if c in stats.columns]
    order = [c for c in ("run",) if c in stats.columns] + ["date"]
    (stats.repartitionByRange(*parts, *order).sortWithinPartitions(*parts, *order)
     .select(*[F.col(c) if c in parts else F.lit(None).cast("string").alias(c) for c in ("station", "source_file")], "line")
     .write.mode("overwrite").option("sep", "\t").option("quote", "").option("emptyValue", "")
     .option("maxRecordsPerFile", LINES_PER_FILE).csv(path))


def read_console_lines(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_console_lines` wrote: station, source_file, line."""
    return spark.read.schema(STAT_FILE).option("sep", "\t").option("quote", "").csv(path)
