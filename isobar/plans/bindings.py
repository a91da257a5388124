"""Weather-shaped inputs derived from the driver's tables.

The driver only provides its own tables, so observation and daily tables
are derived from them with integer arithmetic that DuckDB evaluates the same
way (see ``oracle.py``, which reuses the formulas below). The derived tables
grow with the given tables: every row of ``events`` becomes an observation,
every order contributes to a daily row, and stations come from users and
customers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import Period, periods_frame, stations_frame

# Integer formulas over ``events`` (one observation per event); tenths or
# hundredths of the measure. Shared verbatim with the DuckDB oracle.
OBS_INT = {
    "temp10": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id * 37) % 451 - 100 END",
    "dewpt10": "CASE WHEN event_id % 19 = 0 THEN NULL "
               "ELSE (event_id * 37) % 451 - 100 - (event_id * 13) % 80 END",
    "humidity": "CASE WHEN event_id % 23 = 0 THEN NULL ELSE (event_id * 7) % 101 END",
    "pressure100": "CASE WHEN event_id % 29 = 0 THEN NULL ELSE 98000 + (event_id * 53) % 5000 END",
    "wind10": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE (event_id * 11) % 600 END",
    "gust10": "CASE WHEN event_id % 31 = 0 THEN NULL "
              "ELSE (event_id * 11) % 600 + (event_id * 3) % 200 END",
    "rate100": "(event_id * 7) % 500",
    "rain100": "CASE WHEN event_id % 37 = 0 THEN NULL ELSE (event_id * 17) % 3000 END",
    "solar10": "CASE WHEN event_id % 41 = 0 THEN NULL ELSE (event_id * 29) % 12000 END",
    "uv10": "event_id % 100",
    "heat10": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id * 37) % 451 - 100 + event_id % 20 END",
    "chill10": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id * 37) % 451 - 100 - event_id % 30 END",
    "winddir": "(event_id * 7) % 360",
    "elev10": "(user_id % 5) * 250 + 400",
}
OBS_STATION = "concat('S', CAST(user_id AS STRING))"
# Every tenth message is sent twice; the second one arrives later with other measures.
RESENT_MOD, RESENT_OFFSET = 10, 1_000_000_000

# Places and zones that the derived stations are dealt over.
STATIONS = [
    ("S0", 50.57, 3.10, "Europe/Paris", "north"),
    ("S1", 48.82, 2.34, "Europe/Paris", "paris"),
    ("S2", 48.69, 2.16, "Europe/Paris", "paris"),
    ("S3", 51.48, -0.0008, "Europe/London", "london"),
    ("S4", 40.71, -74.01, "America/New_York", "new-york"),
]

# Reference periods over the order dates (1995-2001): overlapping 3-year spans.
PERIODS = [Period(1995, 1997), Period(1996, 1998), Period(1997, 1999),
           Period(1998, 2000), Period(1999, 2001)]

# What the filtered official import keeps.
OFFICIAL_STATIONS = ["C1", "C2", "C3", "C5", "C8", "C13", "C21"]
OFFICIAL_YEARS = (1996, 1999)

# The station of an order: ten customers each.
DAILY_STATION = "concat('C', CAST(o_custkey div 10 AS STRING))"

# Per (station, order date) integer aggregates over ``orders`` that make up
# a daily row; ``_null`` marks the days that are all NULL.
DAILY_AGG = {
    "a": "min(o_custkey % 451) - 100",
    "b": "max((o_custkey * 7) % 451) - 50",
    "rain10": "(min(o_custkey) % 7) * (min(o_orderkey) % 9) * 5",
    "dd": "min(o_orderkey) % 30",
    "hlow": "min(o_custkey % 60) + 20",
    "hspan": "max(o_orderkey % 20)",
    "plow10": "9900 + min(o_custkey % 200)",
    "pspan10": "max(o_orderkey % 50)",
    "wind10": "max(o_custkey % 300)",
    "gustx10": "min(o_orderkey % 150)",
    "solar10": "max((o_custkey * 11) % 3000)",
}

# Upsert source: daily rows from this date on, moved forward by this many days.
DAILY2_FROM = _dt.date(2000, 1, 1)
DAILY2_SHIFT = 200

# Spine range for the observation roll-up: wider than the data on both ends.
SPINE_START = _dt.date(2023, 12, 29)
SPINE_END = _dt.date(2024, 2, 2)

# Insert-if-absent split of the observations: overlapping time halves.
TARGET_BEFORE = _dt.datetime(2024, 1, 20)
SOURCE_FROM = _dt.datetime(2024, 1, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as messages: every `RESENT_MOD`-th one arrives a second time."""
    ids = F.when(F.col("event_id") % RESENT_MOD == 3,
                 F.array("event_id", F.col("event_id") + RESENT_OFFSET)).otherwise(F.array("event_id"))
    return table(spark, sf_dir, "events").select("user_id", "ts", F.explode(ids).alias("event_id"))


def _dec(expr: str, scale: int, to: T.DecimalType):
    return (F.expr(expr).cast(T.DecimalType(18, 0)) / F.lit(10 ** scale)).cast(to)


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with arrival order; (station, obs_ts) may repeat."""
    ev = events(spark, sf_dir)
    return ev.select(
        F.expr(OBS_STATION).alias("station"),
        F.date_trunc("second", F.col("ts")).cast(T.TimestampNTZType()).alias("obs_ts"),
        _dec(OBS_INT["temp10"], 1, schemas.D31).alias("temp"),
        F.expr(OBS_INT["humidity"]).cast(T.IntegerType()).alias("humidity"),
        _dec(OBS_INT["rate100"], 2, schemas.D52).alias("precip_rate"),
        _dec(OBS_INT["rain100"], 2, schemas.D62).alias("precip_total"),
        _dec(OBS_INT["pressure100"], 2, schemas.D62).alias("pressure"),
        _dec(OBS_INT["heat10"], 1, schemas.D31).alias("heat_index"),
        _dec(OBS_INT["wind10"], 1, schemas.D41).alias("wind_speed"),
        _dec(OBS_INT["gust10"], 1, schemas.D41).alias("wind_gust"),
        _dec(OBS_INT["chill10"], 1, schemas.D31).alias("wind_chill"),
        F.expr(OBS_INT["winddir"]).cast(T.IntegerType()).alias("wind_dir"),
        _dec(OBS_INT["dewpt10"], 1, schemas.D31).alias("dewpt"),
        _dec(OBS_INT["elev10"], 1, schemas.D41).alias("elev"),
        _dec(OBS_INT["solar10"], 1, schemas.D51).alias("solar_radiation"),
        _dec(OBS_INT["uv10"], 1, schemas.D21).alias("uv"),
        F.col("event_id").alias("arrival"),
    )


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation table: first arrival wins per (station, obs_ts)."""
    from ..operators.upsert import first_arrival
    return first_arrival(obs_raw(spark, sf_dir), ["station", "obs_ts"], "arrival").drop("arrival")


def event_days(spark: SparkSession, sf_dir: str) -> tuple[_dt.date, _dt.date]:
    """First and last day of the events."""
    return tuple(table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first())


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per user of ``events``, dealt over the places of `STATIONS`."""
    place = F.element_at(F.array(*[F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"), F.lit(tz).alias("tz"),
                                            F.lit(region).alias("region")) for _, lat, lon, tz, region in STATIONS]),
                         (F.col("user_id") % len(STATIONS) + 1).cast("int"))
    return table(spark, sf_dir, "events").select("user_id").distinct() \
        .select(F.expr(OBS_STATION).alias("station"), place.alias("p")).select("station", "p.*")


def periods(spark: SparkSession) -> DataFrame:
    return periods_frame(spark, PERIODS)


def station_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the periods for every station, chosen by the station's number."""
    number = F.expr("CAST(substring(station, 2) AS INT)")
    stations_ = daily(spark, sf_dir).select("station").distinct()
    each = F.array(*[F.struct(F.lit(p.period_id).alias("period_id"), F.lit(p.year_start).alias("year_start"),
                              F.lit(p.year_end).alias("year_end")) for p in PERIODS])
    pick = F.array(number % len(PERIODS), (number + 2) % len(PERIODS))
    return stations_.select("station", F.explode(F.transform(pick, lambda i: F.get(each, i))).alias("p")).select("station", "p.*")


def _orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr(DAILY_STATION).alias("station"), "o_orderdate", "o_custkey", "o_orderkey")


# Wide variant: one station per supplier over ``lineitem`` ship dates, so the
# number of stations and daily rows grows with the scale factor.
WIDE_SOURCE = {"station": "concat('L', CAST(l_suppkey AS STRING))",
               "o_orderdate": "l_shipdate", "o_custkey": "l_partkey", "o_orderkey": "l_orderkey"}


def _lineitem_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(v).alias(k) for k, v in WIDE_SOURCE.items()])


def daily_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table with one station per supplier (from ``lineitem``)."""
    return _daily_from(_lineitem_source(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table from ``orders``: stations and rows grow with the orders."""
    return _daily_from(_orders_source(spark, sf_dir))


# Source rows of one task that makes daily rows.
DAILY_ROWS = 250_000


def _daily_from(o: DataFrame) -> DataFrame:
    # dealt by station in parts of a bounded number of rows: tasks that read hold no groups, and what is
    # grouped by station and more afterwards is not exchanged again
    n = max(o.sparkSession.sparkContext.defaultParallelism, -(-o.count() // DAILY_ROWS))
    g = (o.repartition(n, "station")
         .groupBy(F.col("station"),
                  F.to_date("o_orderdate").alias("date"))
         .agg(*[F.expr(v).alias(k) for k, v in DAILY_AGG.items()]))
    dead = (F.datediff(F.col("date"), F.lit(_dt.date(1970, 1, 1))) % 23) == 0
    lo = F.least("a", "b")
    hi = F.greatest("a", "b")
    avg = F.expr("(least(a, b) + greatest(a, b)) div 2")
    hhigh = F.col("hlow") + F.col("hspan")
    phigh = F.col("plow10") + F.col("pspan10")

    def t(c, to):
        return F.when(~dead, (c.cast(T.DecimalType(18, 0)) / F.lit(10)).cast(to))

    def i(c):
        return F.when(~dead, c.cast(T.IntegerType()))

    return g.select(
        "station", "date",
        t(avg, schemas.D31).alias("temp_avg"),
        t(hi, schemas.D31).alias("temp_high"),
        t(lo, schemas.D31).alias("temp_low"),
        t(F.expr("(least(a, b) + greatest(a, b) - 2 * dd - 5) div 2"), schemas.D31).alias("dewpoint_avg"),
        t(hi - F.col("dd"), schemas.D31).alias("dewpoint_high"),
        t(lo - F.col("dd") - 5, schemas.D31).alias("dewpoint_low"),
        i(F.expr("(2 * hlow + hspan) div 2")).alias("humidity_avg"),
        i(hhigh).alias("humidity_high"),
        i(F.col("hlow")).alias("humidity_low"),
        t(F.expr("(2 * plow10 + pspan10) div 2"), schemas.D51).alias("pressure_avg"),
        t(phigh, schemas.D51).alias("pressure_high"),
        t(F.col("plow10"), schemas.D51).alias("pressure_low"),
        t(F.col("wind10"), schemas.D41).alias("wind_speed_max"),
        t(F.col("wind10") + F.col("gustx10"), schemas.D41).alias("gust_speed_max"),
        t(F.col("rain10"), schemas.D41).alias("precipitation_sum"),
        t(F.col("solar10"), schemas.D51).alias("solar_radiation_avg"),
    )


def daily2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert source: later daily rows shifted forward (some keys match)."""
    d = daily(spark, sf_dir).filter(F.col("date") >= F.lit(DAILY2_FROM))
    shifted = F.date_add("date", DAILY2_SHIFT)
    dayno = F.datediff(shifted, F.lit(_dt.date(1970, 1, 1)))
    return d.select(
        "station", shifted.alias("date"),
        *[(F.col("temp_low") + F.lit(0.7).cast(schemas.D31)).cast(schemas.D31).alias("temp_low")
          if c == "temp_low" else
          F.when(dayno % 5 != 0, F.col(c)).alias(c) if c == "precipitation_sum" else F.col(c)
          for c in schemas.DAILY_MEASURES]
    ).select(*[f.name for f in schemas.DAILY.fields])


# --- text payloads derived from the tables ------------------------------------
# Each payload is built by Spark from the driver tables and then parsed back
# by the library's own readers/operators, so the full text path is exercised.

MSG_EMPTY_MOD = 11      # events with event_id % 11 = 0 carry an empty array
MSG_SECOND_MOD = 7      # events with event_id % 7 = 0 carry a second element
WIND_EVEN = "2 * ((event_id * 11) % 300)"
GUST_EVEN = "2 * ((event_id * 11) % 300) + 2 * ((event_id * 3) % 100)"


def _tenths(expr: str, scale: int = 1):
    return F.expr(expr).cast("double") / F.lit(float(10 ** scale))


def observation_messages(spark: SparkSession, sf_dir: str, with_arrival: bool = False,
                         files: int | None = None) -> DataFrame:
    """One JSON message per event (``value``), shaped like the live feed.

    ``with_arrival`` adds the landing sequence (the event id) to the envelope. ``files`` deals the events
    evenly to so many tasks, before their texts are made: an event is a tenth of its message.
    """
    ev = events(spark, sf_dir)
    if files:
        ev = ev.repartition(files)
    ts = F.date_trunc("second", F.col("ts")).cast(T.TimestampNTZType())
    metric = F.struct(
        _tenths(OBS_INT["temp10"]).alias("temp"), _tenths(OBS_INT["heat10"]).alias("heatIndex"),
        _tenths(OBS_INT["dewpt10"]).alias("dewpt"), _tenths(OBS_INT["chill10"]).alias("windChill"),
        _tenths(WIND_EVEN).alias("windSpeed"), _tenths(GUST_EVEN).alias("windGust"),
        _tenths(OBS_INT["pressure100"], 2).alias("pressure"),
        _tenths(OBS_INT["rate100"], 2).alias("precipRate"),
        _tenths(OBS_INT["rain100"], 2).alias("precipTotal"), _tenths(OBS_INT["elev10"]).alias("elev"))
    item = F.struct(
        F.expr(OBS_STATION).alias("stationID"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("obsTimeUtc"),
        ts.alias("obsTimeLocal"), F.lit("n").alias("neighborhood"), F.lit("sw").alias("softwareType"),
        F.lit("FR").alias("country"), _tenths(OBS_INT["solar10"]).alias("solarRadiation"),
        F.lit(2.16).alias("lon"), F.lit(5.0).alias("realtimeFrequency"),
        F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts).alias("epoch"),
        F.lit(48.69).alias("lat"),
        _tenths(OBS_INT["uv10"]).alias("uv"), F.expr(OBS_INT["winddir"]).cast("int").alias("winddir"),
        F.expr(OBS_INT["humidity"]).cast("double").alias("humidity"), F.lit(1).alias("qcStatus"),
        metric.alias("metric"))
    second = item.withField("metric", metric.withField("temp", F.lit(-40.0)))
    arr = (F.when(F.col("event_id") % MSG_EMPTY_MOD == 0, F.array().cast(T.ArrayType(schemas.OBS_ITEM)))
           .when(F.col("event_id") % MSG_SECOND_MOD == 0, F.array(item, second))
           .otherwise(F.array(item)))
    env = [arr.alias("observations")] + ([F.col("event_id").alias("arrival")] if with_arrival else [])
    return ev.select(F.to_json(F.struct(*env)).alias("value"))


def history_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily-history reply per daily row; all-NULL days reply empty."""
    d = daily(spark, sf_dir)

    def dbl(c):
        return F.col(c).cast("double")
    metric = F.struct(
        dbl("temp_high").alias("tempHigh"), dbl("temp_avg").alias("tempAvg"),
        dbl("temp_low").alias("tempLow"), dbl("dewpoint_high").alias("dewptHigh"),
        dbl("dewpoint_avg").alias("dewptAvg"), dbl("dewpoint_low").alias("dewptLow"),
        dbl("pressure_high").alias("pressureMax"), dbl("pressure_low").alias("pressureMin"),
        dbl("wind_speed_max").alias("windspeedHigh"),
        (F.col("wind_speed_max").cast("double") / 2).alias("windspeedAvg"),
        dbl("gust_speed_max").alias("windgustHigh"), dbl("precipitation_sum").alias("precipTotal"))
    item = F.struct(dbl("humidity_high").alias("humidityHigh"), dbl("humidity_avg").alias("humidityAvg"),
                    dbl("humidity_low").alias("humidityLow"), metric.alias("metric"))
    arr = F.when(F.col("temp_high").isNull(), F.array().cast(T.ArrayType(schemas.HIST_ITEM))) \
        .otherwise(F.array(item))
    return d.select("station", F.col("date").alias("request_date"),
                    F.to_json(F.struct(arr.alias("observations"))).alias("value"))


CONSOLE_SWAP_MOD = 13   # "<time> <date>" layout
CONSOLE_GLITCH_MOD = 50  # rows with event_id % 50 = 7 show the previous day's date


def _sentinel(col: str, use_dash_dot) -> F.Column:
    return F.when(F.col(col).isNull(), F.when(use_dash_dot, F.lit("--.-")).otherwise(F.lit("--"))) \
        .otherwise(F.col(col).cast("string"))


def console_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Console export lines (all text) for the deduplicated observations."""
    raw = obs_raw(spark, sf_dir)
    from ..operators.upsert import first_arrival
    o = first_arrival(raw, ["station", "obs_ts"], "arrival")
    eid = F.col("arrival")
    shown = F.when(eid % CONSOLE_GLITCH_MOD == 7, F.col("obs_ts") - F.expr("INTERVAL 1 DAY")) \
        .otherwise(F.col("obs_ts"))
    time_txt = F.when(eid % CONSOLE_SWAP_MOD == 0, F.date_format(shown, "HH:mm yyyy-MM-dd")) \
        .otherwise(F.date_format(shown, "yyyy-MM-dd HH:mm"))
    even = eid % 2 == 0
    cols = {c: F.lit("0") for c in schemas.CONSOLE_COLUMNS}
    cols.update({
        "No": eid.cast("string"), "Time": time_txt,
        "IndoorTemperature": F.lit("21.0"), "IndoorHumidity": F.lit("45"),
        "OutdoorTemperature": _sentinel("temp", even), "OutdoorHumidity": _sentinel("humidity", even),
        "Wind": _sentinel("wind_speed", even), "Gust": _sentinel("wind_gust", even),
        "DewPoint": _sentinel("dewpt", even), "RELBarometer": _sentinel("pressure", even),
        "ABSBarometer": _sentinel("pressure", even), "DailyRain": _sentinel("precip_total", even),
    })
    return o.select(
        "station", F.concat_ws("_", F.col("station"), F.date_format("obs_ts", "yyyyMM")).alias("source_file"),
        *[cols[c].alias(c) for c in schemas.CONSOLE_COLUMNS])


OFFICIAL_TM_GAP_MOD = 7     # TM left empty (mean falls back to (TX+TN)/2)
OFFICIAL_FXY_INT_MOD = 11   # FXY written as a whole number
OFFICIAL_PMERM_GAP_MOD = 13  # PMERM left empty


def official_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two official files (text) for the daily rows."""
    d = daily(spark, sf_dir)
    dn = F.datediff(F.col("date"), F.lit(_dt.date(1970, 1, 1)))

    def txt(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    wind10 = (F.col("wind_speed_max") * 10).cast("long")
    gust10 = (F.col("gust_speed_max") * 10).cast("long")
    fxy = F.when(dn % OFFICIAL_FXY_INT_MOD == 0, F.expr("CAST(wind_speed_max * 10 AS BIGINT) div 10").cast("string")) \
        .otherwise((wind10.cast(T.DecimalType(18, 0)) / 10).cast(schemas.D41).cast("string"))
    fxi = (gust10.cast(T.DecimalType(18, 0)) / 10).cast(schemas.D41).cast("string")
    num = F.concat(F.lit("59"), F.substring("station", 2, 20))
    rr_cols = {c: F.lit("") for c in schemas.OFFICIAL_RR_COLUMNS}
    rr_cols.update({
        "NUM_POSTE": num, "NOM_USUEL": F.col("station"), "LAT": F.lit("50.57"),
        "LON": F.lit("3.10"), "ALTI": F.lit("47"), "AAAAMMJJ": F.date_format("date", "yyyyMMdd"),
        "RR": txt("precipitation_sum"), "TN": txt("temp_low"), "TX": txt("temp_high"),
        "TM": F.when(dn % OFFICIAL_TM_GAP_MOD == 0, F.lit("")).otherwise(txt("temp_avg")),
        "FXY": F.coalesce(fxy, F.lit("")), "FXI": F.coalesce(fxi, F.lit("")),
        "QRR": F.lit("1"), "QTN": F.lit("1"), "QTX": F.lit("1"), "QTM": F.lit("1"),
    })
    rr = d.select(*[rr_cols[c].alias(c) for c in schemas.OFFICIAL_RR_COLUMNS])
    other = d.select(
        num.alias("NUM_POSTE"), F.date_format("date", "yyyyMMdd").alias("AAAAMMJJ"),
        F.when(dn % OFFICIAL_PMERM_GAP_MOD == 0, F.lit("")).otherwise(txt("pressure_avg")).alias("PMERM"),
        txt("pressure_low").alias("PMERMIN"), txt("humidity_low").alias("UN"),
        txt("humidity_high").alias("UX"), txt("humidity_avg").alias("UM"))
    return rr, other
