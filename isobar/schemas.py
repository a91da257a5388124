"""Explicit schemas for every table and message the library reads or writes.

Columns are always addressed by name, never by position.
"""

from __future__ import annotations

from pyspark.sql import types as T

D31 = T.DecimalType(3, 1)
D41 = T.DecimalType(4, 1)
D51 = T.DecimalType(5, 1)
D52 = T.DecimalType(5, 2)
D62 = T.DecimalType(6, 2)
D21 = T.DecimalType(2, 1)


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


# --- observation message (current conditions, JSON) -------------------------
# The feed's field names, here and in the daily-history message.
OBS_METRIC = _fields([
    ("temp", T.DoubleType()), ("heatIndex", T.DoubleType()), ("dewpt", T.DoubleType()),
    ("windChill", T.DoubleType()), ("windSpeed", T.DoubleType()), ("windGust", T.DoubleType()),
    ("pressure", T.DoubleType()), ("precipRate", T.DoubleType()), ("precipTotal", T.DoubleType()),
    ("elev", T.DoubleType()),
])
OBS_ITEM = _fields([
    ("stationID", T.StringType()), ("obsTimeUtc", T.StringType()),
    ("obsTimeLocal", T.TimestampNTZType()), ("neighborhood", T.StringType()),
    ("softwareType", T.StringType()), ("country", T.StringType()),
    ("solarRadiation", T.DoubleType()), ("lon", T.DoubleType()),
    ("realtimeFrequency", T.DoubleType()), ("epoch", T.LongType()), ("lat", T.DoubleType()),
    ("uv", T.DoubleType()), ("winddir", T.IntegerType()), ("humidity", T.DoubleType()),
    ("qcStatus", T.IntegerType()), ("metric", OBS_METRIC),
])
OBS_MESSAGE = _fields([("observations", T.ArrayType(OBS_ITEM))])

# --- daily-history message (JSON) -------------------------------------------
HIST_METRIC = _fields([
    ("tempHigh", T.DoubleType()), ("tempAvg", T.DoubleType()), ("tempLow", T.DoubleType()),
    ("dewptHigh", T.DoubleType()), ("dewptAvg", T.DoubleType()), ("dewptLow", T.DoubleType()),
    ("pressureMax", T.DoubleType()), ("pressureMin", T.DoubleType()),
    ("windspeedHigh", T.DoubleType()), ("windspeedAvg", T.DoubleType()),
    ("windgustHigh", T.DoubleType()), ("precipTotal", T.DoubleType()),
])
HIST_ITEM = _fields([
    ("humidityHigh", T.DoubleType()), ("humidityAvg", T.DoubleType()),
    ("humidityLow", T.DoubleType()), ("metric", HIST_METRIC),
])
HIST_MESSAGE = _fields([("observations", T.ArrayType(HIST_ITEM))])

# --- console export (UTF-16, tab separated) ---------------------------------
# The console's own column header names, in file order.
CONSOLE_COLUMNS = [
    "No", "Time", "IndoorTemperature", "IndoorHumidity", "OutdoorTemperature",
    "OutdoorHumidity", "Wind", "Gust", "DewPoint", "WindChill", "WindDirection",
    "ABSBarometer", "RELBarometer", "RainRate", "DailyRain", "WeeklyRain",
    "MonthlyRain", "YearlyRain", "SolarRad", "Heatindex", "UV", "UVI",
]
CONSOLE_SCHEMA = _fields([(c, T.StringType()) for c in CONSOLE_COLUMNS])

# --- official daily climate files (';' separated) ---------------------------
# Measure codes of the official daily file, each followed in the
# file by its quality column "Q<code>".
OFFICIAL_RR_MEASURES = [
    "RR", "TN", "HTN", "TX", "HTX", "TM", "TNTXM", "TAMPLI", "TNSOL", "TN50", "DG",
    "FFM", "FF2M", "FXY", "DXY", "HXY", "FXI", "DXI", "HXI", "FXI2", "DXI2", "HXI2",
    "FXI3S", "DXI3S", "HXI3S",
]
OFFICIAL_HEAD = ["NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI", "AAAAMMJJ"]
OFFICIAL_RR_COLUMNS = OFFICIAL_HEAD + [
    c for m in OFFICIAL_RR_MEASURES for c in (m, "Q" + m)]
# Second parameter set, the subset the import uses.
OFFICIAL_OTHER_COLUMNS = ["NUM_POSTE", "AAAAMMJJ", "PMERM", "PMERMIN", "UN", "UX", "UM"]
OFFICIAL_RR_SCHEMA = _fields([(c, T.StringType()) for c in OFFICIAL_RR_COLUMNS])

# --- observation table ------------------------------------------------------
OBSERVATIONS = _fields([
    ("station", T.StringType()), ("obs_ts", T.TimestampNTZType()),
    ("temp", D31), ("humidity", T.IntegerType()), ("precip_rate", D52),
    ("precip_total", D62), ("pressure", D62), ("heat_index", D31),
    ("wind_speed", D41), ("wind_gust", D41), ("wind_chill", D31),
    ("wind_dir", T.IntegerType()), ("dewpt", D31), ("elev", D41),
    ("solar_radiation", D51), ("uv", D21),
])

# --- daily table (hub of the engine) ----------------------------------------
DAILY = _fields([
    ("station", T.StringType()), ("date", T.DateType()),
    ("temp_avg", D31), ("temp_high", D31), ("temp_low", D31),
    ("dewpoint_avg", D31), ("dewpoint_high", D31), ("dewpoint_low", D31),
    ("humidity_avg", T.IntegerType()), ("humidity_high", T.IntegerType()),
    ("humidity_low", T.IntegerType()),
    ("pressure_avg", D51), ("pressure_high", D51), ("pressure_low", D51),
    ("wind_speed_max", D41), ("gust_speed_max", D41), ("precipitation_sum", D41),
    ("solar_radiation_avg", D51),
])
DAILY_KEYS = ["station", "date"]
DAILY_MEASURES = [f.name for f in DAILY.fields[2:]]

# --- legacy daily-history table ---------------------------------------------
DAILY_HISTORY = _fields([
    ("station", T.StringType()), ("date", T.DateType()),
    ("temperature_high_c", D31), ("temperature_avg_c", D31), ("temperature_low_c", D31),
    ("dewpoint_high_c", D41), ("dewpoint_avg_c", D41), ("dewpoint_low_c", D41),
    ("humidity_high", T.IntegerType()), ("humidity_avg", T.IntegerType()),
    ("humidity_low", T.IntegerType()),
    ("pressure_max_hpa", T.IntegerType()), ("pressure_min_hpa", T.IntegerType()),
    ("wind_speed_max_kmh", T.IntegerType()), ("wind_speed_avg_kmh", T.IntegerType()),
    ("gust_speed_max_kmh", T.IntegerType()), ("precipitation_sum_cm", T.DecimalType(4, 2)),
])

# --- configuration tables ---------------------------------------------------
STATIONS = _fields([
    ("station", T.StringType()), ("lat", T.DoubleType()), ("lon", T.DoubleType()),
    ("tz", T.StringType()), ("region", T.StringType()),
])
PERIODS = T.StructType([
    T.StructField("period_id", T.StringType(), False),
    T.StructField("year_start", T.IntegerType(), False),
    T.StructField("year_end", T.IntegerType(), False),
])
