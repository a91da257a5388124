"""Job configuration: periods, stations, range metrics, crossref, descriptions."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from . import schemas


@dataclass(frozen=True)
class Period:
    year_start: int
    year_end: int
    period_id: str | None = None

    def __post_init__(self):
        if self.year_start > self.year_end:
            raise ValueError(f"period start {self.year_start} after end {self.year_end}")
        if self.period_id is None:
            object.__setattr__(self, "period_id", f"{self.year_start}_{self.year_end}")


@dataclass(frozen=True)
class RangeMetric:
    """Days per year with ``column`` in a range; ``None`` bound = unbounded."""
    name: str
    column: str
    lo: float | None
    hi: float | None
    lo_closed: bool = True
    hi_closed: bool = True


@dataclass(frozen=True)
class RecordMetric:
    """An extreme of ``column`` kept with every date reaching it."""
    name: str
    column: str
    kind: str  # "max" or "min"


@dataclass
class NormalsJob:
    periods: list[Period]
    crossref: dict[str, str]
    source_table: str = "daily"
    target_template: str = "climate_normals_<year_start>_<year_end>"
    extra: dict = field(default_factory=dict)

    def target_name(self, period: Period) -> str:
        return (self.target_template.replace("<year_start>", str(period.year_start))
                .replace("<year_end>", str(period.year_end)))


def _low(name, lo, hi):
    return RangeMetric(name, "temp_low", lo, hi, lo_closed=False, hi_closed=True)


def _closed(name, col, lo, hi):
    return RangeMetric(name, col, lo, hi, lo_closed=True, hi_closed=True)


def _rain(name, lo, hi):
    return RangeMetric(name, "precipitation_sum", lo, hi, lo_closed=True, hi_closed=False)


# The day-count metrics as executed (names, columns, bounds and
# which ends are closed), in document order.
DAY_COUNT_METRICS: list[RangeMetric] = [
    _low("Avg_Days_TempLow_minus5", None, -5),
    _low("Avg_Days_TempLow_0", None, 0),
    _low("Avg_Days_TempLow_0_5", 0.01, 4.99),
    _low("Avg_Days_TempLow_5_10", 5, 9.99),
    _low("Avg_Days_TempLow_10_15", 10, 14.99),
    _low("Avg_Days_TempLow_15_20", 15, 19.99),
    _low("Avg_Days_TempLow_20", 20, None),
    _closed("Avg_Days_TempHigh_0", "temp_high", None, 0),
    _closed("Avg_Days_TempHigh_30", "temp_high", 30, None),
    _closed("Avg_Days_TempHigh_0_5", "temp_high", 0.01, 4.99),
    _closed("Avg_Days_TempHigh_5_10", "temp_high", 5, 9.99),
    _closed("Avg_Days_TempHigh_10_15", "temp_high", 10, 14.99),
    _closed("Avg_Days_TempHigh_15_20", "temp_high", 15, 19.99),
    _closed("Avg_Days_TempHigh_20", "temp_high", 20, None),
    _closed("Avg_Days_TempAvg_0", "temp_avg", None, 0),
    _closed("Avg_Days_TempAvg_25", "temp_avg", 25, None),
    _closed("Avg_Days_TempAvg_0_5", "temp_avg", 0.01, 4.99),
    _closed("Avg_Days_TempAvg_5_10", "temp_avg", 5, 9.99),
    _closed("Avg_Days_TempAvg_10_15", "temp_avg", 10, 14.99),
    _closed("Avg_Days_TempAvg_15_20", "temp_avg", 15, 19.99),
    _closed("Avg_Days_TempAvg_20", "temp_avg", 20, None),
    _rain("Avg_Days_Precipitation_1", 1, None),
    _rain("Avg_Days_Precipitation_0", 0.1, None),
    _rain("Avg_Days_Precipitation_1_5", 1, 4.99),
    _rain("Avg_Days_Precipitation_5_10", 5, 9.99),
    _rain("Avg_Days_Precipitation_10", 10, None),
    _rain("Avg_Days_Precipitation_20", 20, None),
]


def closed_left_metrics() -> list[RangeMetric]:
    """The documented meaning: low-temperature bands ``[lo, hi)`` without gaps."""
    bands = {
        "Avg_Days_TempLow_0_5": (0, 5, False),
        "Avg_Days_TempLow_5_10": (5, 10, True),
        "Avg_Days_TempLow_10_15": (10, 15, True),
        "Avg_Days_TempLow_15_20": (15, 20, True),
        "Avg_Days_TempLow_20": (20, None, True),
    }
    out = []
    for m in DAY_COUNT_METRICS:
        if m.name in bands:
            lo, hi, lo_closed = bands[m.name]
            out.append(RangeMetric(m.name, m.column, lo, hi, lo_closed=lo_closed, hi_closed=False))
        else:
            out.append(m)
    return out


# Record metrics (extreme with all its dates), document order.
RECORD_METRICS: list[RecordMetric] = [
    RecordMetric("Max_Daily_Precipitation", "precipitation_sum", "max"),
    RecordMetric("Max_TempHigh", "temp_high", "max"),
    RecordMetric("Max_TempLow", "temp_low", "max"),
    RecordMetric("Min_TempLow", "temp_low", "min"),
    RecordMetric("Min_TempHigh", "temp_high", "min"),
    RecordMetric("Max_TempAvg", "temp_avg", "max"),
    RecordMetric("Min_TempAvg", "temp_avg", "min"),
]

# English month names, January first.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]

# Descriptions written under "_comments" in a statistics document.
METRIC_DESCRIPTIONS: dict[str, str] = {
    "Avg_TempAvg": "Average temperature of daily mean temperatures",
    "Avg_TempHigh": "Average temperature of daily maximum temperatures",
    "Avg_TempLow": "Average temperature of daily minimum temperatures",
    "PrecipitationSum": "Total daily precipitations",
    "Max_Daily_Precipitation": "Maximum daily precipitation(s) with the dates",
    "Avg_Daily_Precipitation": "Average daily precipitations of the period",
    "Max_TempHigh": "Highest daily temperature record with the dates",
    "Min_TempHigh": "Lowest daily High temperature record with the dates",
    "Min_TempLow": "Lowest daily temperature record with the dates",
    "Max_TempLow": "Highest daily low temperature record with the dates",
    "Max_TempAvg": "Highest daily average temperature record with the dates",
    "Min_TempAvg": "Lowest daily average temperature record with the dates",
    "Avg_Days_TempLow_minus5": "Annual average days with minimum temperature <= -5°C by year",
    "Avg_Days_TempLow_0": "Annual average days with minimum temperature <= 0°C by year",
    "Avg_Days_TempLow_0_5": "Annual average days with minimum temperature > 0°C and <= 5°C by year",
    "Avg_Days_TempLow_5_10": "Annual average days with minimum temperature > 5°C and <= 10°C by year",
    "Avg_Days_TempLow_10_15": "Annual average days with minimum temperature > 10°C and <= 15°C by year",
    "Avg_Days_TempLow_15_20": "Annual average days with minimum temperature > 15°C and <= 20°C by year",
    "Avg_Days_TempLow_20": "Annual average days with minimum temperature >= 20°C by year",
    "Avg_Days_TempHigh_0": "Annual average days with maximum temperature <= 0°C by year",
    "Avg_Days_TempHigh_30": "Number of days with TempHigh >= 30°C by year",
    "Avg_Days_TempHigh_0_5": "Annual average days with maximum temperature > 0°C and <= 5°C by year",
    "Avg_Days_TempHigh_5_10": "Annual average days with maximum temperature > 5°C and <= 10°C by year",
    "Avg_Days_TempHigh_10_15": "Annual average days with maximum temperature > 10°C and <= 15°C by year",
    "Avg_Days_TempHigh_15_20": "Annual average days with maximum temperature > 15°C and <= 20°C by year",
    "Avg_Days_TempHigh_20": "Annual average days with maximum temperature >= 20°C by year",
    "Avg_Days_TempAvg_0": "Annual average days with average temperature <= 0°C by year",
    "Avg_Days_TempAvg_25": "NAnnual average days with average temperature >= 25°C by year",
    "Avg_Days_TempAvg_0_5": "Annual average days with average temperature > 0°C and <= 5°C by year",
    "Avg_Days_TempAvg_5_10": "Annual average days with average temperature > 5°C and <= 10°C by year",
    "Avg_Days_TempAvg_10_15": "Annual average days with average temperature > 10°C and <= 15°C by year",
    "Avg_Days_TempAvg_15_20": "Annual average days with average temperature > 15°C and <= 20°C by year",
    "Avg_Days_TempAvg_20": "Annual average days with average temperature >= 20°C by year",
    "Avg_Days_Precipitation_1": "Annual Average Days with Precipitation >= 1mm",
    "Avg_Days_Precipitation_0": "Annual Average Days with Precipitation > 0mm",
    "Avg_Days_Precipitation_1_5": "Annual Average Days with Precipitation >= 1mm and < 5mm",
    "Avg_Days_Precipitation_5_10": "Annual Average Days with Precipitation >= 5mm and < 10mm",
    "Avg_Days_Precipitation_10": "Annual Average Days with Precipitation >= 10mm",
    "Avg_Days_Precipitation_20": "Annual Average Days with Precipitation >= 20mm",
    "Yearly_Avg_Precipitation": "Annual average precipitation",
}

_CONF_DIR = os.path.join(os.path.dirname(__file__), "conf")
DEFAULT_NORMALS_CONFIG = os.path.join(_CONF_DIR, "normals.json")


def _table_name(place: dict, default: str) -> str:
    """``database.table`` of a source or destination entry."""
    table = place.get("table") or place.get("table_name") or default
    database = place.get("database") or place.get("db")
    return f"{database}.{table}" if database else table


def load_normals_config(path: str = DEFAULT_NORMALS_CONFIG) -> NormalsJob:
    """Read a normals job file; a missing file raises ``FileNotFoundError``."""
    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    periods = raw.get("periods")
    if periods is None and "period" in raw:
        periods = [raw["period"]]
    plist = [Period(int(p["start_year"]), int(p["end_year"]), p.get("period_id"))
             for p in (periods or [])]
    dest = raw.get("destination") or raw.get("destination_db") or {}
    src = raw.get("source") or raw.get("source_db") or {}
    return NormalsJob(periods=plist, crossref=dict(raw["crossref"]),
                      source_table=_table_name(src, "daily"),
                      target_template=_table_name(dest, "climate_normals_<year_start>_<year_end>"))


def load_station_config(path: str, station_key: str) -> dict:
    """One station entry of a JSON station registry; unknown key raises."""
    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    raw = raw.get("dbConfigs", raw)
    if station_key not in raw:
        raise ValueError(f"no station {station_key!r} in the registry")
    return raw[station_key]


def periods_frame(spark: SparkSession, periods: list[Period]) -> DataFrame:
    rows = [(p.period_id, int(p.year_start), int(p.year_end)) for p in periods]
    return spark.createDataFrame(rows, schemas.PERIODS)


def stations_frame(spark: SparkSession, stations: list[tuple]) -> DataFrame:
    return spark.createDataFrame(stations, schemas.STATIONS)
