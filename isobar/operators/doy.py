"""Day-of-year normals: 366 rows per (station, period).

``doy_normals_config`` evaluates user-supplied SQL aggregates (the crossref
map, field -> expression) over a renaming view of the daily table;
``doy_normals_fixed`` is the fixed 43-measure variant typed as the normals DDL.

Overlapping periods never repeat a daily row. The rows of a (station, day of
year), one a year, become one array sorted by year that carries running sums
and counts. A period is two positions in it: its sums and counts are the
difference of two entries, its extremes the least and greatest of the entries
between them. The daily rows are exchanged once; the running sums, the arrays
and the periods' lookups all stay in that partitioning, and the arrays are as
short as the table has years.

Crossref expressions other than AVG, SUM, MIN and MAX of one column (rounded
or not) are evaluated as they are, on the daily rows of every period.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.rounding import half_up_div_sql
from .common import NO_YEARS, in_years, period_years, year_span

# Column names the crossref expressions refer to, mapped to the
# daily table (None = measure the daily table does not carry; NULL column).
CROSSREF_VIEW = {
    "AvgTemp": "temp_avg", "MaxTemp": "temp_high", "MinTemp": "temp_low",
    "DewPoint": "dewpoint_avg", "MaxDewPoint": "dewpoint_high", "MinDewPoint": "dewpoint_low",
    "Humidity": "humidity_avg", "MaxHumidity": "humidity_high", "MinHumidity": "humidity_low",
    "Pressure": "pressure_avg", "MaxPressure": "pressure_high", "MinPressure": "pressure_low",
    "WindSpeed": "wind_speed_max", "GustSpeed": "gust_speed_max",
    "Precipitation": "precipitation_sum", "SolarRadiation": "solar_radiation_avg",
    "UVIndex": None, "WindChill": None, "HeatIndex": None,
}
# Integer measures are averaged as exact decimals, like the SQL database the
# expressions were written for (AVG of an INT is a DECIMAL there).
_INT_AS_DECIMAL = T.DecimalType(10, 0)


def crossref_view(daily: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The daily table under the names the crossref expressions use."""
    cols = [F.col(c) for c in keep or []] + [F.col("station"), F.col("date").alias("Date")]
    for name, src in CROSSREF_VIEW.items():
        if src is None:
            cols.append(F.lit(None).cast(schemas.D31).alias(name))
        elif dict((f.name, f.dataType) for f in schemas.DAILY.fields)[src] == T.IntegerType():
            cols.append(F.col(src).cast(_INT_AS_DECIMAL).alias(name))
        else:
            cols.append(F.col(src).alias(name))
    return daily.select(*cols)


def _with_periods(daily: DataFrame, periods: DataFrame) -> DataFrame:
    """The daily rows of the periods' years, once per period."""
    d = in_years(daily, year_span(periods) or NO_YEARS)
    keyed = d.withColumn("year", F.col("year").cast("int") if "year" in daily.columns else F.year("date"))
    keys = ["station", "year"] if "station" in periods.columns else ["year"]
    return keyed.join(period_years(periods), keys, "inner")


@dataclass(frozen=True)
class Measure:
    """``kind`` (avg, sum, min, max) of a daily column, rounded to ``digits`` decimals if given."""
    name: str
    kind: str
    column: str | None
    digits: int | None
    type: T.DataType


def _scales(daily: DataFrame) -> dict[str, int]:
    """Decimals of the columns that fit a long without their point."""
    out = {}
    for f in daily.schema.fields:
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision + 4 <= 18:
            out[f.name] = f.dataType.scale
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            out[f.name] = 0
    return out


def _period_list(periods: DataFrame) -> tuple[list, list[int]]:
    """The periods as rows and, sorted, the years at which a period ends or the year before it starts."""
    rows = periods.select("period_id", "year_start", "year_end").distinct().collect()
    return rows, sorted({y for r in rows for y in (r["year_start"] - 1, r["year_end"])})


def year_arrays(daily: DataFrame, sums: list[str], values: list[str], ends: list[int], years: tuple[int, int]) -> DataFrame:
    """(station, DayOfYear, rows, pos): the rows of each day of the year by year, with running sums
    ``s_`` and counts ``n_`` and the values ``v_``; ``pos``: how many rows lie up to each of ``ends``."""
    scales = _scales(daily)
    year = F.col("year").cast("int") if "year" in daily.columns else F.year("date")
    d = in_years(daily, years).select(
        "station", F.substring(F.col("date").cast("string"), 6, 5).alias("DayOfYear"), year.alias("year"),
        *[(F.col(c) * 10 ** scales[c]).cast("long").alias(f"u_{c}") for c in sums], *[F.col(c).alias(f"v_{c}") for c in values])
    by_year = Window.partitionBy("station", "DayOfYear").orderBy("year")
    so_far = by_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the window's own exchange, which rows that lie by station do without
    d = d.select(
        "station", "DayOfYear", "year", F.row_number().over(by_year).alias("i"),
        *[F.sum(f"u_{c}").over(so_far).alias(f"s_{c}") for c in sums],
        *[F.count(f"u_{c}").over(so_far).alias(f"n_{c}") for c in sums], *[f"v_{c}" for c in values])
    entry = F.struct("i", *[f"{x}_{c}" for c in sums for x in "sn"], *[f"v_{c}" for c in values])
    return d.groupBy("station", "DayOfYear").agg(
        F.array_sort(F.collect_list(entry)).alias("rows"),
        F.array(*[F.count_if(F.col("year") <= y).cast("int") for y in ends]).alias("pos"))


def _scaled(value: str, scale: int) -> str:
    """An unscaled long as the decimal: a product, as dividing by a power of ten costs several times more."""
    return f"CAST({value} AS DECIMAL(18, 0)) * CAST('1e-{scale}' AS DECIMAL({scale}, {scale}))" if scale else value


def _mean_sql(m: Measure, scale: int) -> str:
    """The mean of unscaled sums: rounded like the database's, first to four more digits, then on."""
    digits = scale + 4 if m.digits is None else min(m.digits, scale + 4)
    q = f"f_{m.column}" if digits == scale + 4 else half_up_div_sql(f"f_{m.column}", str(10 ** (scale + 4 - digits)))
    return f"CAST({_scaled(q, digits)} AS {m.type.simpleString()})"


def _sum_sql(m: Measure, scale: int) -> str:
    q = f"IF(n_{m.column} > 0, s_{m.column}, NULL)"
    e = f"CAST({q} AS DECIMAL(38, 0)) / {10 ** scale}" if scale else q
    return f"CAST({e if m.digits is None else f'ROUND({e}, {m.digits})'} AS {m.type.simpleString()})"


def period_lookups(daily: DataFrame, periods: DataFrame, measures: list[Measure]) -> DataFrame:
    """station, period_id, DayOfYear and the measures, for every period with a row on that day."""
    listed, ends = _period_list(periods)
    scales = _scales(daily)
    sums = sorted({m.column for m in measures if m.kind in ("avg", "sum") and m.column})
    values = sorted({m.column for m in measures if m.kind in ("min", "max") and m.column})
    years = (min(r["year_start"] for r in listed), max(r["year_end"] for r in listed)) if listed else NO_YEARS
    groups = year_arrays(daily, sums, values, ends, years)
    at = {y: i for i, y in enumerate(ends)}
    if "station" in periods.columns:
        place = F.create_map(*[F.lit(x) for kv in at.items() for x in kv]) if at else F.lit(None).cast("map<int,int>")
        own = periods.groupBy("station").agg(F.collect_set(F.struct(
            "period_id", place[F.col("year_start") - 1].alias("lo"), place[F.col("year_end")].alias("hi"))).alias("periods"))
        groups = groups.join(own, "station")
    else:
        rows = ", ".join(f"STRUCT({_text(r['period_id'])} AS period_id, {at[r['year_start'] - 1]} AS lo, "
                         f"{at[r['year_end']]} AS hi)" for r in listed)
        groups = groups.withColumn("periods", F.expr(f"array({rows})") if rows else F.expr(
            "CAST(array() AS ARRAY<STRUCT<period_id: STRING, lo: INT, hi: INT>>)"))
    # positions and lookups before the arrays are left behind: only their results are repeated per period
    found = groups.withColumn("p", F.explode("periods")).select(
        "station", "DayOfYear", "rows", "p.period_id", F.get("pos", "p.lo").alias("lo"), F.get("pos", "p.hi").alias("hi")) \
        .filter("hi > lo")
    last, before, part = "get(rows, hi - 1)", "get(rows, lo - 1)", "slice(rows, lo + 1, hi - lo)"
    extremes = {(m.kind, m.column): f"array_{m.kind}({part}.v_{m.column}) AS {m.kind}_{m.column}"
                for m in measures if m.kind in ("min", "max") and m.column}
    found = found.selectExpr(
        "station", "period_id", "DayOfYear",
        *[f"coalesce({last}.s_{c}, 0) - coalesce({before}.s_{c}, 0) AS s_{c}" for c in sums],
        *[f"coalesce({last}.n_{c}, 0) - coalesce({before}.n_{c}, 0) AS n_{c}" for c in sums], *extremes.values())
    # a projection of its own: the first rounding is evaluated once, not inside the second
    fine = found.selectExpr("*", *[
        f"IF(n_{c} > 0, {half_up_div_sql(f'(s_{c} * 10000)', f'n_{c}')}, NULL) AS f_{c}"
        for c in sorted({m.column for m in measures if m.kind == "avg" and m.column})])

    def result(m: Measure) -> str:
        kind = m.type.simpleString()
        if m.column is None:
            return f"CAST(NULL AS {kind})"
        if m.kind == "avg":
            return _mean_sql(m, scales[m.column])
        if m.kind == "sum":
            return _sum_sql(m, scales[m.column])
        x = f"{m.kind}_{m.column}"
        return f"CAST({x if m.digits is None else f'ROUND({x}, {m.digits})'} AS {kind})"
    return fine.selectExpr("station", "period_id", "DayOfYear", *[f"{result(m)} AS `{m.name}`" for m in measures])


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_CALL = re.compile(r"(AVG|SUM|MIN|MAX)\(\s*(\w+)\s*\)", re.IGNORECASE)
_ROUND = re.compile(r"ROUND\(\s*(.+?\))\s*(?:,\s*(\d+)\s*)?\)", re.IGNORECASE)


def crossref_measures(daily: DataFrame, crossref: dict[str, str]) -> list[Measure] | None:
    """The crossref's measures, typed as its expressions are; None if one is no AVG, SUM, MIN or MAX
    of one column that fits a long."""
    scales, parts = _scales(daily), []
    for name, expr in crossref.items():
        text = expr.strip()
        rounded = _ROUND.fullmatch(text)
        call = _CALL.fullmatch(rounded.group(1) if rounded else text)
        if not call or call.group(2) not in CROSSREF_VIEW:
            return None
        column = CROSSREF_VIEW[call.group(2)]
        if column is not None and column not in scales:
            return None
        parts.append((name, call.group(1).lower(), column, int(rounded.group(2) or 0) if rounded else None))
    # analysed, not run
    types = crossref_view(daily).agg(*[F.expr(e).alias(n) for n, e in crossref.items()]).schema
    return [Measure(*p, types[p[0]].dataType) for p in parts]


def doy_normals_config(daily: DataFrame, periods: DataFrame, crossref: dict[str, str]) -> DataFrame:
    """``SELECT MM-DD AS DayOfYear, <expr> AS <field> ... GROUP BY DayOfYear``."""
    measures = crossref_measures(daily, crossref)
    if measures is not None:
        return period_lookups(daily, periods, measures)
    view = crossref_view(_with_periods(daily, periods), ["period_id"])
    aggs = [F.expr(expr).alias(field) for field, expr in crossref.items()]
    return (view.groupBy("station", "period_id",
                         F.date_format("Date", "MM-dd").alias("DayOfYear"))
            .agg(*aggs))


FIXED_GROUPS = [
    ("Temp", ["temp_avg", "temp_high", "temp_low"], schemas.D31),
    ("DewPoint", ["dewpoint_avg", "dewpoint_high", "dewpoint_low"], schemas.D31),
    ("Humidity", ["humidity_avg", "humidity_high", "humidity_low"], T.IntegerType()),
    ("Pressure", ["pressure_avg", "pressure_high", "pressure_low"], schemas.D51),
]


def _means() -> list[tuple[str, str, T.DataType]]:
    out = []
    for name, cols, typ in FIXED_GROUPS:
        out += [(f"Avg{name}{suf}", c, typ) for suf, c in zip(("Avg", "High", "Low"), cols)]
    out += [(f"Avg{nm}", c, schemas.D41) for nm, c in
            (("WindSpeedMax", "wind_speed_max"), ("GustSpeedMax", "gust_speed_max"),
             ("PrecipitationSum", "precipitation_sum"))]
    return out


def _extremes() -> list[tuple[str, str, str, T.DataType]]:
    out = []
    for name, cols, typ in FIXED_GROUPS:
        for suf, c in zip(("Avg", "High", "Low"), cols):
            out += [(f"Min{name}{suf}", "min", c, typ), (f"Max{name}{suf}", "max", c, typ)]
    out += [("MaxWindSpeedMax", "max", "wind_speed_max", schemas.D41),
            ("MaxGustSpeedMax", "max", "gust_speed_max", schemas.D41),
            ("MinPrecipitationSum", "min", "precipitation_sum", schemas.D41),
            ("MaxPrecipitationSum", "max", "precipitation_sum", schemas.D41)]
    return out


def doy_normals_fixed(daily: DataFrame, periods: DataFrame) -> DataFrame:
    """Fixed avg/min/max per day of year, typed as the normals DDL."""
    means = [Measure(name, "avg", c, _scales(daily)[c], typ) for name, c, typ in _means()]
    return period_lookups(daily, periods, means + [Measure(name, kind, c, None, typ) for name, kind, c, typ in _extremes()])
