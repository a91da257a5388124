"""DuckDB reference SQL for the registered queries.

Written as direct, brute-force SQL over the driver's tables (daily rows are
joined to every period they fall in, extremes are found with a join back),
not as a translation of the Spark plans. Measures are carried as integer
tenths/hundredths and every rounding is done in integer arithmetic:
half up = ``sign(s) * ((2|s| + d) // (2d))``.
"""

from __future__ import annotations

import math
from decimal import Decimal

from ..config import DAY_COUNT_METRICS, RECORD_METRICS, closed_left_metrics
from . import bindings as B

# --- rounding helpers (SQL text) ---------------------------------------------


def hu(s: str, d: str) -> str:
    """round_half_up(s / d) for integers, NULL when d = 0."""
    return (f"(CASE WHEN ({d}) > 0 THEN sign({s}) * ((2 * abs({s}) + ({d})) // (2 * ({d}))) END)")


def tenths(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 10)"


def mean1(col: str, scale_in: int = 1) -> str:
    """round(avg(col), 1) in exact arithmetic; col holds 10^scale_in units."""
    s = f"CAST(sum({col}) AS BIGINT)"
    n = f"count({col})"
    d = n if scale_in == 1 else f"({n} * {10 ** (scale_in - 1)})"
    return tenths(hu(s, d))


def mean_spark5(col: str, out_int: bool = False, as_type: str = "DOUBLE") -> str:
    """ROUND(AVG(decimal)) with the avg first rounded to scale + 4 digits."""
    s = f"CAST(sum({col}) AS BIGINT)"
    n = f"count({col})"
    q = hu(f"({s} * 10000)", n)
    r = hu(q, "10000")
    return f"CAST({r} AS {as_type})" if out_int else tenths(r)


# --- bound inputs -------------------------------------------------------------

def ev_cte() -> str:
    return f"""ev AS (
  SELECT event_id, user_id, ts FROM events
  UNION ALL
  SELECT event_id + {B.RESENT_OFFSET}, user_id, ts FROM events WHERE event_id % {B.RESENT_MOD} = 3)"""


def obs_ctes() -> str:
    cols = ",\n    ".join(f"{v} AS {k}" for k, v in B.OBS_INT.items())
    return f"""{ev_cte()},
obs_raw AS (
  SELECT {B.OBS_STATION} AS station, date_trunc('second', ts) AS obs_ts,
    {cols},
    event_id AS arrival
  FROM ev),
obs AS (
  SELECT * FROM obs_raw
  QUALIFY row_number() OVER (PARTITION BY station, obs_ts ORDER BY arrival) = 1)"""


def stations_cte() -> str:
    rows = ", ".join(f"({i}, {lat!r}, {lon!r}, '{tz}', '{r}')" for i, (_, lat, lon, tz, r) in enumerate(B.STATIONS))
    return f"""stations AS (
  SELECT {B.OBS_STATION} AS station, lat, lon, tz, region
  FROM (SELECT DISTINCT user_id FROM events) u
  JOIN (VALUES {rows}) AS places(i, lat, lon, tz, region) ON u.user_id % {len(B.STATIONS)} = places.i)"""


def periods_cte() -> str:
    rows = ", ".join(f"('{p.period_id}', {p.year_start}, {p.year_end})" for p in B.PERIODS)
    return f"periods(period_id, year_start, year_end) AS (VALUES {rows})"


def daily_ctes(name: str = "daily", wide: bool = False) -> str:
    aggs = ",\n    ".join(f"{v} AS {k}" for k, v in B.DAILY_AGG.items())
    src, station = "orders", B.DAILY_STATION.replace("STRING", "VARCHAR").replace(" div ", " // ")
    if wide:
        station = "station"
        cols = ", ".join(f"{v.replace('STRING', 'VARCHAR')} AS {k}" for k, v in B.WIDE_SOURCE.items())
        src = f"(SELECT {cols} FROM lineitem)"
    dead = "date_diff('day', DATE '1970-01-01', date) % 23 = 0"

    def v(e):
        return f"CASE WHEN {dead} THEN NULL ELSE {e} END"
    return f"""d0 AS (
  SELECT {station} AS station, CAST(o_orderdate AS DATE) AS date,
    {aggs}
  FROM {src} GROUP BY 1, 2),
{name} AS (
  SELECT station, date,
    {v('(least(a, b) + greatest(a, b)) // 2')} AS temp_avg,
    {v('greatest(a, b)')} AS temp_high,
    {v('least(a, b)')} AS temp_low,
    {v('(least(a, b) + greatest(a, b) - 2 * dd - 5) // 2')} AS dewpoint_avg,
    {v('greatest(a, b) - dd')} AS dewpoint_high,
    {v('least(a, b) - dd - 5')} AS dewpoint_low,
    {v('(2 * hlow + hspan) // 2')} AS humidity_avg,
    {v('hlow + hspan')} AS humidity_high,
    {v('hlow')} AS humidity_low,
    {v('(2 * plow10 + pspan10) // 2')} AS pressure_avg,
    {v('plow10 + pspan10')} AS pressure_high,
    {v('plow10')} AS pressure_low,
    {v('wind10')} AS wind_speed_max,
    {v('wind10 + gustx10')} AS gust_speed_max,
    {v('rain10')} AS precipitation_sum,
    {v('solar10')} AS solar_radiation_avg
  FROM d0)"""


DAILY_TENTHS = ["temp_avg", "temp_high", "temp_low", "dewpoint_avg", "dewpoint_high",
                "dewpoint_low", "pressure_avg", "pressure_high", "pressure_low",
                "wind_speed_max", "gust_speed_max", "precipitation_sum", "solar_radiation_avg"]
DAILY_INTS = ["humidity_avg", "humidity_high", "humidity_low"]
DAILY_COLS = ["temp_avg", "temp_high", "temp_low", "dewpoint_avg", "dewpoint_high",
              "dewpoint_low", "humidity_avg", "humidity_high", "humidity_low",
              "pressure_avg", "pressure_high", "pressure_low", "wind_speed_max",
              "gust_speed_max", "precipitation_sum", "solar_radiation_avg"]


def daily2_cte() -> str:
    shifted = f"date + INTERVAL {B.DAILY2_SHIFT} DAY"
    dayno = f"date_diff('day', DATE '1970-01-01', CAST({shifted} AS DATE))"
    cols = []
    for c in DAILY_COLS:
        if c == "temp_low":
            cols.append("temp_low + 7 AS temp_low")
        elif c == "precipitation_sum":
            cols.append(f"CASE WHEN {dayno} % 5 <> 0 THEN precipitation_sum END AS precipitation_sum")
        else:
            cols.append(c)
    return f"""daily2 AS (
  SELECT station, CAST({shifted} AS DATE) AS date, {', '.join(cols)}
  FROM daily WHERE date >= DATE '{B.DAILY2_FROM.isoformat()}')"""


def daily_out(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    out = []
    for c in DAILY_COLS:
        if c in DAILY_INTS:
            out.append(f"CAST({p}{c} AS BIGINT) AS {c}")
        else:
            out.append(f"{tenths(p + c)} AS {c}")
    return ", ".join(out)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- observation queries ------------------------------------------------------

def rollup_select(src: str = "obs") -> str:
    return f"""SELECT station, CAST(obs_ts AS DATE) AS date,
    {mean1('temp10')} AS temp_avg,
    {tenths('max(temp10)')} AS temp_high,
    {tenths('min(temp10)')} AS temp_low,
    {mean1('dewpt10')} AS dewpoint_avg,
    {tenths('max(dewpt10)')} AS dewpoint_high,
    {tenths('min(dewpt10)')} AS dewpoint_low,
    CAST({hu('CAST(sum(humidity) AS BIGINT)', 'count(humidity)')} AS BIGINT) AS humidity_avg,
    CAST(max(humidity) AS BIGINT) AS humidity_high,
    CAST(min(humidity) AS BIGINT) AS humidity_low,
    {mean1('pressure100', 2)} AS pressure_avg,
    {tenths(hu('max(pressure100)', '10'))} AS pressure_high,
    {tenths(hu('min(pressure100)', '10'))} AS pressure_low,
    {tenths('max(wind10)')} AS wind_speed_max,
    {tenths('max(gust10)')} AS gust_speed_max,
    {tenths(hu('max(rain100)', '10'))} AS precipitation_sum
  FROM {src} GROUP BY 1, 2"""


def q_daily_rollup() -> str:
    return with_(obs_ctes()) + f"""SELECT r.*, CAST(NULL AS DOUBLE) AS solar_radiation_avg
FROM ({rollup_select()}) r"""


# The published sunrise equation, stated here again so that the oracle does not
# follow the library.
SUN = {"MEAN_ANOMALY_0": 357.5291, "MEAN_ANOMALY_RATE": 0.98560028, "CENTRE_1": 1.9148, "CENTRE_2": 0.02,
       "CENTRE_3": 0.0003, "PERIHELION": 102.9372, "J2000": 2451545.0, "TRANSIT_M": 0.0053, "TRANSIT_L": 0.0069,
       "OBLIQUITY": 23.4397, "HORIZON": -0.833, "UNIX_EPOCH_JD": 2440587.5}


def sun_sql(date: str, lat: str, lon: str) -> tuple[str, str]:
    """Same published equation as ``functions.sun``, as DuckDB SQL."""
    n = f"CAST(date_diff('day', DATE '2000-01-01', {date}) AS DOUBLE)"
    jstar = f"({n} - {lon} / 360.0)"
    m = f"({SUN['MEAN_ANOMALY_0']!r} + {SUN['MEAN_ANOMALY_RATE']!r} * {jstar})"

    def sd(x):
        return f"sin(radians({x}))"
    c = (f"({SUN['CENTRE_1']!r} * {sd(m)} + {SUN['CENTRE_2']!r} * {sd(f'{m} * 2')}"
         f" + {SUN['CENTRE_3']!r} * {sd(f'{m} * 3')})")
    lam = f"({m} + {c} + {180.0 + SUN['PERIHELION']!r})"
    transit = (f"({SUN['J2000']!r} + {jstar} + {SUN['TRANSIT_M']!r} * {sd(m)}"
               f" - {SUN['TRANSIT_L']!r} * {sd(f'{lam} * 2')})")
    sin_d = f"({sd(lam)} * {math.sin(math.radians(SUN['OBLIQUITY']))!r})"
    cos_d = f"cos(asin({sin_d}))"
    cos_w = (f"(({math.sin(math.radians(SUN['HORIZON']))!r} - {sd(lat)} * {sin_d})"
             f" / (cos(radians({lat})) * {cos_d}))")
    w = f"(CASE WHEN abs({cos_w}) <= 1.0 THEN degrees(acos({cos_w})) END)"
    rise = f"(({transit} - {w} / 360.0 - {SUN['UNIX_EPOCH_JD']!r}) * 86400.0)"
    sset = f"(({transit} + {w} / 360.0 - {SUN['UNIX_EPOCH_JD']!r}) * 86400.0)"
    return f"CAST(floor({rise}) AS BIGINT)", f"CAST(floor({sset}) AS BIGINT)"


def sun_cte(src: str = "obs") -> str:  # noqa: D401
    rise, sset = sun_sql("d.date", "s.lat", "s.lon")
    return f"""days AS (SELECT DISTINCT station, CAST(obs_ts AS DATE) AS date FROM {src}),
sun0 AS (
  SELECT d.station, d.date, s.tz, {rise} AS rise_s, {sset} AS set_s
  FROM days d JOIN stations s USING (station)),
sun AS (
  SELECT station, date, rise_s, set_s,
    timezone(tz, to_timestamp(rise_s)) AS sunrise,
    timezone(tz, to_timestamp(set_s)) AS sunset
  FROM sun0)"""


def q_daylight_solar() -> str:
    return with_(obs_ctes(), stations_cte(), sun_cte()) + f"""SELECT s.station, s.date, s.sunrise, s.sunset,
  CAST((s.set_s - s.rise_s) // 3600 AS BIGINT) AS day_hours,
  CAST(((s.set_s - s.rise_s) % 3600) // 60 AS BIGINT) AS day_minutes,
  CAST((s.set_s - s.rise_s) % 60 AS BIGINT) AS day_seconds,
  {mean1('CASE WHEN o.obs_ts BETWEEN s.sunrise AND s.sunset THEN o.solar10 END')} AS solar_radiation_avg,
  count(CASE WHEN o.obs_ts BETWEEN s.sunrise AND s.sunset THEN 1 END) AS n_daylight_obs
FROM obs o JOIN sun s ON o.station = s.station AND CAST(o.obs_ts AS DATE) = s.date
GROUP BY s.station, s.date, s.sunrise, s.sunset, s.rise_s, s.set_s"""


def _solar_cte(src: str = "obs") -> str:
    return f"""solar AS (
  SELECT s.station, s.date,
    {mean1('CASE WHEN o.obs_ts BETWEEN s.sunrise AND s.sunset THEN o.solar10 END')} AS solar_radiation_avg
  FROM {src} o JOIN sun s ON o.station = s.station AND CAST(o.obs_ts AS DATE) = s.date
  GROUP BY s.station, s.date)"""


def q_daily_with_solar() -> str:
    return with_(obs_ctes(), stations_cte(), sun_cte(), _solar_cte()) + f"""SELECT r.*, solar.solar_radiation_avg
FROM ({rollup_select()}) r JOIN solar USING (station, date)"""


def _spine(start, end) -> str:
    return f"""(SELECT station, CAST(g.d AS DATE) AS date FROM stations,
      generate_series(DATE '{start.isoformat()}', DATE '{end.isoformat()}',
                      INTERVAL 1 DAY) AS g(d)) sp"""


def q_daily_rollup_spine() -> str:
    return with_(obs_ctes(), stations_cte()) + f"""SELECT sp.station, sp.date,
  r.temp_avg, r.temp_high, r.temp_low, r.dewpoint_avg, r.dewpoint_high, r.dewpoint_low,
  r.humidity_avg, r.humidity_high, r.humidity_low, r.pressure_avg, r.pressure_high,
  r.pressure_low, r.wind_speed_max, r.gust_speed_max, r.precipitation_sum,
  CAST(NULL AS DOUBLE) AS solar_radiation_avg
FROM {_spine(B.SPINE_START, B.SPINE_END)}
LEFT JOIN ({rollup_select()}) r ON r.station = sp.station AND r.date = sp.date"""


OBS_OUT = [("temp", "temp10", 1), ("humidity", "humidity", 0), ("precip_rate", "rate100", 2),
           ("precip_total", "rain100", 2), ("pressure", "pressure100", 2),
           ("heat_index", "heat10", 1), ("wind_speed", "wind10", 1), ("wind_gust", "gust10", 1),
           ("wind_chill", "chill10", 1), ("wind_dir", "winddir", 0), ("dewpt", "dewpt10", 1),
           ("elev", "elev10", 1), ("solar_radiation", "solar10", 1), ("uv", "uv10", 1)]


def obs_out(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    out = []
    for name, src, sc in OBS_OUT:
        if sc == 0:
            out.append(f"CAST({p}{src} AS BIGINT) AS {name}")
        else:
            out.append(f"CAST({p}{src} AS DOUBLE) / {10 ** sc} AS {name}")
    return ", ".join(out)


def q_insert_if_absent() -> str:
    return with_(obs_ctes(), f"""tgt AS (SELECT * FROM obs WHERE obs_ts < TIMESTAMP '{B.TARGET_BEFORE}'),
src AS (
  SELECT * FROM obs_raw WHERE obs_ts >= TIMESTAMP '{B.SOURCE_FROM}'
  QUALIFY row_number() OVER (PARTITION BY station, obs_ts ORDER BY arrival) = 1),
merged AS (
  SELECT * FROM tgt
  UNION ALL
  SELECT * FROM src WHERE NOT EXISTS (
    SELECT 1 FROM tgt WHERE tgt.station = src.station AND tgt.obs_ts = src.obs_ts))""") + \
        f"SELECT station, obs_ts, {obs_out()} FROM merged"


# --- upserts -----------------------------------------------------------------

UPSERT_FIELDS = ["temp_low", "precipitation_sum"]


def _upsert(fields: list[str] | None) -> str:
    cols = []
    for c in DAILY_COLS:
        if fields is None or c in fields:
            e = f"CASE WHEN s.station IS NOT NULL THEN s.{c} ELSE t.{c} END"
        else:
            e = f"CASE WHEN s.station IS NOT NULL AND t.station IS NULL THEN s.{c} ELSE t.{c} END"
        cols.append(f"CAST({e} AS BIGINT) AS {c}" if c in DAILY_INTS else f"{tenths(e)} AS {c}")
    return with_(daily_ctes(), daily2_cte()) + f"""SELECT coalesce(s.station, t.station) AS station,
  coalesce(s.date, t.date) AS date, {', '.join(cols)}
FROM daily t FULL OUTER JOIN daily2 s ON t.station = s.station AND t.date = s.date"""


def q_upsert_full() -> str:
    return _upsert(None)


def q_upsert_fields() -> str:
    return _upsert(UPSERT_FIELDS)


def q_upsert_changes() -> str:
    diffs = ", ".join(f"CASE WHEN s.{c} IS DISTINCT FROM t.{c} THEN '{c}' END" for c in DAILY_COLS)
    return with_(daily_ctes(), daily2_cte()) + f"""SELECT s.station, s.date,
  CASE WHEN t.station IS NULL THEN 'insert' ELSE 'update' END AS action,
  CASE WHEN t.station IS NULL THEN NULL ELSE concat_ws(',', {diffs}) END AS changed
FROM daily2 s LEFT JOIN daily t ON t.station = s.station AND t.date = s.date"""


# --- period normals ----------------------------------------------------------

def _period_join() -> str:
    return f"""py AS (
  SELECT period_id, year_start, year_end, unnest(range(year_start, year_end + 1)) AS year
  FROM periods),
j AS (
  SELECT d.*, year(d.date) AS year, month(d.date) AS month, py.period_id,
    py.year_start, py.year_end
  FROM daily d JOIN py ON year(d.date) = py.year)"""


def _base(wide: bool = False) -> str:
    return with_(daily_ctes(wide=wide), periods_cte(), _period_join())


def q_period_means() -> str:
    ny = "count(DISTINCT year)"
    return _base() + f"""SELECT station, period_id, CAST(year_start AS BIGINT) AS year_start,
  CAST(year_end AS BIGINT) AS year_end, {ny} AS n_years,
  {mean1('temp_avg')} AS Avg_TempAvg,
  {mean1('temp_high')} AS Avg_TempHigh,
  {mean1('temp_low')} AS Avg_TempLow,
  {tenths(hu('CAST(coalesce(sum(precipitation_sum), 0) AS BIGINT)', ny))} AS Yearly_Avg_Precipitation,
  {mean1('precipitation_sum')} AS Avg_Daily_Precipitation
FROM j GROUP BY station, period_id, year_start, year_end"""


def q_station_periods() -> str:
    """Period means and day counts of the periods that each station's number chooses."""
    n = len(B.PERIODS)
    order = ", ".join(f"('{p.period_id}', {i})" for i, p in enumerate(B.PERIODS))
    mine = f"""o(period_id, i) AS (VALUES {order}),
mine AS (SELECT j.* FROM j JOIN o USING (period_id)
  WHERE i IN (CAST(substr(station, 2) AS INT) % {n}, (CAST(substr(station, 2) AS INT) + 2) % {n}))"""
    body = q_period_means().split("SELECT station, period_id, CAST", 1)[1]
    return with_(daily_ctes(), periods_cte(), _period_join(), mine) + f"""SELECT m.*, x.Max_TempHigh, x.n_days FROM (
SELECT station, period_id, CAST{body.replace('FROM j GROUP', 'FROM mine GROUP')}) m
JOIN (SELECT station, period_id, {tenths('max(temp_high)')} AS Max_TempHigh,
             count(DISTINCT strftime(date, '%m-%d')) AS n_days FROM mine GROUP BY ALL) x USING (station, period_id)"""


def _pred_sql(m) -> str:
    c = m.column
    parts = [f"{c} IS NOT NULL"]
    if m.lo is not None:
        lo = Decimal(str(m.lo)) * 10
        parts.append(f"{c} {'>=' if m.lo_closed else '>'} {lo}")
    if m.hi is not None:
        hi = Decimal(str(m.hi)) * 10
        parts.append(f"{c} {'<=' if m.hi_closed else '<'} {hi}")
    return " AND ".join(parts)


def _count_cols(metrics) -> str:
    ny = "count(DISTINCT year)"
    return ",\n  ".join(
        f"CAST(round_even(sum(CASE WHEN {_pred_sql(m)} THEN 1 ELSE 0 END) / {ny}, 0) AS BIGINT) AS {m.name}"
        for m in metrics)


def q_day_counts(metrics=None) -> str:
    metrics = metrics or DAY_COUNT_METRICS
    return _base() + f"""SELECT station, period_id, count(DISTINCT year) AS n_years,
  {_count_cols(metrics)}
FROM j GROUP BY station, period_id"""


def q_day_counts_closed_left() -> str:
    return q_day_counts(closed_left_metrics())


def _records_union() -> str:
    parts = []
    for r in RECORD_METRICS:
        agg = "max" if r.kind == "max" else "min"
        parts.append(f"""SELECT j.station, j.period_id, '{r.name}' AS metric,
  CAST(j.date AS VARCHAR) AS Date, printf('%.1f', j.{r.column} / 10.0) AS Value
FROM j JOIN (SELECT station, period_id, {agg}({r.column}) AS v FROM j GROUP BY 1, 2) e
  ON j.station = e.station AND j.period_id = e.period_id AND j.{r.column} = e.v""")
    return "\nUNION ALL\n".join(parts)


def q_records() -> str:
    return _base() + _records_union()


def q_monthly_normals() -> str:
    ny = "count(DISTINCT year)"
    return _base() + f"""SELECT station, period_id, CAST(month AS BIGINT) AS month,
  {mean1('temp_avg')} AS Avg_TempAvg,
  {mean1('temp_high')} AS Avg_TempHigh,
  {mean1('temp_low')} AS Avg_TempLow,
  {tenths('max(temp_high)')} AS Max_TempHigh_Max,
  {tenths('min(temp_high)')} AS Max_TempHigh_Min,
  {tenths('max(temp_low)')} AS Min_TempLow_Max,
  {tenths('min(temp_low)')} AS Min_TempLow_Min,
  {tenths(hu('CAST(coalesce(sum(precipitation_sum), 0) AS BIGINT)', ny))} AS Avg_Monthly_Precipitation,
  CAST(round_even(sum(CASE WHEN precipitation_sum >= 10 THEN 1 ELSE 0 END) / {ny}, 0) AS BIGINT)
    AS Avg_Days_Precipitation_1,
  monthname(make_date(2000, CAST(month AS INTEGER), 1)) AS month_name
FROM j GROUP BY station, period_id, month"""


def q_period_summary(wide: bool = False) -> str:
    ny = "count(DISTINCT year)"
    rec = ",\n  ".join(
        f"max(CASE WHEN r.metric = '{m.name}' THEN r.Value END) AS {m.name}_Value,\n"
        f"  string_agg(CASE WHEN r.metric = '{m.name}' THEN r.Date END, ',' ORDER BY r.Date) AS {m.name}_Dates"
        for m in RECORD_METRICS)
    return _base(wide) + f""", recs AS ({_records_union()}),
scal AS (
  SELECT station, period_id, CAST(year_start AS BIGINT) AS year_start,
    CAST(year_end AS BIGINT) AS year_end, {ny} AS n_years,
    {mean1('temp_avg')} AS Avg_TempAvg,
    {mean1('temp_high')} AS Avg_TempHigh,
    {mean1('temp_low')} AS Avg_TempLow,
    {tenths(hu('CAST(coalesce(sum(precipitation_sum), 0) AS BIGINT)', ny))} AS Yearly_Avg_Precipitation,
    {mean1('precipitation_sum')} AS Avg_Daily_Precipitation,
    {_count_cols(DAY_COUNT_METRICS)}
  FROM j GROUP BY station, period_id, year_start, year_end)
SELECT scal.*, {rec}
FROM scal LEFT JOIN recs r ON r.station = scal.station AND r.period_id = scal.period_id
GROUP BY ALL"""


# --- day-of-year normals -----------------------------------------------------

CROSSREF_SOURCE = {
    "AvgTemp": "temp_avg", "MaxTemp": "temp_high", "MinTemp": "temp_low",
    "DewPoint": "dewpoint_avg", "MaxDewPoint": "dewpoint_high", "MinDewPoint": "dewpoint_low",
    "Humidity": "humidity_avg", "MaxHumidity": "humidity_high", "MinHumidity": "humidity_low",
    "Pressure": "pressure_avg", "MaxPressure": "pressure_high", "MinPressure": "pressure_low",
    "WindSpeed": "wind_speed_max", "GustSpeed": "gust_speed_max",
    "Precipitation": "precipitation_sum", "SolarRadiation": "solar_radiation_avg",
    "UVIndex": None, "WindChill": None, "HeatIndex": None,
}


def _doy_expr(fn: str, src: str | None, rounded: bool, is_int: bool) -> str:
    if src is None:
        return "CAST(NULL AS DOUBLE)"
    if fn == "AVG":
        return mean_spark5(src, out_int=is_int)
    if fn == "SUM":
        return tenths(f"CAST(sum({src}) AS BIGINT)")
    e = f"{fn.lower()}({src})"
    return f"CAST({e} AS DOUBLE)" if is_int else tenths(e)


def _parse_crossref(expr: str) -> tuple[str, str]:
    inner = expr.replace("ROUND(", "").replace(")", "").replace(", 1", "").strip()
    fn, col = inner.split("(")
    return fn.strip().upper(), col.strip()


def q_doy_normals_config(crossref: dict[str, str]) -> str:
    cols = []
    for field, expr in crossref.items():
        fn, col = _parse_crossref(expr)
        src = CROSSREF_SOURCE[col]
        is_int = src in DAILY_INTS if src else False
        cols.append(f"{_doy_expr(fn, src, True, is_int)} AS {field}")
    return _base() + f"""SELECT station, period_id, strftime(date, '%m-%d') AS DayOfYear,
  {', '.join(cols)}
FROM j GROUP BY station, period_id, strftime(date, '%m-%d')"""


FIXED_DOY_GROUPS = [
    ("Temp", ["temp_avg", "temp_high", "temp_low"]),
    ("DewPoint", ["dewpoint_avg", "dewpoint_high", "dewpoint_low"]),
    ("Humidity", ["humidity_avg", "humidity_high", "humidity_low"]),
    ("Pressure", ["pressure_avg", "pressure_high", "pressure_low"]),
]


def q_doy_normals_fixed(wide: bool = False) -> str:
    cols = []
    for name, (a, h, lo) in FIXED_DOY_GROUPS:
        is_int = name == "Humidity"
        trip = [("Avg", a), ("High", h), ("Low", lo)]
        for suf, c in trip:
            cols.append(f"{mean_spark5(c, is_int, 'BIGINT')} AS Avg{name}{suf}")
        for suf, c in trip:
            for fn in ("MIN", "MAX"):
                e = f"CAST({fn.lower()}({c}) AS BIGINT)" if is_int else tenths(f"{fn.lower()}({c})")
                cols.append(f"{e} AS {fn.capitalize()}{name}{suf}")
    for nm, c in [("WindSpeedMax", "wind_speed_max"), ("GustSpeedMax", "gust_speed_max")]:
        cols.append(f"{mean_spark5(c)} AS Avg{nm}")
        cols.append(f"{tenths(f'max({c})')} AS Max{nm}")
    cols.append(f"{mean_spark5('precipitation_sum')} AS AvgPrecipitationSum")
    cols.append(f"{tenths('min(precipitation_sum)')} AS MinPrecipitationSum")
    cols.append(f"{tenths('max(precipitation_sum)')} AS MaxPrecipitationSum")
    return _base(wide) + f"""SELECT station, period_id, strftime(date, '%m-%d') AS DayOfYear,
  {', '.join(cols)}
FROM j GROUP BY station, period_id, strftime(date, '%m-%d')"""


# --- payload ingest ----------------------------------------------------------

def q_observation_flatten() -> str:
    w = "((event_id * 11) % 300)"
    g = "((event_id * 3) % 100)"
    o = B.OBS_INT
    return with_(ev_cte()) + f"""SELECT {B.OBS_STATION} AS station, date_trunc('second', ts) AS obs_ts,
  {tenths(o['temp10'])} AS temp,
  CAST({o['humidity']} AS BIGINT) AS humidity,
  CAST({o['rate100']} AS DOUBLE) / 100 AS precip_rate,
  CAST({o['rain100']} AS DOUBLE) / 100 AS precip_total,
  CAST({o['pressure100']} AS DOUBLE) / 100 AS pressure,
  {tenths(o['heat10'])} AS heat_index,
  {tenths(f'3 * {w}')} AS wind_speed,
  {tenths(f'3 * ({w} + {g})')} AS wind_gust,
  {tenths(o['chill10'])} AS wind_chill,
  CAST({o['winddir']} AS BIGINT) AS wind_dir,
  {tenths(o['dewpt10'])} AS dewpt,
  {tenths(o['elev10'])} AS elev,
  {tenths(o['solar10'])} AS solar_radiation,
  {tenths(o['uv10'])} AS uv,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS obs_time_utc,
  CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch
FROM ev WHERE event_id % {B.MSG_EMPTY_MOD} <> 0"""


def q_history_map() -> str:
    def r(x):
        return f"CAST(round(CAST({x} AS DOUBLE) / 10) AS BIGINT)"
    return with_(daily_ctes()) + f"""SELECT station, date,
  {tenths('temp_high')} AS temperature_high_c, {tenths('temp_avg')} AS temperature_avg_c,
  {tenths('temp_low')} AS temperature_low_c, {tenths('dewpoint_high')} AS dewpoint_high_c,
  {tenths('dewpoint_avg')} AS dewpoint_avg_c, {tenths('dewpoint_low')} AS dewpoint_low_c,
  CAST(humidity_high AS BIGINT) AS humidity_high, CAST(humidity_avg AS BIGINT) AS humidity_avg,
  CAST(humidity_low AS BIGINT) AS humidity_low,
  {r('pressure_high')} AS pressure_max_hpa, {r('pressure_low')} AS pressure_min_hpa,
  {r('wind_speed_max')} AS wind_speed_max_kmh,
  CAST(round(CAST(wind_speed_max AS DOUBLE) / 20) AS BIGINT) AS wind_speed_avg_kmh,
  {r('gust_speed_max')} AS gust_speed_max_kmh,
  CAST(precipitation_sum AS DOUBLE) / 100 AS precipitation_sum_cm
FROM daily WHERE temp_high IS NOT NULL"""


def _console_base() -> str:
    shown = (f"CASE WHEN arrival % {B.CONSOLE_GLITCH_MOD} = 7 THEN CAST(obs_ts AS DATE) - 1 "
             f"ELSE CAST(obs_ts AS DATE) END")
    return f"""con AS (
  SELECT station, station || '_' || strftime(obs_ts, '%Y%m') AS source_file,
    arrival AS No, {shown} AS date,
    temp10, humidity, dewpt10, pressure100, wind10, gust10, rain100
  FROM obs)"""


def _console_stats() -> str:
    def m0(c):
        return tenths(hu(f"CAST(sum({c}) AS BIGINT) * 10", f"count({c})"))
    return f"""{tenths('max(temp10)')} AS temp_max, {mean1('temp10')} AS temp_avg,
  {tenths('min(temp10)')} AS temp_min,
  CAST(max(humidity) AS DOUBLE) AS humidity_max, {m0('humidity')} AS humidity_avg,
  CAST(min(humidity) AS DOUBLE) AS humidity_min,
  {tenths('max(dewpt10)')} AS dewpoint_max, {mean1('dewpt10')} AS dewpoint_avg,
  {tenths('min(dewpt10)')} AS dewpoint_min,
  CAST(max(pressure100) AS DOUBLE) / 100 AS pressure_max,
  CAST(min(pressure100) AS DOUBLE) / 100 AS pressure_min,
  {tenths('max(wind10)')} AS wind_max, {mean1('wind10')} AS wind_avg,
  {tenths('max(gust10)')} AS gust_max,
  CAST({hu('max(rain100)', '10')} AS DOUBLE) / 100 AS rain_cm"""


STAT_FIELDS = ["temp_max", "temp_avg", "temp_min", "humidity_max", "humidity_avg", "humidity_min",
               "dewpoint_max", "dewpoint_avg", "dewpoint_min", "pressure_max", "pressure_min",
               "wind_max", "wind_avg", "gust_max", "rain_cm"]


def _line() -> str:
    parts = ["strftime(date, '%d/%m/%Y')"] + \
        [f"coalesce(replace(CAST({c} AS VARCHAR), '.', ','), 'None')" for c in STAT_FIELDS]
    return "concat_ws(';', " + ", ".join(parts) + ") AS line"


def q_console_daily() -> str:
    return with_(obs_ctes(), _console_base(), f"""st AS (
  SELECT station, date, {_console_stats()} FROM con GROUP BY station, date)""") + \
        f"SELECT *, {_line()} FROM st"


def q_console_runs() -> str:
    return with_(obs_ctes(), _console_base(), f"""fl AS (
  SELECT *, CASE WHEN lag(date) OVER (PARTITION BY station, source_file ORDER BY No)
                      IS NOT DISTINCT FROM date THEN 0 ELSE 1 END AS is_new
  FROM con),
rn AS (
  SELECT *, sum(is_new) OVER (PARTITION BY station, source_file ORDER BY No
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM fl),
st AS (
  SELECT station, source_file, CAST(run AS BIGINT) AS run, date, {_console_stats()}
  FROM rn GROUP BY station, source_file, run, date)""") + f"SELECT *, {_line()} FROM st"


def q_official_import(where: str = "", half: str | None = None) -> str:
    dn = "date_diff('day', DATE '1970-01-01', date)"
    tm = (f"CASE WHEN {dn} % {B.OFFICIAL_TM_GAP_MOD} = 0 THEN "
          f"(CASE WHEN temp_high IS NOT NULL AND temp_low IS NOT NULL THEN {half or '(temp_high + temp_low) // 2'} END) "
          f"ELSE temp_avg END")
    pavg = f"CASE WHEN {dn} % {B.OFFICIAL_PMERM_GAP_MOD} = 0 THEN NULL ELSE pressure_avg END"
    fxy = (f"CASE WHEN {dn} % {B.OFFICIAL_FXY_INT_MOD} = 0 THEN 36 * (wind_speed_max // 10) "
           f"ELSE (wind_speed_max * 36) // 10 END")
    return with_(daily_ctes()) + f"""SELECT station, date,
  {tenths(tm)} AS temp_avg, {tenths('temp_high')} AS temp_high, {tenths('temp_low')} AS temp_low,
  CAST(NULL AS DOUBLE) AS dewpoint_avg, CAST(NULL AS DOUBLE) AS dewpoint_high,
  CAST(NULL AS DOUBLE) AS dewpoint_low,
  CAST(humidity_avg AS BIGINT) AS humidity_avg, CAST(humidity_high AS BIGINT) AS humidity_high,
  CAST(humidity_low AS BIGINT) AS humidity_low,
  {tenths(pavg)} AS pressure_avg, {tenths(f'2 * ({pavg}) - pressure_low')} AS pressure_high,
  {tenths('pressure_low')} AS pressure_low,
  {tenths(fxy)} AS wind_speed_max, {tenths('(gust_speed_max * 36) // 10')} AS gust_speed_max,
  {tenths('precipitation_sum')} AS precipitation_sum, CAST(NULL AS DOUBLE) AS solar_radiation_avg
FROM daily{where}"""


def q_official_filtered() -> str:
    names = ", ".join(f"'{s}'" for s in B.OFFICIAL_STATIONS)
    lo, hi = B.OFFICIAL_YEARS
    half = hu("(temp_high + temp_low)", "2")
    return q_official_import(f""" WHERE station IN ({names}) AND year(date) BETWEEN {lo} AND {hi}
  AND day(date) % 10 <> 7""", half)


# --- documents -----------------------------------------------------------------

def q_summary_long() -> str:
    from ..config import METRIC_DESCRIPTIONS, MONTH_NAMES
    ny = "count(DISTINCT year)"
    desc = ", ".join(f"('{k}', '{v}')" for k, v in METRIC_DESCRIPTIONS.items())
    scal_cols = ["Avg_TempAvg", "Avg_TempHigh", "Avg_TempLow", "Yearly_Avg_Precipitation",
                 "Avg_Daily_Precipitation"] + [m.name for m in DAY_COUNT_METRICS]
    kv = [f"SELECT s.station, s.period_id, '_comments_' || c.metric AS metric, c.description AS value "
          f"FROM scal s, descr c"]
    kv += [f"SELECT station, period_id, '{c}', CAST({c} AS VARCHAR) FROM scal" for c in scal_cols]
    for m in RECORD_METRICS:
        kv.append(f"""SELECT s.station, s.period_id, '{m.name}', coalesce((
    SELECT '[' || string_agg('{{"Date":"' || r.Date || '","Value":"' || r.Value || '"}}', ',' ORDER BY r.Date) || ']'
    FROM recs r WHERE r.station = s.station AND r.period_id = s.period_id AND r.metric = '{m.name}'), '[]')
  FROM scal s""")
    leaves = ["Avg_TempAvg", "Avg_TempHigh", "Avg_TempLow", "Max_TempHigh_Max", "Max_TempHigh_Min",
              "Min_TempLow_Max", "Min_TempLow_Min", "Avg_Monthly_Precipitation",
              "Avg_Days_Precipitation_1"]
    for leaf in leaves:
        kv.append(f"""SELECT s.station, s.period_id, mn.name || '_{leaf}', CAST(mo.{leaf} AS VARCHAR)
  FROM scal s CROSS JOIN mnames mn
  LEFT JOIN mon mo ON mo.station = s.station AND mo.period_id = s.period_id AND mo.month = mn.month""")
    mnames = ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(MONTH_NAMES))
    mon_sql = q_monthly_normals().split("\nSELECT ", 1)
    mon_body = "SELECT " + mon_sql[1]
    return _base() + f""", recs AS ({_records_union()}),
scal AS (
  SELECT station, period_id, {ny} AS n_years,
    {mean1('temp_avg')} AS Avg_TempAvg,
    {mean1('temp_high')} AS Avg_TempHigh,
    {mean1('temp_low')} AS Avg_TempLow,
    {tenths(hu('CAST(coalesce(sum(precipitation_sum), 0) AS BIGINT)', ny))} AS Yearly_Avg_Precipitation,
    {mean1('precipitation_sum')} AS Avg_Daily_Precipitation,
    {_count_cols(DAY_COUNT_METRICS)}
  FROM j GROUP BY station, period_id),
mon AS ({mon_body}),
descr(metric, description) AS (VALUES {desc}),
mnames(month, name) AS (VALUES {mnames}),
kv AS (
{chr(10).join(('  ' if i == 0 else '  UNION ALL ') + q for i, q in enumerate(kv))})
SELECT kv.metric, kv.station, kv.period_id, kv.value, descr.description
FROM kv LEFT JOIN descr ON descr.metric = kv.metric"""


def q_normals_union() -> str:
    body = q_doy_normals_fixed().split("\nSELECT ", 1)
    sel = body[1].replace("strftime(date, '%m-%d') AS DayOfYear,",
                          "strftime(date, '%m-%d') AS DayOfYear, 'Normals_' || period_id AS source_table,", 1)
    return body[0] + "\nSELECT " + sel


def q_normals_databases() -> str:
    body = q_doy_normals_fixed().split("\nSELECT ", 1)
    sel = body[1].replace("strftime(date, '%m-%d') AS DayOfYear,", "strftime(date, '%m-%d') AS DayOfYear, "
                          "(CAST(substr(station, 2) AS INT) % 3) || '_Normals_' || period_id AS source_table,", 1)
    return body[0] + "\nSELECT " + sel


# --- streaming ----------------------------------------------------------------

def obs_msg_cte() -> str:
    """Observations as the message path delivers them (first element, wind x 1.5)."""
    o = B.OBS_INT
    w = "((event_id * 11) % 300)"
    g = "((event_id * 3) % 100)"
    return f"""{ev_cte()},
obs_msg AS (
  SELECT {B.OBS_STATION} AS station, date_trunc('second', ts) AS obs_ts,
    {o['temp10']} AS temp10, {o['humidity']} AS humidity, {o['rate100']} AS rate100,
    {o['rain100']} AS rain100, {o['pressure100']} AS pressure100, {o['heat10']} AS heat10,
    3 * {w} AS wind10, 3 * ({w} + {g}) AS gust10, {o['chill10']} AS chill10,
    {o['winddir']} AS winddir, {o['dewpt10']} AS dewpt10, {o['elev10']} AS elev10,
    {o['solar10']} AS solar10, {o['uv10']} AS uv10,
    strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS obs_time_utc,
    CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch
  FROM ev WHERE event_id % {B.MSG_EMPTY_MOD} <> 0
  QUALIFY row_number() OVER (PARTITION BY station, obs_ts ORDER BY event_id) = 1)"""


def q_stream_dedup() -> str:
    return with_(obs_msg_cte()) + f"""SELECT station, obs_ts, {obs_out()}, obs_time_utc, epoch
FROM obs_msg"""


def q_stream_daily() -> str:
    return with_(obs_msg_cte(), stations_cte(), sun_cte("obs_msg"), _solar_cte("obs_msg")) + \
        f"""SELECT r.*, solar.solar_radiation_avg
FROM ({rollup_select('obs_msg')}) r JOIN solar USING (station, date)"""


def q_stream_final() -> str:
    return with_(obs_msg_cte(), stations_cte(), sun_cte("obs_msg"), _solar_cte("obs_msg")) + \
        f"""SELECT r.*, solar.solar_radiation_avg
FROM ({rollup_select('obs_msg')}) r JOIN solar USING (station, date)"""


# --- files and jobs ---------------------------------------------------------------

def q_refresh_days(start=B.SPINE_START, end=B.SPINE_END) -> str:
    return with_(obs_ctes(), stations_cte(), sun_cte(), _solar_cte()) + f"""SELECT sp.station, sp.date,
  r.* EXCLUDE (station, date), solar.solar_radiation_avg
FROM {_spine(start, end)}
LEFT JOIN ({rollup_select()}) r ON r.station = sp.station AND r.date = sp.date
LEFT JOIN solar ON solar.station = sp.station AND solar.date = sp.date"""


def q_stations() -> str:
    return with_(stations_cte()) + "SELECT station, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, tz, region FROM stations"


def q_console_files() -> str:
    return "SELECT station, line FROM (" + q_console_daily() + ")"


def q_documents_files() -> str:
    ny = "count(DISTINCT year)"
    return _base() + f"""SELECT j.station, j.period_id, {mean1('temp_avg')} AS Avg_TempAvg,
  {tenths(hu('CAST(coalesce(sum(precipitation_sum), 0) AS BIGINT)', ny))} AS Yearly_Avg_Precipitation,
  {mean1('CASE WHEN month = 1 THEN temp_avg END')} AS January_Avg_TempAvg,
  count(CASE WHEN temp_high = m.top THEN 1 END) AS n_max_temp_high
FROM j JOIN (SELECT station, period_id, max(temp_high) AS top FROM j GROUP BY 1, 2) m USING (station, period_id)
GROUP BY j.station, j.period_id"""
