"""DuckDB SQL that gives the same result as each query, written from the tables directly."""

from __future__ import annotations

from tidemark import schemas
from tidemark.schemas import SILVER_KEY

METRICS = ("temp", "rain", "snow", "wind_speed", "cloud_cover", "humidity")
STATS = ("min", "max", "avg")
MEASURES = [f"{m}_{s}" for m in METRICS for s in STATS]


def _round2(x: str) -> str:
    return f"round_even(round(({x}) * 100, 6), 0) / 100"


def _clamp(x: str, low: int, high: int) -> str:
    return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN CAST({x} AS DOUBLE) ELSE 0.0 END"


# ---------------------------------------------------------------- observations

OBS = """
obs AS (
  SELECT event_id, user_id, ts, value, event_type AS api_name,
    'place_' || (user_id % 5) AS place_name,
    CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS original_ts,
    CAST(ts AS DATE) + CAST(event_id % 8 AS INTEGER) AS forecast_date_utc,
    CASE WHEN event_id % 4 <> 0 THEN CAST(hour(ts) AS INTEGER) END AS forecast_hour_utc,
    CASE WHEN event_id % 11 <> 0 THEN value - 100 END AS temp_max,
    value - 100 - 5 AS temp_min,
    CASE WHEN event_type <> 'error' THEN value - 100 - 2 END AS temp_avg,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

SILVER = f"""{OBS},
silver AS (
  SELECT event_id, ts, api_name, place_name, ingest_date, ingest_hour, original_ts, forecast_date_utc,
    coalesce(forecast_hour_utc, 0) AS forecast_hour_utc,
    {_clamp('temp_max', -80, 70)} AS temp_max,
    {_clamp('temp_min', -80, 70)} AS temp_min,
    {_clamp('temp_avg', -80, 70)} AS temp_avg,
    {_clamp('value', 0, 1000)} AS precipitation,
    {_clamp('value * 3', 0, 1000)} AS rain,
    {_clamp('(k - 10)', 0, 1000)} AS snow,
    {_clamp('(k + 5)', 0, 100)} AS precip_prob,
    {_clamp('k', 0, 100)} AS humidity,
    {_clamp('(value / 2)', 0, 200)} AS wind_speed,
    {_clamp('value', 0, 360)} AS wind_deg,
    {_clamp('(k + event_id % 10)', 0, 100)} AS clouds,
    k AS weather_code,
    CASE WHEN event_id % 7 <> 0 THEN api_name END AS weather_description,
    CAST(k AS VARCHAR) AS weather_icon,
    CASE event_id % 3
      WHEN 0 THEN CAST(ingest_date AS TIMESTAMP) + INTERVAL 270 MINUTE
      WHEN 1 THEN CAST(forecast_date_utc AS TIMESTAMP) + INTERVAL 437 MINUTE END AS sunrise,
    CASE event_id % 3
      WHEN 0 THEN CAST(forecast_date_utc AS TIMESTAMP) + INTERVAL 65130 SECOND
      WHEN 1 THEN CAST(ingest_date AS TIMESTAMP) + INTERVAL 1065 MINUTE END AS sunset
  FROM obs
)"""

_RAW = {
    "temp": ("temp_min", "temp_max", "temp_avg"),
    "cloud_cover": ("clouds", "clouds", "clouds"),
}


def _raw_measures(rounding) -> str:
    parts = []
    for metric in METRICS:
        columns = _RAW.get(metric, (metric,) * 3)
        for stat, column in zip(STATS, columns):
            parts.append(f"{rounding(f'{stat}({column})')} AS {metric}_{stat}")
    return ",\n    ".join(parts)


MEASURE_ROLLUP = ",\n    ".join(
    f"{_round2(f'{name.rsplit(chr(95), 1)[1]}({name})')} AS {name}" for name in MEASURES
)

_SNAPSHOT = "CAST(ingest_date AS TIMESTAMP) + to_hours(ingest_hour) AS snapshot_ts"

FORECAST = f"""{SILVER},
forecast AS (
  SELECT {_SNAPSHOT}, place_name, forecast_date_utc,
    max(ingest_date) AS ingest_date, max(ingest_hour) AS ingest_hour,
    {_raw_measures(_round2)}
  FROM silver WHERE forecast_date_utc = ingest_date
  GROUP BY {_SNAPSHOT.split(' AS snapshot_ts')[0]}, place_name, forecast_date_utc
)"""

SUMMARY_SQL = f"""SELECT CAST(snapshot_ts AS DATE) AS day, place_name,
    min(forecast_date_utc) AS forecast_date_utc,
    max(ingest_date) AS ingest_date, max(ingest_hour) AS ingest_hour,
    {MEASURE_ROLLUP}
  FROM forecast GROUP BY CAST(snapshot_ts AS DATE), place_name"""

# ---------------------------------------------------------------- gold rows

THINNED = "DATE '1995-01-01' + CAST((({n}) * ({n})) // 2600 AS INTEGER)".format(
    n="CAST(l_shipdate AS DATE) - DATE '1995-01-01'"
)


def _gold(name: str, table: str, day: str, place: str, level: str, amount: str) -> str:
    values = {
        "temp_min": f"{level} - 5", "temp_max": f"{level} + 5", "temp_avg": level,
        "rain": f"{amount} / 100", "snow": f"{level} / 7", "wind_speed": f"{level} * 2",
        "cloud_cover": f"{amount} / 1000", "humidity": f"{level} + 0.5",
    }
    measures = ",\n    ".join(
        f"{_round2(f'{stat}({values.get(metric) or values[f'{metric}_{stat}']})')} AS {metric}_{stat}"
        for metric in METRICS
        for stat in STATS
    )
    return f"""
{name} AS (
  SELECT {place} AS place_name, {day} AS forecast_date_utc, {day} AS ingest_date, 0 AS ingest_hour,
    {measures}
  FROM {table} GROUP BY {place}, {day}
)"""


DAILY = _gold(
    "daily", "lineitem", THINNED, "(l_returnflag || '-' || l_linestatus)", "l_quantity", "l_extendedprice"
)
SECOND = _gold(
    "second_daily", "orders", "CAST(o_orderdate AS DATE)", "('order-' || o_orderstatus)",
    "CAST(o_orderkey % 50 AS DOUBLE)", "o_totalprice",
)

AS_OF = "DATE '2002-01-01'"


def _season_start(d: str) -> str:
    return f"""CASE WHEN month({d}) < 3 THEN make_date(CAST(year({d}) - 1 AS INTEGER), 12, 1)
      ELSE make_date(CAST(year({d}) AS INTEGER), CAST(month({d}) - month({d}) % 3 AS INTEGER), 1) END"""


def _season_name(d: str) -> str:
    return f"""CASE WHEN month({d}) IN (12, 1, 2) THEN 'winter' WHEN month({d}) < 6 THEN 'spring'
      WHEN month({d}) < 9 THEN 'summer' ELSE 'autumn' END"""


def _season_year(d: str) -> str:
    return f"CAST(year({d}) + CASE WHEN month({d}) = 12 THEN 1 ELSE 0 END AS INTEGER)"


def _start(level: str, d: str) -> str:
    return _season_start(d) if level == "season" else f"CAST(date_trunc('{level}', {d}) AS DATE)"


_EXPECTED = {
    "week": "7",
    "month": "day(last_day(period_start))",
    "season": "3",
    "year": "CASE WHEN year(period_start) < 2002 THEN 12 ELSE 0 END",
}
_ALLOWED = {"week": "3", "month": "round_even(expected * 0.15, 0)", "season": "0", "year": "4"}
_LENGTH = {"week": "7 DAY", "month": "1 MONTH", "season": "3 MONTH", "year": "12 MONTH"}


def _gate(level: str, source: str, part: str) -> str:
    closed = "year(period_start) <= 2002" if level == "year" else (
        f"CAST(period_start + INTERVAL {_LENGTH[level]} AS DATE) <= {AS_OF}"
    )
    return f"""
{level}_seen AS (
  SELECT {_start(level, part)} AS period_start, count(DISTINCT {part}) AS actual
  FROM {source} GROUP BY {_start(level, part)}
),
{level}_expected AS (
  SELECT *, {_EXPECTED[level]} AS expected FROM {level}_seen WHERE {closed}
),
{level}_gate AS (
  SELECT period_start, CAST(expected AS INTEGER) AS expected_count, CAST(actual AS INTEGER) AS actual_count,
    CAST(greatest(expected - actual, 0) AS INTEGER) AS missing_count,
    CAST(expected - {_ALLOWED[level]} AS INTEGER) AS required_count,
    actual >= expected - {_ALLOWED[level]} AS accepted
  FROM {level}_expected WHERE expected >= {2 if level == 'year' else 1}
)"""


_DESCRIBE = {
    "week": """CAST(year(period_start) AS INTEGER) AS year, CAST(isoyear(period_start) AS INTEGER) AS iso_year,
    CAST(weekofyear(period_start) AS INTEGER) AS week_number, period_start AS week_start""",
    "month": """CAST(year(period_start) AS INTEGER) AS year, CAST(month(period_start) AS INTEGER) AS month_number,
    period_start AS month_start""",
    "season": f"""{_season_year('period_start')} AS year, {_season_name('period_start')} AS season_name,
    period_start""",
    "year": "CAST(year(period_start) AS INTEGER) AS year, period_start AS year_start, 'yearly' AS period_type",
}


def _rollup(level: str, source: str, part: str) -> str:
    return f"""
{level}_rows AS (
  SELECT place_name, {_start(level, part)} AS period_start,
    {MEASURE_ROLLUP}
  FROM {source} GROUP BY place_name, {_start(level, part)}
),
{level}_rollup AS (
  SELECT place_name, {_DESCRIBE[level]}, {', '.join(MEASURES)}
  FROM {level}_rows WHERE period_start IN (SELECT period_start FROM {level}_gate WHERE accepted)
)"""


WEEKLY = f"{DAILY},{_gate('week', 'daily', 'forecast_date_utc')}"
MONTHLY = f"{DAILY},{_gate('month', 'daily', 'forecast_date_utc')},{_rollup('month', 'daily', 'forecast_date_utc')}"
SEASONAL = f"{MONTHLY},{_gate('season', 'month_rollup', 'month_start')},{_rollup('season', 'month_rollup', 'month_start')}"
YEARLY = f"{MONTHLY},{_gate('year', 'month_rollup', 'month_start')},{_rollup('year', 'month_rollup', 'month_start')}"

# ---------------------------------------------------------------- calendar

DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"

CALENDAR = """
bounds AS (SELECT min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) + 1 AS final FROM orders),
calendar AS (
  SELECT CAST(unnest(generate_series(first, final - 1, INTERVAL 1 DAY)) AS DATE) AS partition_date FROM bounds
)"""


def _calendar_grain(grain: str) -> str:
    step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH", "season": "3 MONTH", "year": "1 YEAR"}[grain]
    first, final = _start(grain, "first"), _start(grain, "final")
    return f"""SELECT partition_date, '{grain}' AS grain FROM (
    SELECT CAST(unnest(generate_series(CAST({first} AS TIMESTAMP), CAST({final} AS TIMESTAMP), INTERVAL {step})) AS DATE)
      AS partition_date, {final} AS stop FROM bounds) WHERE partition_date < stop"""


def _label(grain: str, d: str) -> str:
    return {
        "day": f"'day_' || dayofyear({d}) || '_' || year({d})",
        "week": f"'week_' || weekofyear({d}) || '_' || year({d})",
        "month": f"lower(strftime({d}, '%B')) || '_' || year({d})",
        "season": f"({_season_name(d)}) || '_' || {_season_year(d)}",
    }[grain]


def _path(grain: str, d: str) -> str:
    return {
        "day": f"strftime({d}, '%Y/%m/%d')",
        "week": f"year({d}) || '/W' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0')",
        "month": f"strftime({d}, '%Y/%m')",
        "season": f"{_season_year(d)} || '/' || ({_season_name(d)}) || '_' || {_season_year(d)}",
    }[grain]


# ---------------------------------------------------------------- state

GOLD_DAYS = f"gold_days AS (SELECT DISTINCT {THINNED} AS day FROM lineitem)"

STATE = f"""{GOLD_DAYS},
state_days AS (
  SELECT CAST(unnest(generate_series(DATE '1995-01-01', (SELECT max(day) FROM gold_days), INTERVAL 1 DAY)) AS DATE)
    AS partition_date
),
marked AS (
  SELECT partition_date, partition_date - DATE '1995-01-01' AS n, day IS NOT NULL AS done
  FROM state_days LEFT JOIN gold_days ON day = partition_date
),
state AS (
  SELECT ['gold_daily', 'gold_weekly', 'gold_monthly'][n % 3 + 1] AS processing_level, partition_date,
    CASE WHEN n % 8 <> 0 THEN {_label('day', 'partition_date')} END AS period_name,
    CASE WHEN done THEN 'success'
      ELSE ['pending', 'failed', 'partial', 'abandoned', 'processing'][n % 5 + 1] END AS status,
    24 AS expected_count,
    CAST(CASE WHEN done THEN 24 ELSE n % 24 END AS INTEGER) AS actual_count,
    round_even((CASE WHEN done THEN 24 ELSE n % 24 END) / 24, 4) AS completeness_ratio,
    done AS is_acceptable,
    CAST(n % 6 AS INTEGER) AS retry_count,
    TIMESTAMP '2024-02-01' AS created_at,
    CAST(partition_date + 2 AS TIMESTAMP) AS updated_at,
    CASE WHEN NOT done THEN
      [NULL, 'missing_partitions', 'insufficient_data', 'transformation_error'][n % 4 + 1] END AS error_type,
    CAST(NULL AS VARCHAR) AS error_message
  FROM marked
)"""

STATE_EVENTS = f"""{STATE},
ev AS (
  SELECT ['gold_daily', 'gold_weekly', 'gold_monthly'][(CAST(o_orderdate AS DATE) - DATE '1995-01-01') % 3 + 1]
      AS processing_level,
    CAST(o_orderdate AS DATE) AS partition_date, o_orderkey AS seq,
    CASE WHEN o_orderkey % 3 = 0 THEN 'run_' || o_orderkey END AS period_name,
    CASE WHEN o_orderkey % 97 = 0 THEN 'abandoned'
      ELSE ['processing', 'pending', 'success', 'failed'][o_orderkey % 4 + 1] END AS status,
    CAST(o_orderkey % 25 AS INTEGER) AS actual_count,
    CASE WHEN o_orderkey % 4 = 3 THEN 'missing_partitions' END AS error_type,
    o_orderpriority AS error_message
  FROM orders
),
stops AS (
  SELECT processing_level, partition_date, min(seq) AS stop FROM ev WHERE status = 'abandoned'
  GROUP BY processing_level, partition_date
),
counted AS (
  SELECT ev.* FROM ev LEFT JOIN stops USING (processing_level, partition_date)
  WHERE stop IS NULL OR seq <= stop
),
folded AS (
  SELECT processing_level, partition_date,
    arg_max(status, seq) AS status, arg_max(actual_count, seq) AS actual_count,
    arg_max_null(error_type, seq) AS error_type, arg_max_null(error_message, seq) AS error_message,
    arg_max(period_name, seq) FILTER (WHERE period_name IS NOT NULL) AS period_name,
    count(*) FILTER (WHERE status = 'pending') AS pendings,
    CASE WHEN arg_min(status, seq) = 'pending' THEN 1 ELSE 0 END AS first_pending
  FROM counted GROUP BY processing_level, partition_date
)"""

APPLY_STATE = f"""WITH {STATE_EVENTS}
SELECT s.processing_level, s.partition_date,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.period_name
      ELSE coalesce(f.period_name, s.period_name) END AS period_name,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.status ELSE f.status END AS status,
    24 AS expected_count,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.actual_count ELSE f.actual_count END AS actual_count,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.completeness_ratio
      ELSE round_even(f.actual_count / 24, 4) END AS completeness_ratio,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.is_acceptable
      ELSE f.actual_count >= 24 END AS is_acceptable,
    CAST(CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.retry_count
      ELSE s.retry_count + f.pendings END AS INTEGER) AS retry_count,
    s.created_at,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.updated_at ELSE TIMESTAMP '2024-02-01' END AS updated_at,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.error_type ELSE f.error_type END AS error_type,
    CASE WHEN f.status IS NULL OR s.status = 'abandoned' THEN s.error_message ELSE f.error_message END AS error_message
  FROM state s LEFT JOIN folded f USING (processing_level, partition_date)
UNION ALL
SELECT processing_level, partition_date, period_name, status, 24, actual_count,
    round_even(actual_count / 24, 4), actual_count >= 24, CAST(pendings - first_pending AS INTEGER),
    TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', error_type, error_message
  FROM folded f WHERE NOT EXISTS (
    SELECT 1 FROM state s WHERE s.processing_level = f.processing_level AND s.partition_date = f.partition_date)"""

LATEST = f"""{STATE},
latest AS (
  SELECT * FROM state QUALIFY row_number() OVER (PARTITION BY processing_level ORDER BY partition_date DESC) = 1
)"""

# ---------------------------------------------------------------- payloads

_ZONE_HOURS = "[2, 0, -5][user_id % 3 + 1]"
_ZONE_TEXT = "['+02:00', '+00:00', '-05:00'][user_id % 3 + 1]"

PAYLOAD_DAYS = """
p AS (
  SELECT event_id, user_id, ts, value AS v, event_type AS kind,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, i,
    value - 100 AS warm, CAST(ts AS DATE) + CAST(i AS INTEGER) AS d,
    CAST(CAST(ts AS DATE) + CAST(i AS INTEGER) AS TIMESTAMP) AS midnight,
    CAST(hour(ts) AS INTEGER) AS h
  FROM (SELECT *, unnest([0, 1, 2]) AS i FROM events)
)"""

_FORECAST_TYPES = {
    "original_ts": "VARCHAR", "forecast_date_utc": "DATE", "forecast_hour_utc": "INTEGER",
    **{
        name: "DOUBLE"
        for name in (
            "temp_max", "temp_min", "temp_avg", "precipitation", "rain", "snow", "precip_prob",
            "humidity", "wind_speed", "wind_deg", "clouds",
        )
    },
    "weather_code": "INTEGER", "weather_description": "VARCHAR", "weather_icon": "VARCHAR",
    "sunrise": "VARCHAR", "sunset": "VARCHAR",
}

_UTC_BY_ZONE = f"midnight - to_hours({_ZONE_HOURS})"
_LOCAL_TEXT = f"strftime(midnight, '%Y-%m-%dT%H:%M:%S') || {_ZONE_TEXT}"

PROVIDERS: dict[str, dict[str, str]] = {
    "foreca": {
        "original_ts": f"CASE WHEN event_id % 13 = 0 THEN CAST(d AS VARCHAR) ELSE {_LOCAL_TEXT} END",
        "forecast_date_utc": f"CASE WHEN event_id % 13 = 0 THEN d ELSE CAST({_UTC_BY_ZONE} AS DATE) END",
        "temp_max": "CASE WHEN event_id % 11 <> 0 THEN warm + i END",
        "temp_min": "warm - i",
        "precipitation": "v",
        "precip_prob": "k",
        "wind_speed": "v / 2",
        "wind_deg": "k + i",
        "clouds": "k",
        "weather_description": "kind",
        "weather_icon": "'d' || k",
        "sunrise": "'07:17:00'",
        "sunset": "'17:45:00'",
    },
    "accuweather": {
        "original_ts": f"CAST(d AS VARCHAR) || 'T' || strftime(ts, '%H') || ':00:00' || {_ZONE_TEXT}",
        "forecast_date_utc": f"CAST(midnight + to_hours(h) - to_hours({_ZONE_HOURS}) AS DATE)",
        "temp_max": "CASE WHEN event_id % 9 <> 0 THEN warm + i END",
        "temp_min": "warm - i",
        "precip_prob": "k",
        "weather_description": "kind",
        "weather_icon": "CAST(k AS VARCHAR)",
    },
    "tomorrow": {
        "original_ts": "CAST(d AS VARCHAR) || 'T' || strftime(ts, '%H') || ':00:00Z'",
        "forecast_date_utc": "d",
        "temp_max": "warm + i",
        "temp_min": "warm - i",
        "temp_avg": "warm",
        "precipitation": "v",
        "rain": "v",
        "snow": "v / 4",
        "precip_prob": "k",
        "humidity": "k",
        "wind_speed": "v / 2",
        "wind_deg": "k + i",
        "clouds": "k",
        "weather_code": "k + 1000",
        "sunrise": "CAST(d AS VARCHAR) || 'T05:30:00Z'",
        "sunset": "CAST(d AS VARCHAR) || 'T16:30:00Z'",
    },
    "meteoblue": {
        "original_ts": "strftime(midnight, '%Y-%m-%dT%H:%M:%S')",
        "forecast_date_utc": f"CAST({_UTC_BY_ZONE} AS DATE)",
        "temp_max": "warm + i",
        "temp_min": "warm - i",
        "temp_avg": "CASE WHEN i < 2 THEN warm END",
        "precipitation": "CASE WHEN event_id % 5 <> 0 THEN v END",
    },
    "weatherbit": {
        "original_ts": f"""CASE WHEN event_id % 13 = 0 THEN strftime(midnight, '%Y-%m-%dT%H:%M:%S') || '+00:00'
      ELSE {_LOCAL_TEXT} END""",
        "forecast_date_utc": f"CASE WHEN event_id % 13 = 0 THEN d ELSE CAST({_UTC_BY_ZONE} AS DATE) END",
        "temp_max": "warm + i",
        "temp_min": "warm - i",
        "precipitation": "v",
        "snow": "v / 4",
        "precip_prob": "k",
        "humidity": "k",
        "wind_speed": "v / 2",
        "clouds": "k + i",
        "weather_description": "CASE WHEN event_id % 9 <> 0 THEN kind END",
        "weather_icon": "CASE WHEN event_id % 9 <> 0 THEN 'c' || k END",
    },
    "openweathermap": {
        "original_ts": f"strftime(ts + to_hours(3 * i), '%Y-%m-%dT%H:%M:%S') || {_ZONE_TEXT}",
        "forecast_date_utc": f"CAST(ts + to_hours(3 * i) - to_hours({_ZONE_HOURS}) AS DATE)",
        "forecast_hour_utc": f"hour(ts + to_hours(3 * i) - to_hours({_ZONE_HOURS}))",
        "temp_max": "warm + i",
        "temp_min": "warm - i",
        "temp_avg": "warm",
        "precip_prob": "k / 100",
        "humidity": "k",
        "wind_speed": "v / 2",
        "wind_deg": "k + i",
        "clouds": "k",
        "weather_code": "CASE WHEN event_id % 9 <> 0 THEN k + 200 END",
        "weather_description": "CASE WHEN event_id % 9 <> 0 THEN kind END",
        "weather_icon": "CASE WHEN event_id % 9 <> 0 THEN '10d' END",
    },
    "weatherapi": {
        "original_ts": _LOCAL_TEXT,
        "forecast_date_utc": f"CAST({_UTC_BY_ZONE} AS DATE)",
        "temp_max": "warm + i",
        "temp_min": "warm - i",
        "temp_avg": "warm",
        "precipitation": "v",
        "precip_prob": "k",
        "wind_speed": "v / 2",
        "weather_code": "k + 1000",
        "weather_description": "kind",
        "weather_icon": "'//icon.png'",
        "sunrise": "'07:17 AM'",
        "sunset": "'05:45 PM'",
    },
    "open_meteo": {
        "original_ts": "CAST(d AS VARCHAR)",
        "forecast_date_utc": "d",
        "temp_max": "warm + i",
        "temp_min": "warm - i",
        "precipitation": "v",
        "rain": "v / 4",
        "wind_speed": "CASE WHEN i < 2 THEN v / 2 END",
        "clouds": "k + i",
        "weather_code": "CASE WHEN event_id % 5 <> 0 THEN k END",
    },
}

PROVIDER_ORDER = sorted(PROVIDERS)


def _parsed(name: str, where: str = "") -> str:
    columns = ",\n    ".join(
        f"CAST({PROVIDERS[name].get(column, 'NULL')} AS {kind}) AS {column}"
        for column, kind in _FORECAST_TYPES.items()
    )
    return f"""SELECT '{name}' AS api_name, 'place_' || user_id AS place_name,
    CAST(ts AS DATE) AS ingest_date, h AS ingest_hour,
    {columns}
  FROM p {where}"""


MIXED = f"""{PAYLOAD_DAYS},
mixed AS (
  {' UNION ALL '.join(_parsed(name, f'WHERE event_id % 12 = {i}') for i, name in enumerate(PROVIDER_ORDER))}
)"""

_KIND_SOURCE = (
    "CASE WHEN event_id % 12 < 8 THEN ["
    + ", ".join(f"'{name}'" for name in PROVIDER_ORDER)
    + "][event_id % 12 + 1] WHEN event_id % 12 < 11 THEN 'foreca' ELSE 'unlisted_site' END"
)

REJECTS = f"""rejects AS (
  SELECT event_id, {_KIND_SOURCE} AS source, 'place_' || user_id AS place_name,
    CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour,
    CASE event_id % 12 WHEN 8 THEN 'empty_payload' WHEN 9 THEN 'malformed_json'
      WHEN 10 THEN 'undated_forecast' WHEN 11 THEN 'unknown_source' END AS reason,
    CASE event_id % 12 WHEN 8 THEN '{{}}' WHEN 9 THEN '{{"forecast": [' || repeat('x', 400)
      WHEN 10 THEN '{{"forecast": [{{"date": "soon", "maxTemp": 3}}]}}' WHEN 11 THEN '{{"a": 1}}' END AS detail
  FROM events WHERE event_id % 12 >= 8
)"""

_CLEANED = {
    "temp_max": (-80, 70), "temp_min": (-80, 70), "temp_avg": (-80, 70), "precipitation": (0, 1000),
    "rain": (0, 1000), "snow": (0, 1000), "precip_prob": (0, 100), "humidity": (0, 100),
    "wind_speed": (0, 200), "wind_deg": (0, 360), "clouds": (0, 100),
}


def _sun(column: str) -> str:
    return f"""CASE WHEN {column} LIKE '%Z' THEN CAST(replace(replace({column}, 'T', ' '), 'Z', '') AS TIMESTAMP)
      WHEN {column} LIKE '%PM' THEN CAST(forecast_date_utc AS TIMESTAMP) + INTERVAL 1065 MINUTE
      WHEN {column} LIKE '%AM' THEN CAST(forecast_date_utc AS TIMESTAMP) + INTERVAL 437 MINUTE
      WHEN {column} IS NOT NULL THEN CAST(forecast_date_utc || ' ' || {column} AS TIMESTAMP) END AS {column}"""


CLEAN_PARSED = f"""WITH {MIXED}
SELECT api_name, place_name, ingest_date, ingest_hour, original_ts, forecast_date_utc,
    coalesce(forecast_hour_utc, 0) AS forecast_hour_utc,
    {', '.join(f'{_clamp(c, *r)} AS {c}' for c, r in _CLEANED.items())},
    weather_code, weather_description, weather_icon, {_sun('sunrise')}, {_sun('sunset')}, 'batch-1' AS batch_id
  FROM mixed"""

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_HHMM = "strftime(ts, '%H:%M')"

# ---------------------------------------------------------------- streams

STREAM_DAILY = f"""WITH {SILVER},
hourly AS (
  SELECT date_trunc('hour', ts) AS snapshot_ts, place_name, forecast_date_utc,
    {_raw_measures(_round2)}
  FROM silver WHERE forecast_date_utc = ingest_date
  GROUP BY date_trunc('hour', ts), place_name, forecast_date_utc
)
SELECT CAST(snapshot_ts AS DATE) AS day, place_name, min(forecast_date_utc) AS forecast_date_utc,
    {MEASURE_ROLLUP}
  FROM hourly
  WHERE CAST(snapshot_ts AS DATE) + 1 <= (
    SELECT max(ts) - INTERVAL 1 HOUR FROM silver WHERE forecast_date_utc = ingest_date)
  GROUP BY CAST(snapshot_ts AS DATE), place_name"""


_SILVER_REST = [n for n in schemas.SILVER.names if n not in (*SILVER_KEY, "batch_id")]
STREAM_SILVER = f"""SELECT {', '.join([*SILVER_KEY, *_SILVER_REST])} FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(SILVER_KEY)}
    ORDER BY {', '.join(f'{c} NULLS FIRST' for c in ['original_ts', 'temp_max', *_SILVER_REST])}) AS place
  FROM ({CLEAN_PARSED})) WHERE place = 1"""


def _scraped(columns: str) -> str:
    return f"SELECT event_id AS page_id, {columns} FROM events"


ORACLES: dict[str, str] = {
    "cleaned_silver": f"""WITH {SILVER} SELECT * EXCLUDE (ts), 'batch-1' AS batch_id FROM silver""",
    "constraint_violations": f"""WITH {OBS}
SELECT 'precip_prob_range' AS violation, count(*) AS row_count FROM obs WHERE k + 5 > 100 HAVING count(*) > 0""",
    "cleaning_report": """SELECT count(*) AS rows_before, count(*) FILTER (WHERE event_id % 3 <> 2) AS rows_after,
    count(*) FILTER (WHERE event_id % 3 = 2) AS removed FROM events""",
    "silver_load_rows": f"""WITH {SILVER},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY api_name, place_name, forecast_date_utc, forecast_hour_utc,
    ingest_date, ingest_hour ORDER BY event_id) AS rank FROM silver
)
SELECT api_name, place_name, forecast_date_utc, forecast_hour_utc, ingest_date, ingest_hour, event_id, temp_max
  FROM ranked WHERE rank = 1 AND ingest_date >= DATE '2024-01-16'""",
    "daily_forecast": f"WITH {FORECAST} SELECT * FROM forecast",
    "five_day_forecast": f"""WITH {SILVER}
SELECT {_SNAPSHOT}, place_name, forecast_date_utc, max(ingest_date) AS ingest_date, max(ingest_hour) AS ingest_hour,
    {_raw_measures(lambda x: f'round({x}, 6)')}
  FROM silver WHERE forecast_date_utc BETWEEN ingest_date AND ingest_date + 5
  GROUP BY {_SNAPSHOT.split(' AS snapshot_ts')[0]}, place_name, forecast_date_utc""",
    "daily_summary": f"WITH {FORECAST} {SUMMARY_SQL}",
    "weekly_rollup": f"WITH {WEEKLY},{_rollup('week', 'daily', 'forecast_date_utc')} SELECT * FROM week_rollup",
    "monthly_rollup": f"WITH {MONTHLY} SELECT * FROM month_rollup",
    "seasonal_rollup": f"WITH {SEASONAL} SELECT * FROM season_rollup",
    "yearly_rollup": f"WITH {YEARLY} SELECT * FROM year_rollup",
    "gate_verdicts": f"""WITH {SEASONAL},{_gate('week', 'daily', 'forecast_date_utc')},
{_gate('year', 'month_rollup', 'month_start')}
SELECT *, 'week' AS level FROM week_gate UNION ALL SELECT *, 'month' FROM month_gate
UNION ALL SELECT *, 'season' FROM season_gate UNION ALL SELECT *, 'year' FROM year_gate""",
    "gate_decisions": f"""WITH {SEASONAL},{_gate('week', 'daily', 'forecast_date_utc')},
{_gate('year', 'month_rollup', 'month_start')},{STATE},
gates AS (
  SELECT 'gold_weekly' AS level, {_label('week', 'period_start')} AS period_name, * FROM week_gate
  UNION ALL SELECT 'gold_monthly', {_label('month', 'period_start')}, * FROM month_gate
  UNION ALL SELECT 'gold_seasonal', {_label('season', 'period_start')}, * FROM season_gate
  UNION ALL SELECT 'gold_yearly', 'year_' || year(period_start), * FROM year_gate
),
retries AS (
  SELECT g.*, coalesce(s.retry_count, 0) AS retry_count, missing_count > g.expected_count - required_count AS gap
  FROM gates g LEFT JOIN state s ON s.partition_date = g.period_start AND s.processing_level = g.level
)
SELECT level AS processing_level, period_start AS partition_date, period_name,
    CASE WHEN accepted THEN 'success'
      WHEN gap AND retry_count + 1 >= 3 AND (level <> 'gold_yearly' OR expected_count = 12) THEN 'abandoned'
      WHEN gap THEN 'pending' ELSE 'failed' END AS status,
    expected_count, CASE WHEN accepted THEN expected_count ELSE actual_count END AS actual_count,
    CASE WHEN NOT accepted THEN CASE WHEN gap THEN 'missing_partitions' ELSE 'insufficient_data' END END AS error_type,
    CASE WHEN NOT accepted THEN CASE WHEN gap THEN 'Missing partitions: ' || missing_count
      ELSE 'Found ' || actual_count || ' of at least ' || required_count END END AS error_message
  FROM retries""",
    "season_calendar": f"""WITH {DAYS}
SELECT day, {_season_start('day')} AS season_start, {_season_name('day')} AS season_name,
    {_season_year('day')} AS season_year, CAST(quarter(day) AS INTEGER) AS quarter FROM days""",
    "partition_calendar": f"""WITH {CALENDAR}
{' UNION ALL '.join(_calendar_grain(g) for g in ('day', 'week', 'month', 'season', 'year'))}""",
    "period_labels": f"""WITH {DAYS},
starts AS (SELECT day, {', '.join(f'{_start(g, "day")} AS {g}_start' for g in ('week', 'month', 'season'))},
  day AS day_start FROM days)
SELECT day, {', '.join(f'{_label(g, g + "_start")} AS {g}_label, {_path(g, g + "_start")} AS {g}_path'
                       for g in ('day', 'week', 'month', 'season'))} FROM starts""",
    "iso_weeks": f"""WITH {DAYS}
SELECT day, CAST(weekofyear(day) AS INTEGER) AS week_number, CAST(isoyear(day) AS INTEGER) AS iso_year,
    CAST(date_trunc('week', day) AS DATE) AS week_start,
    CAST(date_trunc('week', make_date(CAST(year(day) AS INTEGER), 1, 4)) AS DATE) AS first_week,
    CAST(day(last_day(day)) AS INTEGER) AS days_in_month,
    CAST(day + INTERVAL 3 MONTH AS DATE) AS next_season FROM days""",
    "season_month_groups": f"""WITH {DAYS},
months AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS m FROM days),
grouped AS (SELECT {_season_start('m')} AS period_start, string_agg(CAST(m AS VARCHAR), ',' ORDER BY m) AS months
  FROM months GROUP BY {_season_start('m')})
SELECT {_label('season', 'period_start')} AS period_name, period_start, months,
    CAST(period_start AS VARCHAR) || ',' || CAST(CAST(period_start + INTERVAL 1 MONTH AS DATE) AS VARCHAR) || ','
      || CAST(CAST(period_start + INTERVAL 2 MONTH AS DATE) AS VARCHAR) AS expected_months FROM grouped""",
    "missing_partitions": f"""WITH {GOLD_DAYS},
every_day AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS partition_date FROM gold_days)
SELECT partition_date FROM every_day WHERE partition_date NOT IN (SELECT day FROM gold_days)""",
    "fallback_union": f"""WITH {DAILY},{SECOND}
SELECT * FROM daily UNION ALL
SELECT * FROM second_daily WHERE forecast_date_utc NOT IN (SELECT forecast_date_utc FROM daily)""",
    "hourly_increment": f"""WITH {OBS} SELECT event_id, ingest_date, ingest_hour FROM obs
WHERE ts >= TIMESTAMP '2024-01-09 23:00:00' AND ts < TIMESTAMP '2024-01-12 06:00:00'""",
    "first_hourly_increment": f"""WITH {OBS} SELECT event_id, ingest_date, ingest_hour FROM obs
WHERE ts < TIMESTAMP '2024-01-12 06:00:00'""",
    "daily_increment": f"""WITH {DAILY} SELECT * FROM daily
WHERE forecast_date_utc > DATE '1997-05-01' AND forecast_date_utc <= DATE '1997-09-15'""",
    "short_days": f"""WITH {FORECAST}
SELECT forecast_date_utc AS day, count(*) AS row_count, 120 - count(*) AS missing_rows
  FROM forecast GROUP BY forecast_date_utc HAVING count(*) < 120""",
    "snapshots_since": f"""WITH {OBS} SELECT event_id, ingest_date, ingest_hour FROM obs
WHERE ts >= TIMESTAMP '2024-01-20 09:00:00' AND ts < TIMESTAMP '2024-01-21'""",
    "bronze_hour": f"""SELECT CASE WHEN event_id % 12 < 8 AND event_id % 12 % 2 = 1
    THEN {_KIND_SOURCE} || '_api' ELSE {_KIND_SOURCE} END AS source,
    'place_' || user_id AS place_name, CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour
  FROM events WHERE ts >= TIMESTAMP '2024-01-20 09:00:00' AND ts < TIMESTAMP '2024-01-20 10:00:00'""",
    "provider_gaps": """WITH have AS (
  SELECT DISTINCT event_type AS source, 'place_' || (user_id % 5) AS place_name, date_trunc('hour', ts) AS h FROM events
),
span AS (SELECT min(h) AS first, max(h) AS final FROM have),
places AS (SELECT DISTINCT place_name FROM have),
pairs AS (SELECT place_name, unnest(['click', 'error', 'purchase', 'signup', 'view']) AS source FROM places),
hours AS (SELECT unnest(generate_series(first, final, INTERVAL 1 HOUR)) AS h FROM span),
want AS (SELECT * FROM pairs, hours)
, gaps AS (SELECT source, place_name, h FROM want ANTI JOIN have USING (source, place_name, h)),
islands AS (SELECT *, h - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY source, place_name ORDER BY h) AS island FROM gaps)
SELECT source, place_name, min(h) AS first_missing, max(h) AS last_missing, count(*) AS hours
  FROM islands GROUP BY source, place_name, island""",
    "hour_calendar": """SELECT unnest(generate_series(date_trunc('hour', min(ts)),
    date_trunc('hour', max(ts)) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS partition_date FROM events""",
    "silver_hour": f"""WITH {SILVER} SELECT * EXCLUDE (ts), 'batch-1' AS batch_id FROM silver
WHERE ingest_date = DATE '2024-01-20' AND ingest_hour = 9""",
    "forecast_day": f"WITH {FORECAST} SELECT * FROM forecast WHERE ingest_date = DATE '2024-01-20'",
    "daily_range": f"""WITH {DAILY} SELECT * FROM daily
WHERE forecast_date_utc BETWEEN DATE '1997-05-05' AND DATE '1997-05-11'""",
    "one_month": f"WITH {MONTHLY} SELECT * FROM month_rollup WHERE month_start = DATE '1996-04-01'",
    "rows_per_place": """SELECT 'place_' || (user_id % 5) AS place_name, count(*) AS row_count FROM events
GROUP BY user_id % 5""",
    "stored_weeks": f"""WITH {WEEKLY},{_rollup('week', 'daily', 'forecast_date_utc')}
SELECT *, TIMESTAMP '2024-02-01' AS generated_at FROM week_rollup""",
    "rollup_run_weekly": f"""WITH {WEEKLY},{_rollup('week', 'daily', 'forecast_date_utc')}
SELECT *, TIMESTAMP '2024-02-01' AS generated_at FROM week_rollup""",
    "rollup_run_state": f"""WITH {WEEKLY},
span AS (SELECT min(CAST(date_trunc('week', forecast_date_utc) AS DATE)) AS first FROM daily),
weeks AS (SELECT CAST(unnest(generate_series(first, {AS_OF} - 1, INTERVAL 7 DAY)) AS DATE) AS w FROM span)
SELECT 'gold_weekly' AS processing_level, w AS partition_date,
    CASE WHEN accepted THEN 'success' ELSE 'pending' END AS status, 7 AS expected_count
  FROM weeks LEFT JOIN week_gate ON period_start = w
  WHERE w < CAST(date_trunc('week', {AS_OF}) AS DATE)""",
    "rollup_run_monthly": f"WITH {MONTHLY} SELECT *, TIMESTAMP '2024-02-01' AS generated_at FROM month_rollup",
    "rollup_run_seasonal": f"WITH {SEASONAL} SELECT *, TIMESTAMP '2024-02-01' AS generated_at FROM season_rollup",
    "rollup_run_yearly": f"""WITH {YEARLY}
SELECT *, TIMESTAMP '2024-02-01' AS updated_at FROM year_rollup, (VALUES ('main'), ('copy')) AS c(copy)""",
    "rollup_after_late_days": f"""WITH {WEEKLY},{_rollup('week', 'daily', 'forecast_date_utc')}
SELECT *, TIMESTAMP '2024-02-01' AS generated_at FROM week_rollup""",
    "stored_seasons": f"""WITH {SEASONAL}
SELECT * REPLACE (CASE WHEN (year + length(season_name)) % 2 = 0 THEN temp_max + 1 ELSE temp_max END AS temp_max),
    TIMESTAMP '2024-02-01' AS generated_at FROM season_rollup""",
    "dual_sink_events": f"""WITH {SEASONAL}
SELECT main_blocked, copy_blocked, 'gold_seasonal' AS processing_level, partition_date,
    CASE WHEN main_blocked AND copy_blocked THEN 'failed' ELSE 'success' END AS status, 3 AS expected_count,
    CASE WHEN main_blocked AND copy_blocked THEN 0 ELSE 3 END AS actual_count,
    CASE WHEN main_blocked AND copy_blocked THEN 'missing_partitions' END AS error_type,
    main_blocked AS names_main, copy_blocked AS names_copy
  FROM (SELECT DISTINCT period_start AS partition_date FROM season_rollup),
    (VALUES (false, false), (true, false), (false, true), (true, true)) AS s(main_blocked, copy_blocked)""",
    "dual_sink_repair": f"""WITH {SEASONAL}
SELECT *, TIMESTAMP '2024-02-01' AS generated_at, 0 AS still_different,
    CAST((SELECT count(*) FROM season_rollup WHERE season_name NOT IN ('winter', 'summer')) AS INTEGER) AS loaded FROM season_rollup""",
    "bronze_files": """WITH hours AS (
  SELECT 'sensor' AS source, 'place-' || (user_id % 2) AS place_name, CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour,
    '[' || string_agg(props, ',' ORDER BY props) || ']' AS payload
  FROM events GROUP BY ALL)
SELECT *, (SELECT count(*) FROM hours WHERE ingest_date >= DATE '2024-01-16') AS read_by_second_scan FROM hours""",
    "bronze_uploads": """WITH keys AS (
  SELECT DISTINCT event_type AS source, 'place_' || (user_id % 5) AS place_name, CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour
  FROM events)
SELECT *, ingest_date >= DATE '2024-01-16' AS uploaded, CASE WHEN ingest_date >= DATE '2024-01-16' THEN 'created' ELSE 'already_exists' END AS reason,
    ingest_date || '_' || source || '_' || place_name || '/' || lpad(CAST(ingest_hour AS VARCHAR), 2, '0') || '.json' AS path,
    (SELECT count(*) FROM keys) AS stored
  FROM keys""",
    "stored_bronze": """SELECT event_type AS source, 'place_' || (user_id % 5) AS place_name, CAST(ts AS DATE) AS ingest_date,
    CAST(hour(ts) AS INTEGER) AS ingest_hour, min(props) AS payload FROM events GROUP BY ALL""",
    "hourly_run_silver": f"""SELECT * FROM ({STREAM_SILVER}), (VALUES ('main'), ('copy')) AS c(copy)""",
    "hourly_run_forecasts": f"""WITH {FORECAST}
SELECT snapshot_ts, place_name, forecast_date_utc, ingest_date, ingest_hour, {', '.join(MEASURES)},
    TIMESTAMP '2024-02-01' AS generated_at FROM forecast""",
    "stored_five_day": f"""WITH {SILVER}
SELECT {_SNAPSHOT}, place_name, forecast_date_utc, max(ingest_date) AS ingest_date, max(ingest_hour) AS ingest_hour,
    {_raw_measures(lambda x: f'round({x}, 6)')}, TIMESTAMP '2024-02-01' AS generated_at
  FROM silver WHERE forecast_date_utc BETWEEN ingest_date AND ingest_date + 5
  GROUP BY {_SNAPSHOT.split(' AS snapshot_ts')[0]}, place_name, forecast_date_utc""",
    "hourly_run_daily": f"""WITH {FORECAST}, summary AS ({SUMMARY_SQL})
SELECT place_name, forecast_date_utc, ingest_date, ingest_hour, {', '.join(MEASURES)},
    TIMESTAMP '2024-02-01' AS generated_at FROM summary""",
    "hourly_run_watermark": """SELECT 'gold_daily_forecast' AS job_name, date_trunc('hour', max(ts)) AS last_processed_ts,
    TIMESTAMP '2024-02-01' AS updated_at FROM events""",
    "flatten_paths": f"""SELECT path, leaf AS value, 'free' AS source, CAST(event_id AS VARCHAR) AS place_name, CAST(ts AS DATE) AS ingest_date,
    CAST(hour(ts) AS INTEGER) AS ingest_hour
  FROM (SELECT *, unnest(['kind', 'station.s' || event_id || '.k' || event_id, 'station.s' || event_id || '.user', 'list', 'none']) AS path,
      unnest([event_type, CAST({_K} AS VARCHAR), CAST(user_id AS VARCHAR), '[1,2]', NULL]) AS leaf
    FROM events WHERE event_type <> 'signup')""",
    "profile_by_day": f"""WITH {SILVER},
cells AS (
  SELECT ingest_date, unnest(['temp_max', 'wind_speed', 'clouds', 'humidity']) AS column_name, unnest([temp_max, wind_speed, clouds, humidity]) AS v
  FROM silver
)
SELECT days_of, column_name, count(DISTINCT ingest_date) AS days, count(*) AS rows, count(*) - count(v) AS nulls, min(v) AS minimum, max(v) AS maximum,
    true AS median_within, true AS distinct_within
  FROM cells, (VALUES ('half'), ('all')) AS p(days_of)
  WHERE days_of = 'all' OR ingest_date < DATE '2024-01-16' GROUP BY ALL""",
    "silver_rejects": f"""WITH {REJECTS},
odd AS (
  SELECT source, CASE WHEN event_id % 24 <> 0 THEN place_name END AS place_name, ingest_date,
    CAST(CASE WHEN event_id % 24 = 1 THEN 31 ELSE ingest_hour END AS INTEGER) AS ingest_hour, reason, detail FROM rejects
),
invalid AS (
  SELECT {_KIND_SOURCE} AS source, CASE WHEN event_id % 24 = 1 THEN 'place_' || user_id END AS place_name,
    CAST(ts AS DATE) AS ingest_date, CAST(CASE WHEN event_id % 24 = 1 THEN 31 ELSE hour(ts) END AS INTEGER) AS ingest_hour,
    CASE WHEN event_id % 24 = 0 THEN 'place_name_null' ELSE 'ingest_hour_range' END AS reason, CAST(NULL AS VARCHAR) AS detail,
    unnest(range(3)) AS n
  FROM events WHERE event_id % 24 < 2
)
SELECT * FROM odd UNION ALL SELECT * EXCLUDE (n) FROM invalid""",
    "stored_months": f"WITH {MONTHLY} SELECT *, TIMESTAMP '2024-02-01' AS generated_at FROM month_rollup",
    "stored_years": f"""WITH {YEARLY}
SELECT * REPLACE (CASE WHEN place_name = 'A-F' THEN temp_max ELSE temp_max + 1 END AS temp_max),
    TIMESTAMP '2024-02-01' AS updated_at FROM year_rollup""",
    "stored_once": f"""WITH {MONTHLY}
SELECT * REPLACE (CASE WHEN year < 1996 THEN snow_min ELSE 0.0 END AS snow_min),
    TIMESTAMP '2024-02-01' AS generated_at FROM month_rollup""",
    "watermarks": """SELECT event_type AS job_name, date_trunc('hour', max(ts)) AS last_processed_ts,
    TIMESTAMP '2024-02-01' AS updated_at FROM events GROUP BY event_type""",
    "unreadable_pages": """WITH marks AS (SELECT page_id, list_filter([
    CASE WHEN NOT regexp_matches(html, '<title>.*?</title>', 's') THEN 'title' END,
    CASE WHEN NOT regexp_matches(html, '<div class="ad">.*?</div>', 's') THEN 'notice' END,
    CASE WHEN NOT regexp_matches(html, '<table.*?<tr', 's') THEN 'table' END], lambda x: x IS NOT NULL) AS missing FROM pages)
SELECT page_id, array_to_string(missing, ',') AS missing_fields FROM marks WHERE len(missing) > 0""",
    "insert_ignore": """WITH target AS (SELECT * FROM orders WHERE o_orderdate < DATE '1998-01-01'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS rank FROM orders)
SELECT * EXCLUDE (rank) FROM ranked r WHERE rank = 1 AND NOT EXISTS (
  SELECT 1 FROM target t WHERE t.o_custkey = r.o_custkey AND t.o_orderstatus = r.o_orderstatus)""",
    "upsert": """WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders),
target AS (
  SELECT o_custkey, order_year, max(o_totalprice) AS amount, min(CAST(o_orderdate AS DATE)) AS first_seen
  FROM o WHERE order_year < 1999 GROUP BY o_custkey, order_year
),
batch AS (
  SELECT o_custkey, order_year, arg_max(o_totalprice, o_orderkey) AS amount,
    arg_max(CAST(o_orderdate AS DATE), o_orderkey) AS first_seen
  FROM o WHERE order_year >= 1998 GROUP BY o_custkey, order_year
)
SELECT o_custkey, order_year, coalesce(b.amount, t.amount) AS amount, coalesce(t.first_seen, b.first_seen) AS first_seen
  FROM target t FULL JOIN batch b USING (o_custkey, order_year)""",
    "load_report": """WITH target AS (SELECT DISTINCT o_custkey, o_orderstatus, 1 AS known FROM orders
  WHERE o_orderdate < DATE '1998-01-01'),
copies AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus)
SELECT o_orderstatus, CAST(sum(n) AS BIGINT) AS rows_in, count(*) FILTER (WHERE known IS NULL) AS inserted,
    CAST(sum(n) AS BIGINT) - count(*) FILTER (WHERE known IS NULL) AS skipped
  FROM copies LEFT JOIN target USING (o_custkey, o_orderstatus) GROUP BY o_orderstatus""",
    "write_once_report": f"""WITH {GOLD_DAYS}, days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT d AS forecast_date_utc, day IS NULL AS uploaded,
    CASE WHEN day IS NULL THEN 'created' ELSE 'already_exists' END AS reason FROM days LEFT JOIN gold_days ON day = d""",
    "write_once_rows": f"""WITH {DAILY},{SECOND}
SELECT * FROM second_daily WHERE forecast_date_utc NOT IN (SELECT forecast_date_utc FROM daily)""",
    "conformed_forecast": f"""WITH {FORECAST}
SELECT snapshot_ts, place_name, forecast_date_utc, ingest_date, ingest_hour, {', '.join(m for m in MEASURES if m != 'humidity_avg')},
    CAST(NULL AS DOUBLE) AS humidity_avg, CAST(NULL AS TIMESTAMP) AS generated_at FROM forecast""",
    "reconcile_events": f"""WITH {MONTHLY},{CALENDAR},
months AS (SELECT DISTINCT CAST(date_trunc('month', partition_date) AS DATE) AS m FROM calendar
  WHERE CAST(date_trunc('month', partition_date) AS DATE) < (SELECT date_trunc('month', final) FROM bounds)),
found AS (SELECT period_start AS m FROM month_gate WHERE accepted
  UNION SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders)
SELECT 'gold_monthly' AS processing_level, m AS partition_date, {_label('month', 'm')} AS period_name,
    CASE WHEN m IN (SELECT m FROM found) THEN 'success' ELSE 'pending' END AS status,
    CAST(day(last_day(m)) AS INTEGER) AS expected_count,
    CAST(CASE WHEN m IN (SELECT m FROM found) THEN day(last_day(m)) ELSE 0 END AS INTEGER) AS actual_count FROM months""",
    "evidence": f"""WITH {GOLD_DAYS},{CALENDAR},
marks AS (SELECT partition_date, CAST(partition_date IN (SELECT day FROM gold_days) AS INTEGER)
  + CAST(partition_date IN (SELECT CAST(o_orderdate AS DATE) FROM orders) AS INTEGER) AS n
  FROM calendar)
SELECT partition_date, CASE WHEN n > 0 THEN 'success' ELSE 'missing' END AS status,
    CASE n WHEN 0 THEN 'none' WHEN 1 THEN 'some' ELSE 'all' END AS found_in FROM marks""",
    "apply_state": APPLY_STATE,
    "pending_work": f"""WITH {STATE} SELECT processing_level, partition_date, status, error_type, retry_count FROM state
WHERE processing_level = 'gold_weekly' AND status IN ('pending', 'failed', 'partial') AND retry_count < 3
  AND (error_type IN ('insufficient_data', 'missing_partitions') OR error_type IS NULL) ORDER BY partition_date""",
    "last_reconciled": f"""WITH {STATE} SELECT max(partition_date) AS last_reconciled FROM state
WHERE processing_level = 'gold_monthly' AND status <> 'abandoned'""",
    "retry_counts": f"""WITH {STATE},{CALENDAR}
SELECT c.partition_date, coalesce(s.retry_count, 0) AS retry_count FROM calendar c
  LEFT JOIN state s ON s.partition_date = c.partition_date AND s.processing_level = 'gold_daily'""",
    "state_metrics": f"""WITH {LATEST}
SELECT 'completeness_ratio' AS metric, processing_level, status AS label, completeness_ratio AS value FROM latest
UNION ALL SELECT 'retry_count', processing_level, status, retry_count FROM latest
UNION ALL SELECT 'is_acceptable', processing_level, NULL, CASE WHEN is_acceptable THEN 1 ELSE 0 END FROM latest
UNION ALL SELECT 'errors', processing_level, error_type, 1 FROM latest WHERE error_type IS NOT NULL""",
    "error_counts": f"""WITH {STATE} SELECT processing_level, error_type, count(*) AS errors FROM state
WHERE error_type IS NOT NULL GROUP BY processing_level, error_type""",
    "latest_state": f"""WITH {LATEST} SELECT processing_level, partition_date, status, completeness_ratio, retry_count,
    error_type, is_acceptable FROM latest""",
    "months_ready": f"""WITH {STATE} SELECT CAST(year(partition_date) AS INTEGER) AS year,
    CAST(quarter(partition_date) AS INTEGER) AS quarter, count(*) AS months FROM state
  WHERE processing_level = 'gold_monthly' AND status = 'success' GROUP BY year(partition_date), quarter(partition_date)""",
    "bootstrap_start": f"""WITH {SEASONAL},
oldest AS (SELECT (SELECT min(period_start) FROM season_rollup) AS s,
  (SELECT min(month_start) FROM month_rollup) AS m)
SELECT coalesce(s, {_season_start('m')}) AS start_date, s AS oldest_season, m AS oldest_month FROM oldest""",
    "requeued_rows": f"""WITH {STATE} SELECT processing_level, partition_date, period_name, 'pending' AS status, expected_count,
    0 AS actual_count FROM state WHERE status = 'processing' AND updated_at < TIMESTAMP '2001-01-01'""",
    "outcome_counts": f"""WITH {STATE} SELECT processing_level, status, count(*) AS partitions FROM state
GROUP BY processing_level, status""",
    **{f"parse_{name}": f"WITH {PAYLOAD_DAYS} {_parsed(name)}" for name in PROVIDER_ORDER},
    "parse_mixed": f"WITH {MIXED} SELECT * FROM mixed",
    "parse_rejects": f"WITH {REJECTS} SELECT source, place_name, ingest_date, ingest_hour, reason, detail FROM rejects",
    "parse_metrics": f"""WITH {REJECTS},
marks AS (
  SELECT {_KIND_SOURCE} AS source, 'place_' || user_id AS place_name, CAST(ts AS DATE) AS ingest_date,
    CAST(hour(ts) AS INTEGER) AS ingest_hour, 3 AS good, 0 AS bad, NULL AS reason FROM events WHERE event_id % 12 < 8
  UNION ALL SELECT source, place_name, ingest_date, ingest_hour, 0, 1, reason FROM rejects
)
SELECT source, place_name, ingest_date, ingest_hour, CAST(sum(good) AS BIGINT) AS row_count,
    CAST(sum(bad) AS BIGINT) AS rejected_count, sum(bad) = 0 AS success, min(reason) AS reason
  FROM marks GROUP BY source, place_name, ingest_date, ingest_hour""",
    "clean_parsed": CLEAN_PARSED,
    "added_provider": f"""WITH {MIXED}
SELECT api_name, ingest_date, count(*) AS forecasts, max(TRY_CAST(temp_max AS DOUBLE)) AS temp_max, min(TRY_CAST(temp_min AS DOUBLE)) AS temp_min
  FROM (
    SELECT api_name, ingest_date, CAST(temp_max AS DOUBLE) AS temp_max, CAST(temp_min AS DOUBLE) AS temp_min FROM mixed
    UNION ALL
    SELECT 'own_station', CAST(ts AS DATE), value, value - 5 FROM events, range(2)
  ) GROUP BY api_name, ingest_date""",
    "canonical_sources": f"SELECT {_KIND_SOURCE} AS source, count(*) AS records FROM events GROUP BY {_KIND_SOURCE}",
    "flatten_json": f"""SELECT user_id AS "station.id", {_K} AS "station.props.rank", value,
    CASE WHEN event_type <> 'error' THEN event_type END AS kind, 'flat' AS source, event_type AS place_name,
    CAST(ts AS DATE) AS ingest_date, CAST(hour(ts) AS INTEGER) AS ingest_hour FROM events WHERE event_type <> 'signup'""",
    "scrape_meteoblue": _scraped(f"""'PLACE ' || user_id || ', Region' AS city, {_HHMM} AS curr_time, {_K} AS temperature"""),
    "scrape_sinoptik": _scraped(f"""'Place ' || user_id || ', region' AS city, {_HHMM} AS curr_time, {_K} AS temperature,
    event_type || ' wind' AS weather, CAST(floor(value) AS BIGINT) AS wind_m_s, CAST(day(ts) AS BIGINT) AS curr_day,
    'january' AS curr_month"""),
    "scrape_accuweather": _scraped(f"""'Place ' || user_id AS city, {_HHMM} AS curr_time, {_K} AS temperature,
    event_type AS weather, 'Mon' AS weekday, CAST(floor(floor(value) * 0.2777) AS BIGINT) AS wind_m_s,
    CAST(day(ts) AS BIGINT) AS curr_day, 'january' AS curr_month"""),
    "split_date_text": """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Mon' END AS weekday,
    CASE WHEN event_id % 4 < 2 THEN CAST(day(ts) AS BIGINT) END AS day,
    CASE WHEN event_id % 4 <> 2 THEN 'january' END AS month FROM events""",
    "stream_silver": STREAM_SILVER,
    "stream_late_rows": """SELECT event_id, ts, event_id % 6 = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR <=
    (SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE event_id % 6 <> 0) AS late FROM events""",
    "stream_daily": STREAM_DAILY,
}

_UNESCAPE = "{x}"
for _reference, _character in (
    ("&nbsp;", " "), ("&deg;", "°"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"),
    ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
):
    _UNESCAPE = f"replace({_UNESCAPE}, '{_reference}', '{_character}')"


def _text(inner: str) -> str:
    return f"trim({_UNESCAPE.format(x=f'''regexp_replace({inner}, '<[^>]*>', '', 'g')''')})"


def _element(pattern: str) -> str:
    found = f"regexp_extract(html, '{pattern}', 1, 's')"
    return f"CASE WHEN regexp_matches(html, '{pattern}', 's') THEN {_text(found)} END"


ORACLES["scrape_fields"] = f"""SELECT page_id,
    {_element('<title>(.*?)</title>')} AS title,
    {_element('<article[^>]*>.*?<h1>(.*?)</h1>')} AS heading,
    {_element('<nav>.*?<li>.*?<a[^>]*>(.*?)</a>')} AS first_link,
    {_element('<div class="ad">(.*?)</div>')} AS notice
  FROM pages"""
