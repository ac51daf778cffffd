"""Table schemas. Every timestamp is UTC wall-clock time, stored without a zone."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE, TIMESTAMP = T.BooleanType(), T.DateType(), T.TimestampNTZType()


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


METRICS = ("temp", "rain", "snow", "wind_speed", "cloud_cover", "humidity")
MEASURES = tuple(f"{metric}_{stat}" for metric in METRICS for stat in ("min", "max", "avg"))

_MEASURES = {name: DOUBLE for name in MEASURES}

BRONZE = _fields(
    source=STRING, place_name=STRING, ingest_date=DATE, ingest_hour=INT, payload=STRING,
)

# One forecast inside a payload, in the order the parsers emit it.
FORECAST = _fields(
    original_ts=STRING, forecast_date_utc=DATE, forecast_hour_utc=INT, temp_max=DOUBLE,
    temp_min=DOUBLE, temp_avg=DOUBLE, precipitation=DOUBLE, rain=DOUBLE, snow=DOUBLE,
    precip_prob=DOUBLE, humidity=DOUBLE, wind_speed=DOUBLE, wind_deg=DOUBLE, clouds=DOUBLE,
    weather_code=INT, weather_description=STRING, weather_icon=STRING, sunrise=STRING,
    sunset=STRING,
)

ENVELOPE = _fields(
    api_name=STRING, place_name=STRING, ingest_date=DATE, ingest_hour=INT,
)

PARSED = T.StructType(ENVELOPE.fields + FORECAST.fields)

SILVER = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType()) if f.name in ("sunrise", "sunset") else f
        for f in PARSED.fields
    ]
    + [T.StructField("batch_id", T.StringType())]
)

SILVER_KEY = (
    "api_name", "place_name", "forecast_date_utc", "forecast_hour_utc", "ingest_date", "ingest_hour",
)

REJECTED = _fields(
    source=STRING, place_name=STRING, ingest_date=DATE, ingest_hour=INT, reason=STRING,
    detail=STRING,
)

GOLD_FORECAST = _fields(
    snapshot_ts=TIMESTAMP, place_name=STRING, forecast_date_utc=DATE, ingest_date=DATE,
    ingest_hour=INT, **_MEASURES, generated_at=TIMESTAMP,
)

GOLD_DAILY = _fields(
    place_name=STRING, forecast_date_utc=DATE, ingest_date=DATE, ingest_hour=INT, **_MEASURES,
    generated_at=TIMESTAMP,
)

GOLD_WEEKLY = _fields(
    place_name=STRING, year=INT, iso_year=INT, week_number=INT, week_start=DATE, **_MEASURES,
    generated_at=TIMESTAMP,
)

GOLD_MONTHLY = _fields(
    place_name=STRING, year=INT, month_number=INT, month_start=DATE, **_MEASURES,
    generated_at=TIMESTAMP,
)

GOLD_SEASONAL = _fields(
    place_name=STRING, year=INT, season_name=STRING, period_start=DATE, **_MEASURES,
    generated_at=TIMESTAMP,
)

GOLD_YEARLY = _fields(
    place_name=STRING, year=INT, year_start=DATE, period_type=STRING, **_MEASURES,
    updated_at=TIMESTAMP,
)

STATE = _fields(
    processing_level=STRING, partition_date=DATE, period_name=STRING, status=STRING,
    expected_count=INT, actual_count=INT, completeness_ratio=DOUBLE, is_acceptable=BOOLEAN,
    retry_count=INT, created_at=TIMESTAMP, updated_at=TIMESTAMP, error_type=STRING,
    error_message=STRING,
)

STATE_EVENT = _fields(
    processing_level=STRING, partition_date=DATE, seq=BIGINT, period_name=STRING, status=STRING,
    expected_count=INT, actual_count=INT, error_type=STRING, error_message=STRING,
)

# Events as they are logged: numbers rise from run to run, so they also say what has been folded.
STATE_LOG = T.StructType(STATE_EVENT.fields + [T.StructField("recorded_at", TIMESTAMP)])

# State rows as they are stored, with the number of the last event folded into the level.
STATE_STORED = T.StructType(STATE.fields + [T.StructField("last_event", BIGINT)])

# What the source rows of a place and period add up to; ``parts`` has a bit per source partition.
PARTIAL = _fields(
    level=STRING, place_name=STRING, period_start=DATE, parts=BIGINT,
    **{
        f"{metric}_{part}": kind
        for metric in METRICS
        for part, kind in (("min", DOUBLE), ("max", DOUBLE), ("sum", T.DecimalType(38, 9)), ("n", BIGINT))
    },
)

WATERMARK = _fields(
    job_name=STRING, last_processed_ts=TIMESTAMP, updated_at=TIMESTAMP,
)

LOCATION = _fields(
    place_name=STRING, lat=DOUBLE, lon=DOUBLE, country_code=STRING, country_name=STRING,
)

# Declared input and output columns of the scraped pages, per site.
SCRAPED_IN = {
    "accuweather": _fields(
        city=STRING, curr_day=STRING, curr_time=STRING, temperature=STRING, weather=STRING,
        wind_km_h=STRING,
    ),
    "meteoblue": _fields(
        city=STRING, curr_time=STRING, temperature=STRING,
    ),
    "sinoptik": _fields(
        city=STRING, curr_day=STRING, curr_time=STRING, temperature=STRING, weather=STRING,
        wind_m_s=STRING,
    ),
}

SCRAPED_OUT = {
    "accuweather": _fields(
        city=STRING, curr_time=STRING, temperature=BIGINT, weather=STRING, weekday=STRING,
        wind_m_s=BIGINT, curr_day=BIGINT, curr_month=STRING,
    ),
    "meteoblue": _fields(
        city=STRING, curr_time=STRING, temperature=BIGINT,
    ),
    "sinoptik": _fields(
        city=STRING, curr_time=STRING, temperature=BIGINT, weather=STRING, wind_m_s=BIGINT,
        curr_day=BIGINT, curr_month=STRING,
    ),
}
