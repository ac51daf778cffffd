"""Raw provider payloads to one forecast table.

A provider is a payload schema and a function that turns the parsed payload into an array of
raw forecasts: text leaves plus a note on how to read their time. All providers are applied in
one projection, so bronze is scanned once whatever their number, and each payload is parsed
with its own provider's schema only. Casts and time conversions come after the arrays are
inlined, as plain column expressions that Spark compiles.

Payload leaves are declared STRING, because providers mix numbers and text in the same field.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import clock
from tidemark.functions.numbers import to_number
from tidemark.functions.text import canonical_source
from tidemark.schemas import FORECAST

# How a forecast's time text is read.
ZONE = "zone"  # wall clock in the IANA zone ``zone``
OFFSET = "offset"  # wall clock, ``ahead`` seconds ahead of UTC, with an hour of its own
SHIFT = "shift"  # wall clock, ``ahead`` hours ahead of UTC
INSTANT = "instant"  # text that carries its own offset
PLAIN = "plain"  # date in UTC

_VALUES = tuple(
    name for name in FORECAST.names
    if name not in ("original_ts", "forecast_date_utc", "forecast_hour_utc")
)


@dataclass(frozen=True)
class Provider:
    schema: str
    forecasts: Callable[[Column], Column]


def raw_forecast(
    time: Column,
    reading: str | Column,
    zone: Column | None = None,
    ahead: Column | None = None,
    **values: Column,
) -> Column:
    """A raw forecast struct of texts; values that are not given are null."""
    unknown = set(values) - set(_VALUES)
    if unknown:
        raise ValueError(f"Not forecast columns: {sorted(unknown)}")
    missing = F.lit(None).cast("string")
    texts = {
        "time": time,
        "reading": F.lit(reading) if isinstance(reading, str) else reading,
        "zone": missing if zone is None else zone,
        "ahead": missing if ahead is None else ahead,
        **{name: values.get(name, missing) for name in _VALUES},
    }
    return F.struct(*[text.alias(name) for name, text in texts.items()])


def _foreca(p: Column) -> Column:
    zoned = p.tz.isNotNull() & (p.tz != "")

    def row(day: Column) -> Column:
        return raw_forecast(
            day.date,
            F.when(zoned, ZONE).otherwise(PLAIN),
            zone=p.tz,
            temp_max=day.maxTemp,
            temp_min=day.minTemp,
            precipitation=day.precipAccum,
            precip_prob=day.precipProb,
            wind_speed=day.maxWindSpeed,
            wind_deg=day.windDir,
            clouds=day.cloudiness,
            weather_description=day.symbolPhrase,
            weather_icon=day.symbol,
            sunrise=day.sunrise,
            sunset=day.sunset,
        )

    return F.transform(p.forecast, row)


def _accuweather(p: Column) -> Column:
    def row(day: Column) -> Column:
        return raw_forecast(
            day.Date,
            INSTANT,
            temp_max=day.Temperature.Maximum.Value,
            temp_min=day.Temperature.Minimum.Value,
            precip_prob=day.Day.PrecipitationProbability,
            weather_description=day.Day.IconPhrase,
            weather_icon=day.Day.Icon,
        )

    return F.transform(p.DailyForecasts, row)


def _tomorrow(p: Column) -> Column:
    def row(day: Column) -> Column:
        v = day["values"]
        return raw_forecast(
            day.time,
            INSTANT,
            temp_max=v.temperatureMax,
            temp_min=v.temperatureMin,
            temp_avg=v.temperatureAvg,
            precipitation=v.rainAccumulationSum,
            rain=v.rainAccumulationSum,
            snow=v.snowAccumulationSum,
            precip_prob=v.precipitationProbabilityAvg,
            humidity=v.humidityAvg,
            wind_speed=v.windSpeedAvg,
            wind_deg=v.windDirectionAvg,
            clouds=v.cloudCoverAvg,
            weather_code=v.weatherCodeMax,
            sunrise=v.sunriseTime,
            sunset=v.sunsetTime,
        )

    return F.transform(p.timelines.daily, row)


def _meteoblue(p: Column) -> Column:
    days = p.data_day

    def row(date: Column, i: Column) -> Column:
        return raw_forecast(
            date,
            SHIFT,
            ahead=p.metadata.utc_timeoffset,
            temp_max=F.get(days.temperature_max, i),
            temp_min=F.get(days.temperature_min, i),
            temp_avg=F.get(days.temperature_mean, i),
            precipitation=F.get(days.precipitation_sum, i),
        )

    return F.transform(days.time, row)


def _weatherbit(p: Column) -> Column:
    zone = F.coalesce(p.timezone, F.lit("UTC"))

    def row(day: Column) -> Column:
        return raw_forecast(
            day.datetime,
            ZONE,
            zone=zone,
            temp_max=day.max_temp,
            temp_min=day.min_temp,
            precipitation=day.precip,
            snow=day.snow,
            precip_prob=day.pop,
            humidity=day.rh,
            wind_speed=day.wind_spd,
            clouds=day.clouds,
            weather_description=day.weather.description,
            weather_icon=day.weather.icon,
        )

    return F.transform(p.data, row)


def _openweathermap(p: Column) -> Column:
    # ``dt_txt`` is read as local time of the city.
    def row(entry: Column) -> Column:
        weather = F.get(entry.weather, F.lit(0))
        return raw_forecast(
            entry.dt_txt,
            OFFSET,
            ahead=p.city.timezone,
            temp_max=entry.main.temp_max,
            temp_min=entry.main.temp_min,
            temp_avg=entry.main.temp,
            precip_prob=entry.pop,
            humidity=entry.main.humidity,
            wind_speed=entry.wind.speed,
            wind_deg=entry.wind.deg,
            clouds=entry.clouds["all"],
            weather_code=weather.id,
            weather_description=weather.description,
            weather_icon=weather.icon,
        )

    return F.transform(p["list"], row)


def _weatherapi(p: Column) -> Column:
    zone = F.coalesce(p.location.tz_id, F.lit("UTC"))

    def row(entry: Column) -> Column:
        day = entry.day
        return raw_forecast(
            entry.date,
            ZONE,
            zone=zone,
            temp_max=day.maxtemp_c,
            temp_min=day.mintemp_c,
            temp_avg=day.avgtemp_c,
            precipitation=day.totalprecip_mm,
            precip_prob=day.daily_chance_of_rain,
            wind_speed=day.maxwind_kph,
            weather_code=day.condition.code,
            weather_description=day.condition.text,
            weather_icon=day.condition.icon,
            sunrise=entry.astro.sunrise,
            sunset=entry.astro.sunset,
        )

    return F.transform(p.forecast.forecastday, row)


def _open_meteo(p: Column) -> Column:
    days = p.daily

    def row(date: Column, i: Column) -> Column:
        return raw_forecast(
            date,
            PLAIN,
            temp_max=F.get(days.temperature_2m_max, i),
            temp_min=F.get(days.temperature_2m_min, i),
            precipitation=F.get(days.precipitation_sum, i),
            rain=F.get(days.rain_sum, i),
            wind_speed=F.get(days.windspeed_10m_max, i),
            clouds=F.get(days.cloudcover_mean, i),
            weather_code=F.get(days.weathercode, i),
        )

    return F.transform(days.time, row)


PARSERS: dict[str, Provider] = {
    "open_meteo": Provider(
        "daily STRUCT<time: ARRAY<STRING>, temperature_2m_max: ARRAY<STRING>, "
        "temperature_2m_min: ARRAY<STRING>, precipitation_sum: ARRAY<STRING>, "
        "rain_sum: ARRAY<STRING>, windspeed_10m_max: ARRAY<STRING>, "
        "cloudcover_mean: ARRAY<STRING>, weathercode: ARRAY<STRING>>",
        _open_meteo,
    ),
    "foreca": Provider(
        "tz STRING, forecast ARRAY<STRUCT<date: STRING, maxTemp: STRING, minTemp: STRING, "
        "precipAccum: STRING, precipProb: STRING, maxWindSpeed: STRING, windDir: STRING, "
        "cloudiness: STRING, symbolPhrase: STRING, symbol: STRING, sunrise: STRING, "
        "sunset: STRING>>",
        _foreca,
    ),
    "accuweather": Provider(
        "DailyForecasts ARRAY<STRUCT<Date: STRING, "
        "Temperature: STRUCT<Minimum: STRUCT<Value: STRING>, Maximum: STRUCT<Value: STRING>>, "
        "Day: STRUCT<PrecipitationProbability: STRING, IconPhrase: STRING, Icon: STRING>>>",
        _accuweather,
    ),
    "meteoblue": Provider(
        "metadata STRUCT<utc_timeoffset: STRING>, data_day STRUCT<time: ARRAY<STRING>, "
        "temperature_max: ARRAY<STRING>, temperature_min: ARRAY<STRING>, "
        "temperature_mean: ARRAY<STRING>, precipitation_sum: ARRAY<STRING>>",
        _meteoblue,
    ),
    "weatherbit": Provider(
        "timezone STRING, data ARRAY<STRUCT<datetime: STRING, max_temp: STRING, "
        "min_temp: STRING, precip: STRING, snow: STRING, pop: STRING, rh: STRING, "
        "wind_spd: STRING, clouds: STRING, weather: STRUCT<description: STRING, icon: STRING>>>",
        _weatherbit,
    ),
    "tomorrow": Provider(
        "timelines STRUCT<daily: ARRAY<STRUCT<time: STRING, values: STRUCT<"
        "temperatureMax: STRING, temperatureMin: STRING, temperatureAvg: STRING, "
        "rainAccumulationSum: STRING, snowAccumulationSum: STRING, "
        "precipitationProbabilityAvg: STRING, humidityAvg: STRING, windSpeedAvg: STRING, "
        "windDirectionAvg: STRING, cloudCoverAvg: STRING, weatherCodeMax: STRING, "
        "sunriseTime: STRING, sunsetTime: STRING>>>>",
        _tomorrow,
    ),
    "openweathermap": Provider(
        "city STRUCT<timezone: STRING>, list ARRAY<STRUCT<dt_txt: STRING, "
        "main: STRUCT<temp: STRING, temp_max: STRING, temp_min: STRING, humidity: STRING>, "
        "weather: ARRAY<STRUCT<id: STRING, description: STRING, icon: STRING>>, "
        "wind: STRUCT<speed: STRING, deg: STRING>, clouds: STRUCT<`all`: STRING>, pop: STRING>>",
        _openweathermap,
    ),
    "weatherapi": Provider(
        "location STRUCT<tz_id: STRING>, forecast STRUCT<forecastday: ARRAY<STRUCT<date: STRING, "
        "day: STRUCT<maxtemp_c: STRING, mintemp_c: STRING, avgtemp_c: STRING, "
        "totalprecip_mm: STRING, daily_chance_of_rain: STRING, maxwind_kph: STRING, "
        "condition: STRUCT<code: STRING, text: STRING, icon: STRING>>, "
        "astro: STRUCT<sunrise: STRING, sunset: STRING>>>>",
        _weatherapi,
    ),
}

# An empty object, array or null, or blanks only.
EMPTY_JSON = r"^\s*(?:\{\s*\}|\[\s*\]|null)?\s*$"

_ENVELOPE = ("source", "place_name", "ingest_date", "ingest_hour")


def to_records(bronze: DataFrame) -> DataFrame:
    """The five bronze columns, with the canonical source name."""
    return bronze.select(
        canonical_source(F.col("source")).alias("source"),
        "place_name", "ingest_date", "ingest_hour", "payload",
    )


def _read_time(rows: DataFrame) -> DataFrame:
    """Add ``original_ts``, ``forecast_date_utc`` and ``forecast_hour_utc`` to raw forecasts.

    The steps are columns of their own, so that each conversion happens once per row.
    """
    reading, time = F.col("reading"), F.col("time")
    ahead = F.coalesce(to_number(F.col("ahead")), F.lit(0.0))
    rows = rows.withColumns(
        {
            "_local": F.when(reading != INSTANT, clock.wall_clock(time)),
            "_ahead": F.when(reading == OFFSET, ahead).when(reading == SHIFT, ahead * 3600),
        }
    )
    local = F.col("_local")
    rows = rows.withColumn(
        "_utc",
        F.when(reading == ZONE, clock.zone_to_utc(local, F.col("zone")))
        .when(reading.isin(OFFSET, SHIFT), clock.offset_to_utc(local, F.col("_ahead")))
        .when(reading == INSTANT, clock.instant_to_utc(time))
        .otherwise(local),
    )
    utc = F.col("_utc")
    rows = rows.withColumn(
        "_offset",
        F.when(reading == ZONE, clock.offset_seconds(local, utc).cast("double"))
        .when(reading == OFFSET, F.col("_ahead")),
    )
    read = F.struct(
        F.when(
            reading.isin(ZONE, OFFSET),
            F.concat(clock.iso_text(local), clock.offset_text(F.col("_offset"))),
        )
        .when(reading == SHIFT, clock.iso_text(local))
        .otherwise(time)
        .alias("original_ts"),
        F.to_date(utc).alias("forecast_date_utc"),
        F.when(reading == OFFSET, F.hour(utc)).alias("forecast_hour_utc"),
    )
    # Filters on these columns stop at a generator; below it they would repeat the conversions.
    return rows.select("*", F.inline(F.array(read)))


def _value(name: str) -> Column:
    kind = FORECAST[name].dataType
    text = F.col(name)
    if isinstance(kind, T.StringType):
        return text
    number = to_number(text)
    return number.try_cast("int") if isinstance(kind, T.IntegerType) else number


def tag_forecasts(bronze: DataFrame, parsers: dict[str, Provider] = PARSERS) -> DataFrame:
    """One row per forecast, or one per unusable record, with a ``reject_reason``.

    The reason is null on good rows. Good and rejected rows come from the same single pass; a
    rejected row's detail is the whole payload.
    """
    source, payload = F.col("source"), F.col("payload")
    parsed = to_records(bronze).select(
        *_ENVELOPE,
        "payload",
        *[
            F.when(source == name, F.from_json("payload", provider.schema)).alias(f"_{name}")
            for name, provider in parsers.items()
        ],
    )
    forecasts = F.lit(None)
    for name, provider in parsers.items():
        forecasts = F.when(source == name, provider.forecasts(F.col(f"_{name}"))).otherwise(forecasts)
    records = parsed.select(*_ENVELOPE, "payload", forecasts.alias("_forecasts"))

    # Judged per record, once for all of its forecasts.
    none = F.col("_forecasts").isNull() | (F.size("_forecasts") == 0)
    fault = (
        F.when(source.isNull() | ~source.isin(*parsers), "unknown_source")
        .when(payload.isNull() | payload.rlike(EMPTY_JSON), "empty_payload")
        .when(none & F.try_parse_json("payload").isNull(), "malformed_json")
        .when(none, "no_forecasts")
    )
    records = records.select(
        *_ENVELOPE,
        "_forecasts",
        fault.alias("_fault"),
        "payload",
    )
    rows = _read_time(records.select(*_ENVELOPE, "_fault", "payload", F.inline_outer("_forecasts")))
    undated = F.when(F.col("forecast_date_utc").isNull(), "undated_forecast")
    reason = F.coalesce(F.col("_fault"), undated)
    return rows.select(
        source.alias("api_name"),
        "place_name", "ingest_date", "ingest_hour",
        "original_ts", "forecast_date_utc", "forecast_hour_utc",
        *[_value(name).alias(name) for name in _VALUES],
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), payload).alias("reject_detail"),
    )


def accepted(tagged: DataFrame) -> DataFrame:
    """The good rows of ``tag_forecasts`` in the parsed layout."""
    return tagged.where(F.col("reject_reason").isNull()).drop("reject_reason", "reject_detail")


def rejected(tagged: DataFrame) -> DataFrame:
    """The unusable rows of ``tag_forecasts``."""
    return tagged.where(F.col("reject_reason").isNotNull()).select(
        F.col("api_name").alias("source"),
        "place_name", "ingest_date", "ingest_hour",
        F.col("reject_reason").alias("reason"),
        F.col("reject_detail").alias("detail"),
    )


def parse_bronze(bronze: DataFrame) -> DataFrame:
    """All providers' forecasts as one table; unusable records are left out."""
    return accepted(tag_forecasts(bronze))


def parse_provider(bronze: DataFrame, name: str) -> DataFrame:
    """Forecasts of one provider, under any spelling that ``to_records`` takes for it."""
    one = bronze.where(canonical_source(F.col("source")) == name)
    return accepted(tag_forecasts(one, {name: PARSERS[name]}))


def parse_metrics(tagged: DataFrame) -> DataFrame:
    """Rows parsed, rows rejected and reasons per provider, place and hour."""
    reason = F.col("reject_reason")
    return tagged.groupBy(
        F.col("api_name").alias("source"), "place_name", "ingest_date", "ingest_hour"
    ).agg(
        F.count_if(reason.isNull()).alias("row_count"),
        F.count_if(reason.isNotNull()).alias("rejected_count"),
        (F.count_if(reason.isNotNull()) == 0).alias("success"),
        F.min(reason).alias("reason"),
    )
