"""The engine's inputs as views of the given tables. Every view uses all rows of its table."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import clock
from tidemark.operators import rollups, state as st
from tidemark.operators.parsers import PARSERS
from tidemark.sources.slices import calendar_of

EPOCH = dt.date(1995, 1, 1)
AS_OF = dt.date(2002, 1, 1)
NOW = dt.datetime(2024, 2, 1)


# The kinds of events, which stand for providers.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


# Rows that one task turns into payloads.
PAYLOADS = 25_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, size: int = PAYLOADS) -> DataFrame:
    """The same rows, dealt over tasks of about ``size`` rows each.

    A row group of a narrow table holds a million rows in a few megabytes and is read by one task. What
    is made of its rows would be that one task's work.
    """
    parts = -(-rows.count() // size)
    return rows.repartition(parts) if parts > 1 else rows


def observe(events: DataFrame, *extra: str) -> DataFrame:
    """Events as parsed, uncleaned forecast rows: text and out-of-range numbers occur."""
    e, k, v = F.col("event_id"), F.get_json_object("props", "$.k").cast("int"), F.col("value")
    day = F.to_date("ts")
    warm = v - 100
    return events.select(
        *extra,
        e,
        F.col("event_type").alias("api_name"),
        F.concat(F.lit("place_"), F.col("user_id") % 5).alias("place_name"),
        day.alias("ingest_date"),
        F.hour("ts").alias("ingest_hour"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("original_ts"),
        F.date_add(day, (e % 8).cast("int")).alias("forecast_date_utc"),
        F.when(e % 4 != 0, F.hour("ts")).alias("forecast_hour_utc"),
        F.when(e % 11 == 0, "n/a").otherwise(warm.cast("string")).alias("temp_max"),
        (warm - 5).alias("temp_min"),
        F.when(F.col("event_type") != "error", warm - 2).alias("temp_avg"),
        v.alias("precipitation"),
        (v * 3).alias("rain"),
        (k - 10).cast("double").alias("snow"),
        (k + 5).cast("double").alias("precip_prob"),
        k.cast("double").alias("humidity"),
        (v / 2).alias("wind_speed"),
        v.alias("wind_deg"),
        (k + e % 10).cast("double").alias("clouds"),
        k.alias("weather_code"),
        F.when(e % 7 != 0, F.col("event_type")).alias("weather_description"),
        k.cast("string").alias("weather_icon"),
        F.when(e % 3 == 0, F.concat(day, F.lit("T06:30:00+02:00")))
        .when(e % 3 == 1, F.lit("07:17 AM"))
        .otherwise("unknown").alias("sunrise"),
        F.when(e % 3 == 0, F.lit("18:05:30"))
        .when(e % 3 == 1, F.concat(day, F.lit(" 17:45:00")))
        .alias("sunset"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe(table(spark, sf_dir, "events"))


def _day_number(column: str) -> Column:
    return F.datediff(F.to_date(column), F.lit(EPOCH))


def thinned_day(column: str) -> Column:
    """Dates spread wider and wider from 1995 on, so that later periods miss more and more days."""
    n = _day_number(column)
    return F.date_add(F.lit(EPOCH), F.floor(n * n / 2600).cast("int"))


def _gold_rows(rows: DataFrame, day: Column, place: Column, level: Column, amount: Column) -> DataFrame:
    """Hourly gold rows from a place, a level and an amount."""
    values = {
        "temp_min": level - 5, "temp_max": level + 5, "temp_avg": level,
        "rain": amount / 100, "snow": level / 7, "wind_speed": level * 2,
        "cloud_cover": amount / 1000, "humidity": level + 0.5,
    }
    measures = [values[n].alias(n) for n in ("temp_min", "temp_max", "temp_avg")]
    for metric in ("rain", "snow", "wind_speed", "cloud_cover", "humidity"):
        measures += [values[metric].alias(f"{metric}_{stat}") for stat in ("min", "max", "avg")]
    return rows.select(
        day.cast("timestamp_ntz").alias("snapshot_ts"),
        place.alias("place_name"),
        day.alias("forecast_date_utc"),
        day.alias("ingest_date"),
        F.lit(0).alias("ingest_hour"),
        *measures,
    )


def hourly_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as hourly gold rows on thinned days."""
    return _gold_rows(
        table(spark, sf_dir, "lineitem"),
        thinned_day("l_shipdate"),
        F.concat("l_returnflag", F.lit("-"), "l_linestatus"),
        F.col("l_quantity"),
        F.col("l_extendedprice"),
    )


def daily_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_summary(hourly_gold(spark, sf_dir)).drop("day")


def second_daily_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as daily gold rows on their own days: the fallback copy without gaps."""
    hourly = _gold_rows(
        table(spark, sf_dir, "orders"),
        F.to_date("o_orderdate"),
        F.concat(F.lit("order-"), "o_orderstatus"),
        F.col("o_orderkey") % 50,
        F.col("o_totalprice"),
    )
    return rollups.daily_summary(hourly).drop("day")


def gold_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its thinned day only: the scan reads a single column."""
    return table(spark, sf_dir, "lineitem").select(thinned_day("l_shipdate").alias("day"))


def calendar_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (first, end): the days of the orders, the last one included."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").agg(
        F.min(day).alias("first"), F.date_add(F.max(day), 1).alias("end")
    )


_STATE_LEVELS = ("gold_daily", "gold_weekly", "gold_monthly")


def _pick(number: Column, *values: str | None) -> Column:
    return F.array(*[F.lit(v) for v in values])[(number % len(values)).cast("int")]


def processing_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state row per day of the lineitem calendar; days without rows are in varied states."""
    days = gold_days(spark, sf_dir)
    bounds = days.agg(F.lit(EPOCH).alias("first"), F.date_add(F.max("day"), 1).alias("end"))
    marked = st.evidence(calendar_of(bounds, "day"), days.select(F.col("day").alias("partition_date")))
    n = F.datediff("partition_date", F.lit(EPOCH))
    done = F.col("status") == "success"
    actual = F.when(done, 24).otherwise(n % 24)
    return marked.select(
        _pick(n, *_STATE_LEVELS).alias("processing_level"),
        "partition_date",
        F.when(n % 8 != 0, clock.period_label(F.col("partition_date"), "day")).alias("period_name"),
        F.when(done, "success")
        .otherwise(_pick(n, "pending", "failed", "partial", "abandoned", "processing")).alias("status"),
        F.lit(24).alias("expected_count"),
        actual.alias("actual_count"),
        F.bround(actual / 24, 4).alias("completeness_ratio"),
        (actual == 24).alias("is_acceptable"),
        (n % 6).alias("retry_count"),
        F.lit(NOW).cast("timestamp_ntz").alias("created_at"),
        F.date_add("partition_date", 2).cast("timestamp_ntz").alias("updated_at"),
        F.when(
            ~done, _pick(n, None, "missing_partitions", "insufficient_data", "transformation_error")
        ).alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
    )


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event per order on its day; many orders share a day, so events are folded by order key."""
    o, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    n = F.datediff(day, F.lit(EPOCH))
    return table(spark, sf_dir, "orders").select(
        _pick(n, *_STATE_LEVELS).alias("processing_level"),
        day.alias("partition_date"),
        o.alias("seq"),
        F.when(o % 3 == 0, F.concat(F.lit("run_"), o)).alias("period_name"),
        F.when(o % 97 == 0, "abandoned")
        .otherwise(_pick(o, "processing", "pending", "success", "failed")).alias("status"),
        F.lit(24).alias("expected_count"),
        (o % 25).cast("int").alias("actual_count"),
        F.when(o % 4 == 3, "missing_partitions").alias("error_type"),
        F.col("o_orderpriority").alias("error_message"),
    )


# ---------------------------------------------------------------- raw payloads

ZONES = ("Europe/Sofia", "UTC", "America/New_York")
# The events lie in January: offsets without daylight saving.
ZONE_HOURS = (2, 0, -5)
ZONE_OFFSETS = ("+02:00", "+00:00", "-05:00")


def _days(build) -> Column:
    """Array of one struct per forecast day: the event's day and the two after it."""
    return F.transform(F.sequence(F.lit(0), F.lit(2)), build)


def _keyed(events: DataFrame) -> DataFrame:
    """Events with the text of their number ``k``, read once for all places of a payload that show it."""
    return events.withColumn("_k", F.get_json_object("props", "$.k"))


def _payload(provider: str) -> Column:
    """The payload of a provider built from one event (``_keyed``): three forecasts."""
    e, v, k = F.col("event_id"), F.col("value"), F.col("_k").cast("int")
    zone = _pick(F.col("user_id"), *ZONES)
    hours = F.array(*[F.lit(h) for h in ZONE_HOURS])[(F.col("user_id") % 3).cast("int")]
    offset = _pick(F.col("user_id"), *ZONE_OFFSETS)
    kind = F.col("event_type")
    moment = F.date_format("ts", "HH:00:00")

    def date(i: Column) -> Column:
        return F.date_add(F.to_date("ts"), i).cast("string")

    warm = v - 100

    def foreca(i: Column) -> Column:
        return F.struct(
            date(i).alias("date"),
            F.when(e % 11 == 0, "n/a").otherwise((warm + i).cast("string")).alias("maxTemp"),
            (warm - i).alias("minTemp"),
            v.alias("precipAccum"),
            k.alias("precipProb"),
            (v / 2).alias("maxWindSpeed"),
            (k + i).alias("windDir"),
            k.alias("cloudiness"),
            kind.alias("symbolPhrase"),
            F.concat(F.lit("d"), k).alias("symbol"),
            F.lit("07:17:00").alias("sunrise"),
            F.lit("17:45:00").alias("sunset"),
        )

    def accuweather(i: Column) -> Column:
        return F.struct(
            F.concat(date(i), F.lit("T"), moment, offset).alias("Date"),
            F.struct(
                F.struct((warm - i).alias("Value")).alias("Minimum"),
                F.when(e % 9 != 0, F.struct((warm + i).alias("Value"))).alias("Maximum"),
            ).alias("Temperature"),
            F.struct(
                k.alias("PrecipitationProbability"), kind.alias("IconPhrase"), k.alias("Icon")
            ).alias("Day"),
        )

    def tomorrow(i: Column) -> Column:
        return F.struct(
            F.concat(date(i), F.lit("T"), moment, F.lit("Z")).alias("time"),
            F.struct(
                (warm + i).alias("temperatureMax"),
                (warm - i).alias("temperatureMin"),
                warm.alias("temperatureAvg"),
                v.alias("rainAccumulationSum"),
                (v / 4).alias("snowAccumulationSum"),
                k.alias("precipitationProbabilityAvg"),
                k.alias("humidityAvg"),
                (v / 2).alias("windSpeedAvg"),
                (k + i).alias("windDirectionAvg"),
                k.alias("cloudCoverAvg"),
                (k + 1000).alias("weatherCodeMax"),
                F.concat(date(i), F.lit("T05:30:00Z")).alias("sunriseTime"),
                F.concat(date(i), F.lit("T16:30:00Z")).alias("sunsetTime"),
            ).alias("values"),
        )

    def weatherbit(i: Column) -> Column:
        return F.struct(
            date(i).alias("datetime"),
            (warm + i).alias("max_temp"),
            (warm - i).alias("min_temp"),
            v.alias("precip"),
            (v / 4).alias("snow"),
            k.alias("pop"),
            k.alias("rh"),
            (v / 2).alias("wind_spd"),
            (k + i).alias("clouds"),
            F.when(e % 9 != 0, F.struct(kind.alias("description"), F.concat(F.lit("c"), k).alias("icon")))
            .alias("weather"),
        )

    def openweathermap(i: Column) -> Column:
        return F.struct(
            F.date_format(F.col("ts") + F.make_dt_interval(hours=3 * i), "yyyy-MM-dd HH:mm:ss").alias("dt_txt"),
            F.struct(
                warm.alias("temp"), (warm + i).alias("temp_max"), (warm - i).alias("temp_min"),
                k.alias("humidity"),
            ).alias("main"),
            F.when(
                e % 9 != 0,
                F.array(F.struct((k + 200).alias("id"), kind.alias("description"), F.lit("10d").alias("icon"))),
            ).otherwise(F.array().cast("array<struct<id:int,description:string,icon:string>>")).alias("weather"),
            F.struct((v / 2).alias("speed"), (k + i).alias("deg")).alias("wind"),
            F.struct(k.alias("all")).alias("clouds"),
            (k / 100).alias("pop"),
        )

    def weatherapi(i: Column) -> Column:
        return F.struct(
            date(i).alias("date"),
            F.struct(
                (warm + i).alias("maxtemp_c"),
                (warm - i).alias("mintemp_c"),
                warm.alias("avgtemp_c"),
                v.alias("totalprecip_mm"),
                k.alias("daily_chance_of_rain"),
                (v / 2).alias("maxwind_kph"),
                F.struct((k + 1000).alias("code"), kind.alias("text"), F.lit("//icon.png").alias("icon"))
                .alias("condition"),
            ).alias("day"),
            F.struct(F.lit("07:17 AM").alias("sunrise"), F.lit("05:45 PM").alias("sunset")).alias("astro"),
        )

    def series(value, count: int = 3) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), value)

    bodies = {
        "foreca": lambda: F.struct(F.when(e % 13 != 0, zone).alias("tz"), _days(foreca).alias("forecast")),
        "accuweather": lambda: F.struct(_days(accuweather).alias("DailyForecasts")),
        "tomorrow": lambda: F.struct(F.struct(_days(tomorrow).alias("daily")).alias("timelines")),
        "meteoblue": lambda: F.struct(
            F.struct(hours.alias("utc_timeoffset")).alias("metadata"),
            F.struct(
                series(date).alias("time"),
                series(lambda i: warm + i).alias("temperature_max"),
                series(lambda i: warm - i).alias("temperature_min"),
                # Shorter than the times: the last day has no mean.
                series(lambda i: warm, 2).alias("temperature_mean"),
                F.when(e % 5 != 0, series(lambda i: v)).alias("precipitation_sum"),
            ).alias("data_day"),
        ),
        "weatherbit": lambda: F.struct(
            F.when(e % 13 != 0, zone).alias("timezone"), _days(weatherbit).alias("data")
        ),
        "openweathermap": lambda: F.struct(
            F.struct((hours * 3600).alias("timezone")).alias("city"), _days(openweathermap).alias("list")
        ),
        "weatherapi": lambda: F.struct(
            F.struct(zone.alias("tz_id")).alias("location"),
            F.struct(_days(weatherapi).alias("forecastday")).alias("forecast"),
        ),
        "open_meteo": lambda: F.struct(
            F.struct(
                series(date).alias("time"),
                series(lambda i: warm + i).alias("temperature_2m_max"),
                series(lambda i: warm - i).alias("temperature_2m_min"),
                series(lambda i: v).alias("precipitation_sum"),
                series(lambda i: v / 4).alias("rain_sum"),
                series(lambda i: v / 2, 2).alias("windspeed_10m_max"),
                series(lambda i: k + i).alias("cloudcover_mean"),
                F.when(e % 5 != 0, series(lambda i: k)).alias("weathercode"),
            ).alias("daily")
        ),
    }
    return F.to_json(bodies[provider]())


def _envelope(source: Column, payload: Column, place: Column | None = None, hour: Column | None = None) -> list[Column]:
    return [
        source.alias("source"),
        (F.concat(F.lit("place_"), F.col("user_id")) if place is None else place).alias("place_name"),
        F.to_date("ts").alias("ingest_date"),
        (F.hour("ts") if hour is None else hour).alias("ingest_hour"),
        payload.alias("payload"),
    ]


def provider_bronze(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """Every event as a payload of one provider."""
    events = _keyed(spread(table(spark, sf_dir, "events")))
    return events.select(*_envelope(F.lit(provider), _payload(provider)))


PROVIDER_ORDER = tuple(sorted(PARSERS))


def mix_providers(events: DataFrame, place: Column | None = None, hour: Column | None = None) -> DataFrame:
    """Every event as a payload of a provider that changes with the event, faulty ones among them."""
    kind = F.col("event_id") % 12
    source = F.lit("unlisted_site")
    payload = F.lit('{"a": 1}')
    for i, name in enumerate(PROVIDER_ORDER):
        # Half of the providers come under their longer name.
        source = F.when(kind == i, F.lit(f"{name}_api" if i % 2 else name)).otherwise(source)
        payload = F.when(kind == i, _payload(name)).otherwise(payload)
    source = F.when(kind.isin(8, 9, 10), F.lit("foreca")).otherwise(source)
    payload = (
        F.when(kind == 8, F.lit("{}"))
        .when(kind == 9, F.concat(F.lit('{"forecast": ['), F.repeat(F.lit("x"), F.lit(400))))
        .when(kind == 10, F.lit('{"forecast": [{"date": "soon", "maxTemp": 3}]}'))
        .otherwise(payload)
    )
    return _keyed(events).select(*_envelope(source, payload, place, hour))


def mixed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_providers(spread(table(spark, sf_dir, "events")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a payload of a station that no parser of the engine knows."""
    pair = F.struct(F.col("value").cast("string").alias("high"), (F.col("value") - 5).cast("string").alias("low"))
    payload = F.to_json(F.struct(F.to_date("ts").cast("string").alias("day"), F.array(pair, pair).alias("readings")))
    return table(spark, sf_dir, "events").select(*_envelope(F.lit("own_station"), payload))


# ---------------------------------------------------------------- files


def block(spark: SparkSession, path: str) -> None:
    """Put a file where a lake wants a folder, so that nothing can be written below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target).close()


def write_raw_files(events: DataFrame, base: str) -> None:
    """Events as raw files {date}_{source}_{place}/{hour}.json, all payloads of an hour in one array.

    Spark writes one file per folder and hour; they are then renamed to what a collector would call them.
    """
    spark = events.sparkSession
    folder = F.concat(F.to_date("ts").cast("string"), F.lit("_sensor_place-"), F.col("user_id") % 2)
    hours = events.groupBy(folder.alias("folder"), F.date_format("ts", "HH").alias("hour")).agg(
        F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("props")), ","), F.lit("]")).alias("value")
    )
    made = f"{base}-{uuid.uuid4().hex}"
    hours.repartition("folder").write.partitionBy("folder", "hour").text(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(path(f"{made}/folder=*/hour=*/part-*")):
        source = found.getPath()
        hour, day = source.getParent(), source.getParent().getParent()
        target = path(f"{base}/{day.getName().removeprefix('folder=')}")
        files.mkdirs(target)
        files.rename(source, path(target, f"{hour.getName().removeprefix('hour=')}.json"))


# ---------------------------------------------------------------- stored pages

def site_pages(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    """Every event as a page in the layout of a site, with nested and misleading elements."""
    e, v = F.col("event_id"), F.col("value")
    k = F.get_json_object("props", "$.k")
    kind, place = F.col("event_type"), F.concat(F.lit("PLACE "), F.col("user_id"), F.lit(", Region"))
    clock_text = F.date_format("ts", "HH:mm")
    day, month = F.dayofmonth("ts"), F.lit("january")

    def page(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    html = {
        "meteoblue": page(
            '<html><script>var x="<a class=\'home\'>";</script><body><a href="/" class="nav home">',
            '<i>x</i><span itemprop="name"> ', place, ' </span></a><div class="current-description">\n ',
            clock_text, ' </div><div class="current-temp h1">99</div><div class="h1 current-temp"> -',
            k, '&nbsp;&deg;C</div></body></html>',
        ),
        "sinoptik": page(
            '<h1 class="currentCity">', place, '</h1><!-- <span class="time">00:00</span> -->',
            '<span class="wfNonCurrentDate">', day, ' ', month, '</span><span class="time">', clock_text,
            '</span><span class="wfCurrentTemp">', k, '&deg;</span>',
            '<div class="wfCurrentWindContainer"><div><b>', kind, '</b></div> wind</div>',
            '<span class="wfCurrentWind">', F.floor(v), ' m/s</span>',
        ),
        "accuweather": page(
            '<h1 class="header-loc big">', place, '</h1>',
            '<div class="content-module subnav-pagination">MON, ', day, ' ', month, '</div>',
            '<p class="sub"> ', clock_text, ' </p><div class="temp"><div class="display-temp">', k,
            '&deg;<span>C</span></div></div><div class="phrase">', kind, '</div>',
            '<div class="detail-item spaced-content"><div>Wind</div><div>NE ', F.floor(v), ' km/h</div></div>',
        ),
    }[site]
    return table(spark, sf_dir, "events").select(e.alias("page_id"), html.alias("html"))
