import datetime as dt
import json

from tidemark.operators import parsers
from tidemark.operators.flatten import combine, flatten_payloads
from tidemark.schemas import BRONZE, PARSED

DAY = dt.date(2026, 2, 20)


def bronze(spark, *records):
    rows = [
        (source, "Hilltop", DAY, 8, payload if payload is None or isinstance(payload, str) else json.dumps(payload))
        for source, payload in records
    ]
    return spark.createDataFrame(rows, BRONZE)


def parse(spark, source, payload):
    df = parsers.parse_bronze(bronze(spark, (source, payload)))
    assert df.schema.names == PARSED.names
    return [r.asDict() for r in df.collect()]


def given(row):
    """Fields that are set, without the envelope."""
    return {k: v for k, v in row.items() if v is not None and k not in ("api_name", "place_name", "ingest_date", "ingest_hour")}


def test_foreca_local_midnight_is_the_previous_day_in_utc(spark):
    payload = {
        "tz": "Europe/Sofia",
        "forecast": [
            {
                "date": "2026-02-21", "maxTemp": 5, "minTemp": -3.5, "precipAccum": 1.2, "precipProb": 40,
                "maxWindSpeed": 7, "windDir": 270, "cloudiness": 80, "symbolPhrase": "snow", "symbol": "d412",
                "sunrise": "07:17:00", "sunset": "18:02:00",
            },
            {"date": "2026-07-01", "maxTemp": "n/a"},
        ],
    }
    winter, summer = sorted(parse(spark, "foreca", payload), key=lambda r: r["original_ts"])
    assert given(winter) == {
        "original_ts": "2026-02-21T00:00:00+02:00", "forecast_date_utc": dt.date(2026, 2, 20),
        "temp_max": 5.0, "temp_min": -3.5, "precipitation": 1.2, "precip_prob": 40.0, "wind_speed": 7.0,
        "wind_deg": 270.0, "clouds": 80.0, "weather_description": "snow", "weather_icon": "d412",
        "sunrise": "07:17:00", "sunset": "18:02:00",
    }
    assert (winter["api_name"], winter["place_name"], winter["ingest_date"], winter["ingest_hour"]) == (
        "foreca", "Hilltop", DAY, 8,
    )
    # Daylight saving: three hours ahead. Text that is no number is null.
    assert summer["original_ts"] == "2026-07-01T00:00:00+03:00"
    assert summer["forecast_date_utc"] == dt.date(2026, 6, 30)
    assert summer["temp_max"] is None


def test_foreca_without_zone_keeps_the_date(spark):
    (row,) = parse(spark, "foreca", {"forecast": [{"date": "2026-02-21", "maxTemp": 1}]})
    assert given(row) == {
        "original_ts": "2026-02-21", "forecast_date_utc": dt.date(2026, 2, 21), "temp_max": 1.0,
    }


def test_accuweather_offset_and_missing_structs(spark):
    payload = {
        "DailyForecasts": [
            {
                "Date": "2026-02-21T01:00:00+02:00",
                "Temperature": {"Minimum": {"Value": -1.0}, "Maximum": {"Value": 4}},
                "Day": {"PrecipitationProbability": 25, "IconPhrase": "Sunny", "Icon": 1},
            },
            {"Date": "2026-02-22T07:00:00+02:00", "Temperature": {"Minimum": {"Value": 2}}},
        ]
    }
    first, second = sorted(parse(spark, "accuweather", payload), key=lambda r: r["original_ts"])
    assert given(first) == {
        "original_ts": "2026-02-21T01:00:00+02:00", "forecast_date_utc": dt.date(2026, 2, 20),
        "temp_min": -1.0, "temp_max": 4.0, "precip_prob": 25.0, "weather_description": "Sunny", "weather_icon": "1",
    }
    assert given(second) == {
        "original_ts": "2026-02-22T07:00:00+02:00", "forecast_date_utc": dt.date(2026, 2, 22), "temp_min": 2.0,
    }


def test_tomorrow_rain_fills_two_columns(spark):
    values = {
        "temperatureMax": 3, "temperatureMin": 1, "temperatureAvg": 2, "rainAccumulationSum": 0.4,
        "snowAccumulationSum": 0.1, "precipitationProbabilityAvg": 5, "humidityAvg": 60, "windSpeedAvg": 2.5,
        "windDirectionAvg": 10, "cloudCoverAvg": 99, "weatherCodeMax": 1001,
        "sunriseTime": "2026-02-21T05:17:00Z", "sunsetTime": "2026-02-21T16:00:00Z",
    }
    (row,) = parse(spark, "tomorrow", {"timelines": {"daily": [{"time": "2026-02-21T04:00:00Z", "values": values}]}})
    assert given(row) == {
        "original_ts": "2026-02-21T04:00:00Z", "forecast_date_utc": dt.date(2026, 2, 21), "temp_max": 3.0,
        "temp_min": 1.0, "temp_avg": 2.0, "precipitation": 0.4, "rain": 0.4, "snow": 0.1, "precip_prob": 5.0,
        "humidity": 60.0, "wind_speed": 2.5, "wind_deg": 10.0, "clouds": 99.0, "weather_code": 1001,
        "sunrise": "2026-02-21T05:17:00Z", "sunset": "2026-02-21T16:00:00Z",
    }


def test_meteoblue_short_arrays_end_in_nulls(spark):
    payload = {
        "metadata": {"utc_timeoffset": 2.5},
        "data_day": {
            "time": ["2026-02-21", "2026-02-22"], "temperature_max": [1, 2], "temperature_min": [0],
            "temperature_mean": [0.5, 1.5, 9.9],
        },
    }
    first, second = sorted(parse(spark, "meteoblue", payload), key=lambda r: r["original_ts"])
    assert given(first) == {
        "original_ts": "2026-02-21T00:00:00", "forecast_date_utc": dt.date(2026, 2, 20),
        "temp_max": 1.0, "temp_min": 0.0, "temp_avg": 0.5,
    }
    # No row for the surplus mean, no minimum on the second day.
    assert given(second) == {
        "original_ts": "2026-02-22T00:00:00", "forecast_date_utc": dt.date(2026, 2, 21),
        "temp_max": 2.0, "temp_avg": 1.5,
    }


def test_weatherbit_zone_defaults_to_utc(spark):
    day = {
        "datetime": "2026-02-21", "max_temp": 1, "min_temp": 0, "precip": 2, "snow": 3, "pop": 4, "rh": 5,
        "wind_spd": 6, "clouds": 7, "weather": {"description": "fog", "icon": "a01d"},
    }
    (utc,) = parse(spark, "weatherbit", {"data": [day]})
    (west,) = parse(spark, "weatherbit", {"timezone": "America/New_York", "data": [day]})
    assert (utc["original_ts"], utc["forecast_date_utc"]) == ("2026-02-21T00:00:00+00:00", dt.date(2026, 2, 21))
    assert (west["original_ts"], west["forecast_date_utc"]) == ("2026-02-21T00:00:00-05:00", dt.date(2026, 2, 21))
    assert given(utc) == {
        "original_ts": "2026-02-21T00:00:00+00:00", "forecast_date_utc": dt.date(2026, 2, 21),
        "temp_max": 1.0, "temp_min": 0.0, "precipitation": 2.0, "snow": 3.0, "precip_prob": 4.0, "humidity": 5.0,
        "wind_speed": 6.0, "clouds": 7.0, "weather_description": "fog", "weather_icon": "a01d",
    }


def test_openweathermap_has_hours_and_a_fixed_offset(spark):
    entry = {
        "dt_txt": "2026-02-21 01:00:00", "main": {"temp": 1, "temp_max": 2, "temp_min": 0, "humidity": 50},
        "weather": [{"id": 800, "description": "clear", "icon": "01n"}, {"id": 1}],
        "wind": {"speed": 3, "deg": 90}, "clouds": {"all": 10}, "pop": 0.2,
    }
    bare = {"dt_txt": "2026-02-21 04:00:00", "weather": []}
    first, second = sorted(
        parse(spark, "openweathermap", {"city": {"timezone": 7200}, "list": [entry, bare]}),
        key=lambda r: r["original_ts"],
    )
    assert given(first) == {
        "original_ts": "2026-02-21T01:00:00+02:00", "forecast_date_utc": dt.date(2026, 2, 20),
        "forecast_hour_utc": 23, "temp_max": 2.0, "temp_min": 0.0, "temp_avg": 1.0, "precip_prob": 0.2,
        "humidity": 50.0, "wind_speed": 3.0, "wind_deg": 90.0, "clouds": 10.0, "weather_code": 800,
        "weather_description": "clear", "weather_icon": "01n",
    }
    assert given(second) == {
        "original_ts": "2026-02-21T04:00:00+02:00", "forecast_date_utc": dt.date(2026, 2, 21), "forecast_hour_utc": 2,
    }


def test_weatherapi_nested_day(spark):
    payload = {
        "location": {"tz_id": "Europe/Sofia"},
        "forecast": {
            "forecastday": [
                {
                    "date": "2026-02-21",
                    "day": {
                        "maxtemp_c": 1, "mintemp_c": 0, "avgtemp_c": 0.5, "totalprecip_mm": 2,
                        "daily_chance_of_rain": 3, "maxwind_kph": 4,
                        "condition": {"code": 1000, "text": "Sunny", "icon": "//x.png"},
                    },
                    "astro": {"sunrise": "07:17 AM", "sunset": "06:02 PM"},
                }
            ]
        },
    }
    (row,) = parse(spark, "weatherapi", payload)
    assert given(row) == {
        "original_ts": "2026-02-21T00:00:00+02:00", "forecast_date_utc": dt.date(2026, 2, 20),
        "temp_max": 1.0, "temp_min": 0.0, "temp_avg": 0.5, "precipitation": 2.0, "precip_prob": 3.0,
        "wind_speed": 4.0, "weather_code": 1000, "weather_description": "Sunny", "weather_icon": "//x.png",
        "sunrise": "07:17 AM", "sunset": "06:02 PM",
    }


def test_open_meteo_is_in_utc(spark):
    payload = {
        "daily": {
            "time": ["2026-02-21"], "temperature_2m_max": [1], "temperature_2m_min": [0], "precipitation_sum": [2],
            "rain_sum": [3], "windspeed_10m_max": [4], "cloudcover_mean": [5], "weathercode": [61],
        }
    }
    (row,) = parse(spark, "open_meteo", payload)
    assert given(row) == {
        "original_ts": "2026-02-21", "forecast_date_utc": dt.date(2026, 2, 21), "temp_max": 1.0, "temp_min": 0.0,
        "precipitation": 2.0, "rain": 3.0, "wind_speed": 4.0, "clouds": 5.0, "weather_code": 61,
    }


def test_longer_source_names_and_rejects(spark):
    good = {"forecast": [{"date": "2026-02-21", "maxTemp": 1}, {"date": "soon"}]}
    records = bronze(
        spark, (" foreca_api ", good), ("nobody", good), ("foreca", None), ("foreca", " {} "), ("foreca", "{oops"),
        ("foreca", {"other": 1}), ("accuweather", {"DailyForecasts": [{"Day": {}}]}),
        ("weatherbit", {"timezone": "No/Where", "data": [{"datetime": "2026-02-21"}]}),
    )
    tagged = parsers.tag_forecasts(records)
    assert [r["api_name"] for r in parsers.accepted(tagged).collect()] == ["foreca"]
    found = sorted((r["source"], r["reason"]) for r in parsers.rejected(tagged).collect())
    assert found == [
        ("accuweather", "undated_forecast"), ("foreca", "empty_payload"), ("foreca", "empty_payload"),
        ("foreca", "malformed_json"), ("foreca", "no_forecasts"), ("foreca", "undated_forecast"),
        ("nobody", "unknown_source"), ("weatherbit", "undated_forecast"),
    ]
    metrics = {r["source"]: r.asDict() for r in parsers.parse_metrics(tagged).collect()}
    assert (metrics["foreca"]["row_count"], metrics["foreca"]["rejected_count"], metrics["foreca"]["success"]) == (
        1, 5, False,
    )


def test_zones_agree_with_python(spark):
    import zoneinfo

    from pyspark.sql import functions as F

    from tidemark.functions import clock

    names = sorted(z for z in zoneinfo.available_timezones() if "/" in z)
    zones = spark.createDataFrame([(z,) for z in [*names, "No/Where"]], "zone string")
    moment = F.lit("2020-07-21 05:30:00").cast("timestamp_ntz")
    got = {r["zone"]: r["utc"] for r in zones.select("zone", clock.zone_to_utc(moment, F.col("zone")).alias("utc")).collect()}
    assert got.pop("No/Where") is None
    local = dt.datetime(2020, 7, 21, 5, 30)
    # A zone newer than the machine's data is null, never an error.
    unknown = [z for z, utc in got.items() if utc is None]
    assert len(unknown) < 5
    wrong = [
        z for z, utc in got.items()
        if utc and local.replace(tzinfo=zoneinfo.ZoneInfo(z)).astimezone(dt.timezone.utc).replace(tzinfo=None) != utc
    ]
    assert wrong == []


def test_flatten_nested_payloads(spark):
    records = bronze(
        spark, ("a", {"x": {"y": 1, "z": {"w": "t"}}, "n": 1.5, "l": [1, 2]}), ("a", {"x": {"y": 2}, "n": 2}), ("a", {}),
    )
    flat = flatten_payloads(records, keep_payload=True)
    assert set(flat.columns) == {
        "x.y", "x.z.w", "n", "l", "source", "place_name", "ingest_date", "ingest_hour", "payload",
    }
    got = sorted((r["x.y"], r["x.z.w"], r["n"], r["l"]) for r in flat.collect())
    assert got == [(1, "t", 1.5, [1, 2]), (2, None, 2.0, None)]


def test_combine_fills_missing_columns(spark):
    left, right = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "b int")
    assert sorted(map(tuple, combine([left, right]).collect()), key=repr) == [(1, None), (None, 2)]


def test_a_provider_is_one_entry(spark):
    from pyspark.sql import functions as F

    own = parsers.Provider(
        "readings ARRAY<STRUCT<at: STRING, warm: STRING>>",
        lambda p: F.transform(p.readings, lambda r: parsers.raw_forecast(r.at, parsers.INSTANT, temp_max=r.warm)),
    )
    records = bronze(spark, ("own", {"readings": [{"at": "2026-02-21T23:00:00-03:00", "warm": "4.5"}]}), ("foreca", {"forecast": [{"date": "2026-02-21"}]}))
    got = parsers.accepted(parsers.tag_forecasts(records, {**parsers.PARSERS, "own": own})).collect()
    assert sorted((r["api_name"], r["forecast_date_utc"], r["temp_max"]) for r in got) == [
        ("foreca", dt.date(2026, 2, 21), None), ("own", dt.date(2026, 2, 22), 4.5),
    ]


def test_paths_of_free_keys_in_long_form(spark):
    from tidemark.operators.flatten import flatten_paths

    texts = ['{"a":{"b":1.5,"c":{"d":[1,{"x":2}],"e":null,"f":{}}},"k1":"t","t":true}', '{"z.y":{"w":{"v":1}}}', "{}", "[1]", "{bad", None, '"x"']
    records = spark.createDataFrame([("s", f"p{i}", None, i, t) for i, t in enumerate(texts)], "source string, place_name string, ingest_date date, ingest_hour int, payload string")
    got = [(r.ingest_hour, r.path, r.value) for r in flatten_paths(records).collect()]
    assert sorted(got, key=repr) == sorted(
        [(0, "a.b", "1.5"), (0, "a.c.d", '[1,{"x":2}]'), (0, "a.c.e", None), (0, "a.c.f", "{}"), (0, "k1", "t"), (0, "t", "true"), (1, "z.y.w.v", "1")], key=repr
    )
    shallow = {r.path: r.value for r in flatten_paths(records, depth=2).collect()}
    assert shallow["a.c"] == '{"d":[1,{"x":2}],"e":null,"f":{}}' and shallow["z.y.w"] == '{"v":1}'
