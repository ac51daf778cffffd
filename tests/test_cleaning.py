import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import cleaning
from tidemark.operators.layout import blank_nat, conform

DAY = dt.date(2026, 2, 21)
BASE = {"api_name": "foreca", "place_name": "Hilltop", "ingest_date": DAY, "ingest_hour": 8, "original_ts": "x"}


def frame(spark, **values):
    row = {**BASE, "forecast_date_utc": DAY, "forecast_hour_utc": None, **values}
    kinds = {
        "ingest_date": "date", "ingest_hour": "int", "forecast_hour_utc": "string", "forecast_date_utc": "date",
    }
    ddl = ", ".join(f"{k} {kinds.get(k) or ('double' if isinstance(v, float) else 'string')}" for k, v in row.items())
    if isinstance(row["forecast_date_utc"], str):
        ddl = ddl.replace("forecast_date_utc date", "forecast_date_utc string")
    return spark.createDataFrame([tuple(row.values())], ddl)


@pytest.mark.parametrize(
    "given, cleaned",
    [
        ("71", 0.0), ("70", 70.0), ("-80", -80.0), ("-81", 0.0), ("abc", 0.0), (None, 0.0), (" 12.5 ", 12.5),
        ("1e1", 10.0), ("NaN", 0.0), ("12d", 0.0), ("0x1p3", 0.0), (70.0, 70.0), (70.01, 0.0), (float("nan"), 0.0),
    ],
)
def test_number_outside_its_range_is_zero(spark, given, cleaned):
    assert cleaning.clean_silver(frame(spark, temp_max=given), "b").first()["temp_max"] == cleaned


@pytest.mark.parametrize("given, cleaned", [(None, 0), ("13", 13), ("13.7", 13), ("x", 0)])
def test_missing_hour_is_zero(spark, given, cleaned):
    assert cleaning.clean_silver(frame(spark, forecast_hour_utc=given), "b").first()["forecast_hour_utc"] == cleaned


@pytest.mark.parametrize(
    "given, cleaned",
    [
        ("2026-02-21T07:17:00+02:00", dt.datetime(2026, 2, 21, 5, 17)),
        ("2026-02-21T05:17:00Z", dt.datetime(2026, 2, 21, 5, 17)),
        ("2026-02-21T05:17:00.250Z", dt.datetime(2026, 2, 21, 5, 17, 0, 250000)),
        ("2026-02-20 07:17", dt.datetime(2026, 2, 20, 7, 17)),
        ("07:17 AM", dt.datetime(2026, 2, 21, 7, 17)),
        ("06:02 pm", dt.datetime(2026, 2, 21, 18, 2)),
        ("07:17:30", dt.datetime(2026, 2, 21, 7, 17, 30)),
        ("dawn", None), (None, None),
    ],
)
def test_sun_times(spark, given, cleaned):
    assert cleaning.clean_silver(frame(spark, sunrise=given), "b").first()["sunrise"] == cleaned


def test_dates_texts_and_batch(spark):
    row = cleaning.clean_silver(frame(spark, forecast_date_utc="not a date", weather_icon=None), "run-7").first()
    assert row["forecast_date_utc"] is None and row["weather_icon"] is None and row["batch_id"] == "run-7"
    row = cleaning.clean_silver(frame(spark, forecast_date_utc="2026-02-21T22:00:00"), "b").first()
    assert row["forecast_date_utc"] == DAY


def test_rows_of_nulls_go_and_are_reported(spark):
    ddl = "api_name string, place_name string, forecast_date_utc date, forecast_hour_utc int"
    raw = spark.createDataFrame([("a", "p", DAY, 1), (None, None, None, None)], ddl)
    clean = cleaning.clean_silver(raw, "b")
    assert clean.count() == 1
    assert tuple(cleaning.clean_report(raw, clean).first()) == (2, 1, 1)


def test_constraints_split_rows(spark):
    good = conform(cleaning.clean_silver(frame(spark, humidity="50"), "b"), schemas.SILVER)
    bad = good.withColumn("ingest_hour", F.lit(24)).withColumn("humidity", F.lit(101.0)).withColumn(
        "place_name", F.lit(None).cast("string")
    )
    valid, rejected = cleaning.split_valid(good.unionByName(bad))
    assert valid.count() == 1 and valid.columns == schemas.SILVER.names
    assert set(rejected.first()["violations"]) == {"place_name_null", "ingest_hour_range", "humidity_range"}


def test_schema_assertion(spark):
    df = spark.createDataFrame([("a", "b", "1")], "city string, curr_time string, temperature string")
    assert cleaning.assert_schema(df, schemas.SCRAPED_IN["meteoblue"]) is df
    with pytest.raises(ValueError, match="temperature: expected bigint, found string"):
        cleaning.assert_schema(df, schemas.SCRAPED_OUT["meteoblue"])


def test_conform_and_blank_nat(spark):
    df = spark.createDataFrame([("NaT", 1)], "generated_at string, surplus int")
    row = blank_nat(conform(df, schemas._fields(place_name=schemas.STRING, generated_at=schemas.STRING))).first()
    assert row.asDict() == {"place_name": None, "generated_at": None}


def test_profile(spark):
    got = {r["summary"]: r["v"] for r in cleaning.profile(spark.createDataFrame([(1.0,), (3.0,)], "v double")).collect()}
    assert (got["count"], got["mean"], got["max"]) == ("2", "2.0", "3.0")


def test_profiles_of_days_merge_to_any_range(spark):
    from tidemark.operators import profile

    rows_ = spark.range(20000).selectExpr("id % 10 AS day", "CASE WHEN id % 13 = 0 THEN NULL WHEN id % 17 = 0 THEN double('NaN') ELSE cast(id % 997 AS double) END AS v", "'x' AS n")
    sketches = profile.day_sketches(rows_, "day", ["v"])
    assert sketches.count() == 10
    for days in (10, 3):
        exact = rows_.where(f"day < {days}").selectExpr("nullif(v, double('NaN')) AS v")
        found = profile.merged_profile(sketches.where(f"day < {days}")).first()
        n, least, most, distinct = exact.selectExpr("count(v)", "min(v)", "max(v)", "count(DISTINCT v)").first()
        assert (found.days, found["rows"], found.minimum, found.maximum) == (days, 2000 * days, least, most)
        assert found.nulls == 2000 * days - n
        assert abs(found.distinct_values - distinct) <= profile.DISTINCT_ERROR * distinct
        for q in (25, 50, 75):
            at = exact.where(f"v <= {found[f'p{q}']}").count() / n
            assert abs(at - q / 100) <= profile.RANK_ERROR
    none = profile.merged_profile(profile.day_sketches(rows_.selectExpr("day", "CAST(NULL AS double) AS v"), "day", ["v"])).first()
    assert none.p50 is None and none.nulls == 20000 and none.distinct_values == 0
