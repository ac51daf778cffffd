import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollups
from tidemark.schemas import MEASURES

D = dt.date
TODAY = D(2026, 2, 21)
SILVER_DDL = (
    "place_name string, forecast_date_utc date, forecast_hour_utc int, ingest_date date, ingest_hour int, "
    "temp_max double, temp_min double, temp_avg double, rain double, snow double, wind_speed double, "
    "clouds double, humidity double"
)


def silver(spark, *rows):
    return spark.createDataFrame([(p, d, h, TODAY, 8, *map(float, m)) for p, d, h, *m in rows], SILVER_DDL)


def test_daily_forecast_keeps_the_own_day(spark):
    df = silver(
        spark,
        ("Testville", TODAY, 10, 10, 2, 6, 0, 0, 3, 20, 50),
        ("Testville", TODAY, 11, 12, 1, 7, 1, 0, 4, 40, 60),
        ("OldPlace", TODAY - dt.timedelta(days=1), 10, 5, 0, 2, 0, 0, 2, 10, 30),
        (None, TODAY, 10, 5, 0, 2, 0, 0, 2, 10, 30),
    )
    (row,) = rollups.daily_forecast(df).collect()
    expected = {
        "place_name": "Testville", "forecast_date_utc": TODAY, "ingest_date": TODAY, "ingest_hour": 8,
        "temp_max": 12.0, "temp_min": 1.0, "temp_avg": 6.5, "rain_min": 0.0, "rain_max": 1.0, "rain_avg": 0.5,
        "snow_min": 0.0, "snow_max": 0.0, "snow_avg": 0.0, "wind_speed_min": 3.0, "wind_speed_max": 4.0,
        "wind_speed_avg": 3.5, "cloud_cover_min": 20.0, "cloud_cover_max": 40.0, "cloud_cover_avg": 30.0,
        "humidity_min": 50.0, "humidity_max": 60.0, "humidity_avg": 55.0,
    }
    got = row.asDict()
    assert got.pop("snapshot_ts").replace(tzinfo=None) == dt.datetime(2026, 2, 21, 8)
    assert got == expected


def test_five_day_window_has_six_dates(spark):
    df = silver(spark, *[("T", TODAY + dt.timedelta(days=n), 10, 10 + n, 2, 6, 0, 0, 3, 20, 50) for n in (-1, 0, 1, 2, 3, 4, 5, 6)])
    got = sorted(r["forecast_date_utc"] for r in rollups.five_day_forecast(df).collect())
    assert got == [TODAY + dt.timedelta(days=n) for n in range(6)]
    assert rollups.five_day_forecast(df, days=2).count() == 3


def test_five_day_forecast_is_not_rounded(spark):
    df = silver(spark, *[("T", TODAY, h, 10, 2, t, 0, 0, 3, 20, 50) for h, t in ((1, 1), (2, 1), (3, 2))])
    assert rollups.five_day_forecast(df).first()["temp_avg"] == pytest.approx(4 / 3, abs=1e-12)
    assert rollups.daily_forecast(df).first()["temp_avg"] == 1.33


def daily(spark, *days, places=("A", "B"), base=0.0):
    rows = []
    for i, d in enumerate(days):
        for j, p in enumerate(places):
            rows.append((p, d, *[base + i + j + k for k in range(len(MEASURES))]))
    return spark.createDataFrame(rows, "place_name string, forecast_date_utc date, " + ", ".join(f"{m} double" for m in MEASURES))


def span(first, count):
    return [first + dt.timedelta(days=n) for n in range(count)]


def verdict(spark, level, days, as_of=D(2030, 1, 1), **kw):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    return {r["period_start"]: r for r in rollups.gate(df, "d", level, as_of, **kw).collect()}


def test_week_needs_four_days(spark):
    three, four = D(2026, 2, 2), D(2026, 2, 9)
    got = verdict(spark, "week", span(three, 3) * 2 + span(four, 4))
    assert not got[three]["accepted"] and got[three]["missing_count"] == 4 and got[three]["actual_count"] == 3
    assert got[four]["accepted"] and got[four]["required_count"] == 4


@pytest.mark.parametrize("month, days, required", [(D(2026, 2, 1), 28, 24), (D(2024, 2, 1), 29, 25), (D(2026, 4, 1), 30, 26), (D(2026, 5, 1), 31, 26)])
def test_month_minimum(spark, month, days, required):
    assert verdict(spark, "month", span(month, required))[month]["accepted"]
    few = verdict(spark, "month", span(month, required - 1))[month]
    assert (few["accepted"], few["required_count"], few["expected_count"]) == (False, required, days)


def test_season_needs_three_months(spark):
    months = [D(2025, 12, 1), D(2026, 1, 1), D(2026, 2, 1), D(2026, 3, 1), D(2026, 4, 1)]
    got = verdict(spark, "season", months)
    assert got[D(2025, 12, 1)]["accepted"] and not got[D(2026, 3, 1)]["accepted"]
    assert verdict(spark, "season", months, min_months=2)[D(2026, 3, 1)]["accepted"]


@pytest.mark.parametrize(
    "as_of, present, required, accepted",
    [
        (D(2026, 4, 5), 2, 2, True), (D(2026, 4, 5), 1, 2, False), (D(2026, 7, 5), 4, 4, True),
        (D(2026, 7, 5), 3, 4, False), (D(2027, 1, 1), 8, 8, True), (D(2027, 1, 1), 7, 8, False),
    ],
)
def test_year_minimum_follows_the_completed_months(spark, as_of, present, required, accepted):
    months = [D(2026, m + 1, 1) for m in range(present)]
    row = verdict(spark, "year", months, as_of)[D(2026, 1, 1)]
    assert (row["required_count"], row["accepted"]) == (required, accepted)


def test_year_is_not_judged_in_january_and_february(spark):
    assert verdict(spark, "year", [D(2026, 1, 1)], D(2026, 2, 10)) == {}


def test_running_period_is_left_out(spark):
    days = span(D(2026, 2, 2), 10)
    assert list(verdict(spark, "week", days, D(2026, 2, 11))) == [D(2026, 2, 2)]
    assert verdict(spark, "month", span(D(2026, 2, 1), 28), D(2026, 2, 28)) == {}


def test_gate_counts_partitions_over_all_places(spark):
    monday = D(2026, 2, 2)
    df = daily(spark, *span(monday, 2), places=("A",)).unionByName(daily(spark, *span(monday, 4)[2:], places=("B",)))
    gate = rollups.gate(df, "forecast_date_utc", "week", D(2030, 1, 1))
    rows = rollups.rollup(df, "forecast_date_utc", "week", gate).collect()
    # Two days per place, four days together: both places are kept.
    assert sorted(r["place_name"] for r in rows) == ["A", "B"]


def test_rollup_takes_max_min_and_mean_of_means(spark):
    monday = D(2024, 12, 30)
    df = daily(spark, *span(monday, 5), places=("A",))
    gate = rollups.gate(df, "forecast_date_utc", "week", D(2030, 1, 1))
    (row,) = rollups.rollup(df, "forecast_date_utc", "week", gate).collect()
    assert (row["year"], row["iso_year"], row["week_number"], row["week_start"]) == (2024, 2025, 1, monday)
    # temp_min, temp_max, temp_avg start at 0, 1, 2 and grow by one a day.
    assert (row["temp_min"], row["temp_max"], row["temp_avg"]) == (0.0, 5.0, 4.0)


def test_levels_above_months(spark):
    months = [D(2025, 12, 1)] + [D(2026, m, 1) for m in range(1, 10)]
    df = daily(spark, *months, places=("A",)).withColumnRenamed("forecast_date_utc", "month_start")
    as_of = D(2027, 1, 1)
    season = rollups.rollup(df, "month_start", "season", rollups.gate(df, "month_start", "season", as_of))
    got = {(r["season_name"], r["year"]): (r["period_start"], r["temp_avg"]) for r in season.collect()}
    assert got == {
        ("winter", 2026): (D(2025, 12, 1), 3.0), ("spring", 2026): (D(2026, 3, 1), 6.0), ("summer", 2026): (D(2026, 6, 1), 9.0),
    }
    (year,) = rollups.rollup(df, "month_start", "year", rollups.gate(df, "month_start", "year", as_of)).collect()
    assert (year["year"], year["year_start"], year["period_type"], year["temp_avg"]) == (2026, D(2026, 1, 1), "yearly", 7.0)


def test_daily_summary(spark):
    hourly = daily(spark, TODAY, TODAY, TODAY, places=("A",)).withColumns(
        {
            "snapshot_ts": F.col("forecast_date_utc").cast("timestamp_ntz"), "ingest_date": F.lit(TODAY),
            "ingest_hour": F.col("temp_min").cast("int"),
        }
    )
    (row,) = rollups.daily_summary(hourly).collect()
    assert (row["day"], row["forecast_date_utc"], row["ingest_hour"]) == (TODAY, TODAY, 2)
    assert (row["temp_min"], row["temp_max"], row["temp_avg"]) == (0.0, 3.0, 3.0)


def test_min_mean_max_are_ordered(spark):
    df = silver(spark, *[("P", TODAY, h, h * 3.7, h - 20, h * 1.1, h % 5, h % 3, h, h * 4, h * 2) for h in range(24)])
    row = rollups.daily_forecast(df).first()
    for metric in ("rain", "snow", "wind_speed", "cloud_cover", "humidity"):
        assert row[f"{metric}_min"] <= row[f"{metric}_avg"] <= row[f"{metric}_max"]
