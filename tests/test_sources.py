import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.catalog.views import PROVIDER_ORDER
from tidemark.schemas import BRONZE, LOCATION
from tidemark.sources import bronze, slices

D = dt.date


def put(base, folder, hour, text):
    (base / folder).mkdir(exist_ok=True)
    (base / folder / f"{hour}.json").write_text(text)


def test_bronze_files_take_their_key_from_the_path(spark, tmp_path):
    put(tmp_path, "2026-02-21_open_meteo_Old Town", "08", '{\n "daily": {}\n}')
    put(tmp_path, "2026-02-21_foreca_Hilltop", "08", "{}")
    put(tmp_path, "2026-02-21_foreca_Hilltop", "09", "{}")
    put(tmp_path, "2026-02-22_foreca_Hilltop", "08", "{}")
    (tmp_path / "2026-02-21_foreca_Hilltop" / "notes.txt").write_text("x")
    every = bronze.read_bronze_files(spark, str(tmp_path))
    assert every.schema.names == BRONZE.names and every.count() == 4
    hour = bronze.read_bronze_files(spark, str(tmp_path), D(2026, 2, 21), 8)
    assert rows(hour.drop("payload")) == [
        ("foreca", "Hilltop", D(2026, 2, 21), 8), ("open_meteo", "Old Town", D(2026, 2, 21), 8),
    ]
    assert hour.where("source = 'open_meteo'").first()["payload"] == '{\n "daily": {}\n}'


def test_grid_finds_missing_pairs(spark):
    places = spark.createDataFrame([("A", 1.0, 2.0, "XX", "Country"), ("B", 1.0, 2.0, "XX", "Country")], LOCATION)
    grid = bronze.provider_grid(places, PROVIDER_ORDER)
    assert grid.count() == 16
    present = grid.where("not (source = 'foreca' and place_name = 'B')").withColumns(
        {"ingest_date": F.lit(D(2026, 2, 21)), "ingest_hour": F.lit(8)}
    )
    hour = F.lit(dt.datetime(2026, 2, 21, 8)).cast("timestamp_ntz")
    stamp = dt.datetime(2026, 2, 21, 8)
    assert rows(bronze.missing_pairs(present, grid, hour, hour)) == [("foreca", "B", stamp, stamp, 1)]


def snapshots(spark, *hours):
    return spark.createDataFrame([(D(2026, 2, d), h) for d, h in hours], "ingest_date date, ingest_hour int")


def test_hourly_increment_is_open_at_the_start(spark):
    df = snapshots(spark, (20, 22), (20, 23), (21, 0), (21, 5), (21, 6), (21, 7))
    got = slices.hourly_increment(df, dt.datetime(2026, 2, 20, 22, 30), dt.datetime(2026, 2, 21, 6, 59))
    assert rows(got) == [(D(2026, 2, 20), 23), (D(2026, 2, 21), 0), (D(2026, 2, 21), 5), (D(2026, 2, 21), 6)]
    first = slices.hourly_increment(df, None, dt.datetime(2026, 2, 21, 23, 10))
    assert rows(first) == rows(df)
    late = slices.hourly_increment(df, None, dt.datetime(2026, 2, 21, 23, 10), start=dt.datetime(2026, 2, 21))
    assert rows(late) == [(D(2026, 2, 21), h) for h in (0, 5, 6, 7)]
    assert slices.hourly_increment(df, dt.datetime(2026, 2, 21, 6), dt.datetime(2026, 2, 21, 6)).count() == 0


def test_daily_increment_starts_at_the_oldest_day_at_first(spark):
    df = spark.createDataFrame([(D(2026, 2, d),) for d in range(10, 25)], "d date")
    days = lambda df: sorted(r["d"].day for r in df.collect())
    assert days(slices.daily_increment(df, "d", None, D(2026, 2, 13))) == [10, 11, 12, 13]
    assert days(slices.daily_increment(df, "d", None, D(2026, 2, 18), start=D(2026, 2, 16))) == [16, 17, 18]
    assert days(slices.daily_increment(df, "d", dt.datetime(2026, 2, 20, 5), D(2026, 2, 22))) == [21, 22]
    assert days(slices.daily_increment(df, "d", dt.datetime(2026, 2, 22), D(2026, 2, 22))) == []


def test_fallback_takes_missing_partitions_only(spark):
    primary = spark.createDataFrame([(D(2026, 2, 1), "p1"), (D(2026, 2, 1), "p2")], "d date, v string")
    secondary = spark.createDataFrame([("s1", D(2026, 2, 1)), ("s2", D(2026, 2, 2))], "v string, d date")
    assert rows(slices.fallback_union(primary, secondary, "d")) == [
        (D(2026, 2, 1), "p1"), (D(2026, 2, 1), "p2"), (D(2026, 2, 2), "s2"),
    ]


def test_slices_and_gaps(spark):
    df = snapshots(spark, (20, 22), (21, 7), (21, 9), (21, 9))
    assert slices.hour_slice(df, D(2026, 2, 21), 9).count() == 2
    assert [r["ingest_hour"] for r in slices.since_hour(df, D(2026, 2, 21), 7).collect()] == [9, 9, 7]
    assert rows(slices.short_days(df, "ingest_date", 3)) == [(D(2026, 2, 20), 1, 2)]
    calendar = slices.partition_calendar(spark, D(2026, 2, 19), D(2026, 2, 23), "day")
    assert rows(slices.missing_partitions(calendar, df, "ingest_date")) == [(D(2026, 2, 19),), (D(2026, 2, 22),)]
    months = spark.createDataFrame([(2026, 1), (2026, 2)], "year int, month_number int")
    assert rows(slices.month_slice(months, 2026, 2)) == [(2026, 2)]
    assert rows(slices.day_slice(df, "ingest_date", D(2026, 2, 20))) == [(D(2026, 2, 20), 22)]


def test_empty_scan_can_be_an_error(spark):
    df = snapshots(spark, (20, 22))
    assert slices.require_rows(df, "silver") is df
    with pytest.raises(ValueError, match="No data: silver"):
        slices.require_rows(df.limit(0), "silver")


def test_last_processed(spark):
    from tidemark.schemas import WATERMARK

    marks = spark.createDataFrame([("a", dt.datetime(2026, 1, 1), None)], WATERMARK)
    assert slices.last_processed(marks, "a") == dt.datetime(2026, 1, 1)
    assert slices.last_processed(marks, "b") is None
