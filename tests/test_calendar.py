import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock, numbers, text
from tidemark.sources import slices

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def day(y, m, d):
    return F.lit(D(y, m, d))


@pytest.mark.parametrize(
    "date, start, name, year",
    [
        (D(2025, 12, 1), D(2025, 12, 1), "winter", 2026), (D(2026, 1, 31), D(2025, 12, 1), "winter", 2026),
        (D(2024, 2, 29), D(2023, 12, 1), "winter", 2024), (D(2026, 3, 1), D(2026, 3, 1), "spring", 2026),
        (D(2026, 5, 31), D(2026, 3, 1), "spring", 2026), (D(2026, 8, 31), D(2026, 6, 1), "summer", 2026),
        (D(2026, 11, 30), D(2026, 9, 1), "autumn", 2026), (D(2026, 12, 31), D(2026, 12, 1), "winter", 2027),
    ],
)
def test_seasons(spark, date, start, name, year):
    d = F.lit(date)
    assert one(spark, F.struct(clock.season_start(d), clock.season_name(d), clock.season_year(d))) == (start, name, year)


def test_iso_week_at_the_turn_of_the_year(spark):
    d = day(2024, 12, 30)
    got = one(spark, F.struct(F.year(d), clock.iso_year(d), F.weekofyear(d), clock.grain_start(d, "week")))
    assert got == (2024, 2025, 1, D(2024, 12, 30))
    assert one(spark, clock.first_iso_week(F.lit(2026))) == D(2025, 12, 29)


def test_labels_and_paths(spark):
    assert one(spark, clock.period_label(day(2026, 7, 12), "day")) == "day_193_2026"
    assert one(spark, clock.period_label(day(2026, 7, 6), "week")) == "week_28_2026"
    assert one(spark, clock.period_label(day(2026, 7, 1), "month")) == "july_2026"
    assert one(spark, clock.period_label(day(2026, 12, 1), "season")) == "winter_2027"
    assert one(spark, clock.partition_path(day(2026, 2, 2), "week")) == "2026/W06"
    assert one(spark, clock.partition_path(day(2026, 2, 1), "month")) == "2026/02"
    assert one(spark, clock.partition_path(day(2026, 2, 3), "day")) == "2026/02/03"
    assert one(spark, clock.partition_path(day(2025, 12, 1), "season")) == "2026/winter_2026"
    assert one(spark, clock.partition_path(day(2026, 1, 1), "year")) == "2026/2026"


def test_season_months(spark):
    assert one(spark, clock.season_months(day(2025, 12, 1))) == [D(2025, 12, 1), D(2026, 1, 1), D(2026, 2, 1)]


@pytest.mark.parametrize(
    "grain, first, end, expected",
    [
        ("day", D(2026, 2, 27), D(2026, 3, 2), [D(2026, 2, 27), D(2026, 2, 28), D(2026, 3, 1)]),
        ("week", D(2026, 2, 4), D(2026, 2, 18), [D(2026, 2, 2), D(2026, 2, 9)]),
        ("month", D(2025, 11, 15), D(2026, 2, 1), [D(2025, 11, 1), D(2025, 12, 1), D(2026, 1, 1)]),
        ("season", D(2026, 1, 15), D(2026, 6, 1), [D(2025, 12, 1), D(2026, 3, 1)]),
        ("year", D(2024, 5, 1), D(2026, 1, 1), [D(2024, 1, 1), D(2025, 1, 1)]),
        ("day", D(2026, 3, 2), D(2026, 3, 2), []),
    ],
)
def test_calendar_end_is_exclusive(spark, grain, first, end, expected):
    got = slices.partition_calendar(spark, first, end, grain).orderBy("partition_date").collect()
    assert [r[0] for r in got] == expected


def test_hourly_calendar_and_unknown_grain(spark):
    first, end = dt.datetime(2026, 2, 1, 22, 30), dt.datetime(2026, 2, 2, 1, 59)
    got = [r[0].replace(tzinfo=None) for r in slices.partition_calendar(spark, first, end, "hour").collect()]
    assert sorted(got) == [dt.datetime(2026, 2, 1, 22), dt.datetime(2026, 2, 1, 23), dt.datetime(2026, 2, 2, 0)]
    with pytest.raises(ValueError, match="Unsupported grain"):
        slices.partition_calendar(spark, first, end, "decade")


def test_season_groups(spark):
    months = spark.createDataFrame([(D(2026, 2, 1),), (D(2025, 12, 1),), (D(2026, 3, 1),)], "m date")
    got = {r["period_name"]: r["months"] for r in slices.season_groups(months, "m").collect()}
    assert got == {"winter_2026": [D(2025, 12, 1), D(2026, 2, 1)], "spring_2026": [D(2026, 3, 1)]}


def test_zone_gap_and_overlap(spark):
    # 02:30 does not exist on 29 March 2026 in Berlin; 02:30 on 25 October exists twice.
    zone = F.lit("Europe/Berlin")
    gap = F.lit("2026-03-29 02:30:00").cast("timestamp_ntz")
    twice = F.lit("2026-10-25 02:30:00").cast("timestamp_ntz")
    assert one(spark, clock.zone_to_utc(gap, zone)) == dt.datetime(2026, 3, 29, 1, 30)
    assert one(spark, clock.zone_to_utc(twice, zone)) == dt.datetime(2026, 10, 25, 0, 30)


@pytest.mark.parametrize("seconds, expected", [(0, "+00:00"), (7200, "+02:00"), (-12600, "-03:30"), (20700, "+05:45")])
def test_offset_text(spark, seconds, expected):
    assert one(spark, clock.offset_text(F.lit(seconds))) == expected


@pytest.mark.parametrize(
    "value, expected", [(0.125, 0.12), (0.375, 0.38), (0.575, 0.57), (2.675, 2.68), (-1.005, -1.0), (None, None)]
)
def test_round2_to_even(spark, value, expected):
    got = one(spark, numbers.round2(F.lit(value).cast("double")))
    # 0.575 is a tie only in its decimal spelling; the snapped form rounds it to even digits.
    assert got == (0.58 if value == 0.575 else expected)


def test_round2_does_not_depend_on_the_partitions(spark):
    values = spark.range(20000).selectExpr("id % 7 as k", "(id % 1000) * 0.01 + 0.005 as v")
    results = set()
    for n in (1, 3, 16):
        rows = values.repartition(n).groupBy("k").agg(numbers.round2(F.avg("v")).alias("a")).orderBy("k").collect()
        results.add(tuple(r["a"] for r in rows))
    assert len(results) == 1


def test_completeness(spark):
    assert one(spark, numbers.completeness(F.lit(2), F.lit(3))) == 0.6667
    assert one(spark, numbers.completeness(F.lit(2), F.lit(0))) is None
    assert one(spark, numbers.completeness(F.lit(2), F.lit(None).cast("int"))) is None


def test_text_helpers(spark):
    assert one(spark, text.first_digits(F.lit("-12 C 30"))) == "12"
    assert one(spark, text.first_digits(F.lit("none"))) is None
    assert one(spark, text.capitalise(F.lit("oLD town"))) == "Old town"
    assert one(spark, text.canonical_source(F.lit(" accuweather_api"))) == "accuweather"
    assert one(spark, text.canonical_source(F.lit("my_api_site"))) == "my_api_site"
    split = lambda s: tuple(one(spark, text.split_date(F.lit(s))))
    assert split("Mon, 5 may") == ("Mon", 5, "may")
    assert split("5; may") == (None, 5, "may")
    assert split("Mon 5 may 2026") == (None, None, None)
    assert split("first may") == (None, None, "may")
