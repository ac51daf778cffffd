"""Minimum, maximum and mean rollups with completeness gates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import clock
from tidemark.functions.numbers import round2
from tidemark.schemas import METRICS, PARTIAL

# Raw columns a metric's minimum, maximum and mean come from, where they differ from its name.
RAW_COLUMNS = {
    "temp": {"min": "temp_min", "max": "temp_max", "avg": "temp_avg"},
    "cloud_cover": {"min": "clouds", "max": "clouds", "avg": "clouds"},
}

STATISTICS = {"min": F.min, "max": F.max, "avg": F.avg}

# Largest share of missing days in an accepted month, fewest days of an accepted
# week, months of a season.
MONTH_MISSING_RATIO = 0.15
WEEK_MIN_DAYS = 4
SEASON_MONTHS = 3

LEVELS = ("week", "month", "season", "year")


def measures(from_raw: bool, rounded: bool) -> list[Column]:
    result = []
    for metric in METRICS:
        for stat, function in STATISTICS.items():
            name = f"{metric}_{stat}"
            source = RAW_COLUMNS.get(metric, {}).get(stat, metric) if from_raw else name
            value = function(source)
            result.append((round2(value) if rounded else value).alias(name))
    return result


def with_snapshot(silver: DataFrame) -> DataFrame:
    """Add ``snapshot_ts``, the hour the row was taken, from its ingest date and hour."""
    return silver.withColumn(
        "snapshot_ts", clock.snapshot_ts(F.col("ingest_date"), F.col("ingest_hour"))
    )


def _forecast(silver: DataFrame, last_day: int, rounded: bool, generated_at: Column | None) -> DataFrame:
    if "snapshot_ts" not in silver.columns:
        silver = with_snapshot(silver)
    today = F.to_date("snapshot_ts")
    rows = silver.where(
        F.col("place_name").isNotNull()
        & F.col("forecast_date_utc").between(today, F.date_add(today, last_day))
    )
    result = rows.groupBy("snapshot_ts", "place_name", "forecast_date_utc").agg(
        F.max("ingest_date").alias("ingest_date"),
        F.max("ingest_hour").alias("ingest_hour"),
        *measures(from_raw=True, rounded=rounded),
    )
    return result if generated_at is None else result.withColumn("generated_at", generated_at)


def daily_forecast(silver: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """Forecasts for the snapshot's own day, per snapshot and place, with two decimals.

    Every pending snapshot is a group of one aggregate, so there is no loop over snapshots.
    """
    return _forecast(silver, 0, True, generated_at)


def five_day_forecast(silver: DataFrame, days: int = 5, generated_at: Column | None = None) -> DataFrame:
    """Forecasts for the snapshot's day and the ``days`` after it (six dates), not rounded."""
    return _forecast(silver, days, False, generated_at)


def daily_summary(hourly: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """Hourly gold rows of a day to one row per place: max of maxima, min of minima, mean of means."""
    result = (
        hourly.where(F.col("place_name").isNotNull())
        .groupBy(F.to_date("snapshot_ts").alias("day"), "place_name")
        .agg(
            F.min("forecast_date_utc").alias("forecast_date_utc"),
            F.max("ingest_date").alias("ingest_date"),
            F.max("ingest_hour").alias("ingest_hour"),
            *measures(from_raw=False, rounded=True),
        )
    )
    return result if generated_at is None else result.withColumn("generated_at", generated_at)


def expected_parts(level: str, start: Column, as_of: dt.date) -> Column:
    """Source partitions a complete period has: days of a week or month, months of a season or year.

    In the year of ``as_of`` only the months that have ended count.
    """
    if level == "week":
        return F.lit(7)
    if level == "month":
        return clock.days_in_month(start)
    if level == "season":
        return F.lit(SEASON_MONTHS)
    year = F.year(start)
    return F.when(year < as_of.year, 12).when(year == as_of.year, as_of.month - 1).otherwise(0)


def allowed_missing(
    level: str, expected: Column, month_ratio: float = MONTH_MISSING_RATIO, min_months: int = SEASON_MONTHS
) -> Column:
    """Most missing source partitions an accepted period may have."""
    if level == "week":
        return F.lit(7 - WEEK_MIN_DAYS)
    if level == "month":
        return F.bround(expected * F.lit(month_ratio)).cast("int")
    if level == "season":
        return F.lit(SEASON_MONTHS - min_months)
    ratio = F.least(F.floor(expected / 3), F.lit(4)) / F.nullif(expected, F.lit(0))
    return F.coalesce(F.bround(expected * ratio).cast("int"), F.lit(0))


def _part_number(level: str, part: Column) -> Column:
    """Place of a source partition within its period, at most 31."""
    if level == "week":
        return F.weekday(part)
    if level == "month":
        return F.dayofmonth(part)
    return F.month(part)


def _part_bit(level: str, part: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), _part_number(level, part))


def gate(
    parts: DataFrame,
    part: str,
    level: str,
    as_of: dt.date,
    month_ratio: float = MONTH_MISSING_RATIO,
    min_months: int = SEASON_MONTHS,
) -> DataFrame:
    """Verdict per period: expected, actual, missing and required partitions, accepted or not.

    ``parts`` is any frame with the source's date column; a partition counts if any place has
    a row in it. Partitions are counted as set bits, so each task sends one row per period.
    Periods that have not ended on ``as_of`` are left out, except the running year.
    """
    if level not in LEVELS:
        raise ValueError(f"Unsupported level: {level}")
    start = clock.grain_start(F.col(part), level)
    seen = (
        parts.where(F.col(part).isNotNull())
        .groupBy(start.alias("period_start"))
        .agg(F.bit_or(_part_bit(level, F.col(part))).alias("parts"))
    )
    return _judged(seen, level, as_of, month_ratio, min_months)


def gate_partials(
    partials: DataFrame,
    level: str,
    as_of: dt.date,
    month_ratio: float = MONTH_MISSING_RATIO,
    min_months: int = SEASON_MONTHS,
) -> DataFrame:
    """``gate`` on the source partitions that partial sums have seen."""
    seen = partials.groupBy("period_start").agg(F.bit_or("parts").alias("parts"))
    return _judged(seen, level, as_of, month_ratio, min_months)


def _judged(seen: DataFrame, level: str, as_of: dt.date, month_ratio: float, min_months: int) -> DataFrame:
    seen = seen.select("period_start", F.bit_count("parts").cast("int").alias("actual_count"))
    period = F.col("period_start")
    if level == "year":
        seen = seen.where(F.year(period) <= as_of.year)
    else:
        seen = seen.where(clock.grain_step(period, level) <= F.lit(as_of))
    expected = expected_parts(level, period, as_of).cast("int")
    counted = seen.withColumn("expected_count", expected)
    limit = allowed_missing(level, F.col("expected_count"), month_ratio, min_months)
    required = (F.col("expected_count") - limit).cast("int")
    missing = F.greatest(F.col("expected_count") - F.col("actual_count"), F.lit(0)).cast("int")
    # A year is not judged before two of its months have ended.
    judged = counted.where(F.col("expected_count") >= (2 if level == "year" else 1))
    return judged.select(
        "period_start",
        "expected_count",
        "actual_count",
        missing.alias("missing_count"),
        required.alias("required_count"),
        (F.col("actual_count") >= required).alias("accepted"),
    )


def _describe(level: str) -> list[Column]:
    start = F.col("period_start")
    if level == "week":
        return [
            F.year(start).alias("year"),
            clock.iso_year(start).cast("int").alias("iso_year"),
            F.weekofyear(start).alias("week_number"),
            start.alias("week_start"),
        ]
    if level == "month":
        return [
            F.year(start).alias("year"), F.month(start).alias("month_number"), start.alias("month_start"),
        ]
    if level == "season":
        return [
            clock.season_year(start).alias("year"), clock.season_name(start).alias("season_name"), start,
        ]
    return [F.year(start).alias("year"), start.alias("year_start"), F.lit("yearly").alias("period_type")]


def partials(source: DataFrame, part: str, level: str) -> DataFrame:
    """Per place and period: minima, maxima, exact sums and counts of the means, and a bit per source partition.

    Values are summed as decimals with nine places, so sums do not depend on the order of the rows. Partial
    sums of different rows are merged by ``merge_partials``.
    """
    start = clock.grain_start(F.col(part), level)
    sums = []
    for metric in METRICS:
        mean = F.col(f"{metric}_avg")
        sums += [
            F.min(f"{metric}_min").alias(f"{metric}_min"), F.max(f"{metric}_max").alias(f"{metric}_max"),
            F.sum(mean.cast("decimal(28,9)")).cast("decimal(38,9)").alias(f"{metric}_sum"),
            F.count(mean).alias(f"{metric}_n"),
        ]
    rows = source.where(F.col("place_name").isNotNull() & F.col(part).isNotNull())
    return rows.groupBy("place_name", start.alias("period_start")).agg(
        F.bit_or(_part_bit(level, F.col(part))).alias("parts"), *sums
    )


def merge_partials(rows: DataFrame) -> DataFrame:
    """One partial sum per place and period from those of disjoint sets of rows."""
    functions = {"min": F.min, "max": F.max, "sum": F.sum, "n": F.sum}
    kinds = {f.name: f.dataType for f in PARTIAL.fields}
    merged = [
        function(f"{metric}_{name}").cast(kinds[f"{metric}_{name}"]).alias(f"{metric}_{name}")
        for metric in METRICS
        for name, function in functions.items()
    ]
    return rows.groupBy("place_name", "period_start").agg(F.bit_or("parts").alias("parts"), *merged)


def not_summed(rows: DataFrame, stored: DataFrame, part: str, level: str) -> DataFrame:
    """Rows whose place and source partition ``stored`` partial sums do not hold yet."""
    start = clock.grain_start(F.col(part), level)
    known = stored.select(F.col("place_name").alias("_place"), F.col("period_start").alias("_start"), "parts")
    bit = F.call_function("shiftright", F.col("parts"), _part_number(level, F.col(part))).bitwiseAND(1)
    had = (F.col("place_name") == F.col("_place")) & (start == F.col("_start")) & (bit == 1)
    return rows.join(known, had, "left_anti")


def finish(sums: DataFrame, level: str, verdicts: DataFrame) -> DataFrame:
    """Rows of the accepted periods from their partial sums."""
    passed = verdicts.where("accepted").select("period_start")
    kept = sums.join(passed, "period_start", "left_semi")
    values = []
    for metric in METRICS:
        mean = F.col(f"{metric}_sum").cast("double") / F.nullif(F.col(f"{metric}_n"), F.lit(0))
        for stat, value in (("min", F.col(f"{metric}_min")), ("max", F.col(f"{metric}_max")), ("avg", mean)):
            values.append(round2(value).alias(f"{metric}_{stat}"))
    return kept.select("place_name", *_describe(level), *values)


def rollup(source: DataFrame, part: str, level: str, verdicts: DataFrame) -> DataFrame:
    """Rows of the accepted periods, per period and place: max of maxima, min of minima, mean of means.

    ``source`` holds daily rows for weeks and months, monthly rows for seasons and years.
    """
    return finish(partials(source, part, level), level, verdicts)
