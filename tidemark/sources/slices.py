"""Scans of partitioned tables: ranges, increments, fallbacks and gaps.

Every function adds plain predicates or equi-joins, so partition pruning and Parquet filters apply.
Tables with a folder per month (``Lake.scan``) are pruned by whole folders as well.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import clock
from tidemark.operators.layout import within_months


def hour_slice(table: DataFrame, date: dt.date, hour: int) -> DataFrame:
    """Rows of one hourly snapshot."""
    table = within_months(table, "ingest_date", date, date)
    return table.where((F.col("ingest_date") == F.lit(date)) & (F.col("ingest_hour") == hour))


def since_hour(table: DataFrame, date: dt.date, hour: int) -> DataFrame:
    """Rows of a date from an hour on, newest first."""
    table = within_months(table, "ingest_date", date, date)
    rows = table.where((F.col("ingest_date") == F.lit(date)) & (F.col("ingest_hour") >= hour))
    return rows.orderBy(F.desc("ingest_date"), F.desc("ingest_hour"))


def day_slice(table: DataFrame, column: str, day: dt.date) -> DataFrame:
    return within_months(table, column, day, day).where(F.col(column) == F.lit(day))


def date_range(table: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows with ``column`` in [first, last]."""
    return within_months(table, column, first, last).where(F.col(column).between(F.lit(first), F.lit(last)))


def month_slice(monthly: DataFrame, year: int, month: int) -> DataFrame:
    return monthly.where((F.col("year") == year) & (F.col("month_number") == month))


def last_processed(watermarks: DataFrame, job: str) -> dt.datetime | None:
    """Watermark of a job, or None before its first run."""
    return watermarks.where(F.col("job_name") == job).agg(F.max("last_processed_ts")).first()[0]


def hourly_increment(
    table: DataFrame, last: dt.datetime | None, target: dt.datetime, start: dt.datetime | None = None
) -> DataFrame:
    """Snapshots after ``last`` up to the hour of ``target``.

    A first run (``last`` is null) starts at the table's oldest snapshot, or at ``start``.
    """
    final = target.replace(minute=0, second=0, microsecond=0)
    date = F.col("ingest_date")
    snapshot = clock.snapshot_ts(date, F.col("ingest_hour"))
    if last is not None:
        first = last.replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    elif start is not None:
        first = start
    else:
        table = within_months(table, "ingest_date", None, final.date())
        return table.where((date <= F.lit(final.date())) & (snapshot <= F.lit(final).cast("timestamp_ntz")))
    table = within_months(table, "ingest_date", first.date(), final.date())
    # The date range prunes row groups; the hour range is exact.
    return table.where(
        date.between(F.lit(first.date()), F.lit(final.date()))
        & snapshot.between(F.lit(first).cast("timestamp_ntz"), F.lit(final).cast("timestamp_ntz"))
    )


def daily_increment(
    table: DataFrame, column: str, last: dt.datetime | None, target: dt.date, start: dt.date | None = None
) -> DataFrame:
    """Days after the day of ``last`` up to ``target``.

    A first run (``last`` is null) starts at the table's oldest day, or at ``start``.
    """
    if last is not None:
        start = last.date() + dt.timedelta(days=1)
    if start is None:
        return within_months(table, column, None, target).where(F.col(column) <= F.lit(target))
    return date_range(table, column, start, target)


def short_days(table: DataFrame, column: str, expected_rows: int = 24) -> DataFrame:
    """Days with fewer rows than expected, and how many are missing."""
    counts = table.groupBy(F.col(column).alias("day")).agg(F.count("*").alias("row_count"))
    return counts.where(F.col("row_count") < expected_rows).withColumn(
        "missing_rows", F.lit(expected_rows) - F.col("row_count")
    )


def partition_calendar(
    spark: SparkSession, first: dt.date | dt.datetime, end: dt.date | dt.datetime, grain: str
) -> DataFrame:
    """Partition starts in [first, end) at a grain; both ends are truncated to the grain first."""
    clock.check_grain(grain)
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(end).alias("end"))
    return calendar_of(bounds, grain)


def calendar_of(bounds: DataFrame, grain: str) -> DataFrame:
    """The partition calendar of a frame with one row (first, end)."""
    first = clock.grain_start(F.col("first"), grain)
    end = clock.grain_start(F.col("end"), grain)
    rows = bounds.select(first.alias("first"), end.alias("end")).where(F.col("first") < F.col("end"))
    step = clock.grain_interval(grain)
    # In stretches, so that no array holds more than a thousand partitions, however far the bounds.
    long_step = " ".join(str(1000 * int(w)) if w.isdigit() else w for w in step.split())
    stretches = rows.select(F.explode(F.sequence("first", "end", F.expr(long_step))).alias("_from"), "end")
    last = F.least(F.col("end"), F.col("_from") + F.expr(long_step))
    if grain != "hour":
        last = last.cast("date")
    return stretches.select(
        F.explode(F.sequence("_from", last, F.expr(step))).alias("partition_date"), last.alias("_to")
    ).where(F.col("partition_date") < F.col("_to")).select("partition_date")


def missing_partitions(calendar: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Calendar partitions without a row in ``table``."""
    found = table.select(F.col(column).alias("partition_date")).distinct()
    return calendar.join(found, "partition_date", "left_anti")


def fallback_union(
    primary: DataFrame, secondary: DataFrame, column: str | Sequence[str], covered: DataFrame | None = None
) -> DataFrame:
    """All of ``primary``, and from ``secondary`` only the partitions ``primary`` does not have.

    ``covered`` are the partition values that count as had (none: those of ``primary``, which is
    then computed a second time). Null is a partition like any other.
    """
    columns = [column] if isinstance(column, str) else list(column)
    covered = primary.select(*columns).distinct() if covered is None else covered
    missing = secondary.alias("s").join(
        covered.alias("c"), [F.col(f"s.{name}").eqNullSafe(F.col(f"c.{name}")) for name in columns], "left_anti"
    )
    return primary.unionByName(missing, allowMissingColumns=True)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Return ``df`` if it has a row, else raise."""
    if df.isEmpty():
        raise ValueError(f"No data: {what}")
    return df


def existing_partitions(table: DataFrame, column: str) -> DataFrame:
    """Distinct partition values, as ``partition_date``. On a partition column no data column is read."""
    return table.select(F.col(column).alias("partition_date")).where(F.col(column).isNotNull()).distinct()


def season_groups(months: DataFrame, column: str) -> DataFrame:
    """Months per season: label, start, and the sorted list of at most three month starts."""
    month = F.trunc(F.col(column), "month")
    start = clock.season_start(month)
    return (
        months.select(month.alias("_month"), start.alias("period_start"))
        .distinct()
        .groupBy("period_start")
        .agg(F.sort_array(F.collect_list("_month")).alias("months"))
        .select(
            clock.period_label(F.col("period_start"), "season").alias("period_name"), "period_start", "months"
        )
    )
