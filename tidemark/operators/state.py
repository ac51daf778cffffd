"""Processing state of partitions, as transformations of a state table.

Key: (processing_level, partition_date). Each function covers all partitions at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import clock
from tidemark.functions.numbers import completeness
from tidemark.schemas import STATE, STATE_LOG

STATE_KEY = ("processing_level", "partition_date")


@dataclass(frozen=True)
class Level:
    """Settings of a processing level; an expected count of None means the days of the month."""

    grain: str
    expected_count: int | None
    max_retries: int
    statuses: tuple[str, ...]
    error_types: tuple[str | None, ...]
    sources: tuple[str, ...] = field(default=("files",))


# Grain, expected count, retry limit, statuses and error types to retry.
_INGEST_ERRORS = ("api_timeout", "api_rate_limit", "api_error", None)
_PARSE_ERRORS = ("transformation_error", "schema_mismatch", "data_type_error", None)
_GOLD_ERRORS = ("insufficient_data", "missing_partitions", None)
_RETRY = ("pending", "failed")
_GOLD_RETRY = ("pending", "failed", "partial")

LEVELS: dict[str, Level] = {
    "bronze_openweather": Level("day", 72, 10, _RETRY, _INGEST_ERRORS),
    "bronze_tomorrow": Level("day", 72, 10, _RETRY, _INGEST_ERRORS),
    "silver": Level("day", 24, 5, _RETRY, _PARSE_ERRORS, ("table",)),
    "gold_daily": Level("day", 24, 5, _GOLD_RETRY, _GOLD_ERRORS, ("files", "table")),
    "gold_weekly": Level("week", 7, 3, _GOLD_RETRY, _GOLD_ERRORS, ("files", "table")),
    "gold_monthly": Level("month", None, 3, _GOLD_RETRY, _GOLD_ERRORS, ("files", "table")),
    "gold_seasonal": Level("season", 3, 3, _GOLD_RETRY, _GOLD_ERRORS, ("files", "table")),
    # A year is one partition; its expected count is the number of months that have ended.
    "gold_yearly": Level("year", 12, 3, _GOLD_RETRY, _GOLD_ERRORS, ("files", "table")),
}


def expected_count(level: str, partition: Column) -> Column:
    count = LEVELS[level].expected_count
    return (clock.days_in_month(partition) if count is None else F.lit(count)).cast("int")


def _event_rows(events: DataFrame) -> DataFrame:
    """Events with every event column; without ``seq`` a key may come once only."""
    present = set(events.columns)
    return events.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(0 if f.name == "seq" else None))
            .cast(f.dataType).alias(f.name)
            for f in STATE_LOG.fields
        ]
    )


def apply_state(state: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """State after ``events``, applied in the order of ``seq`` within each key.

    The last event sets status, counts and errors; an absent period name keeps the old one;
    every ``pending`` event on an existing row adds a retry; an ``abandoned`` row never changes
    again, so events after the first ``abandoned`` one of a batch do not count. Times are those the
    events were recorded at, or ``now``.
    """
    events = _event_rows(events)
    key = list(STATE_KEY)
    abandoned = F.col("status") == "abandoned"
    cut = events.where(abandoned).groupBy(*key).agg(F.min("seq").alias("_cut"))
    live = events.join(cut, key, "left").where(F.col("_cut").isNull() | (F.col("seq") <= F.col("_cut")))
    order = F.col("seq")
    fields = F.struct("status", "expected_count", "actual_count", "error_type", "error_message", "recorded_at")
    folded = live.groupBy(*key).agg(
        F.max_by(fields, order).alias("_last"),
        F.max_by("period_name", F.when(F.col("period_name").isNotNull(), order)).alias("_name"),
        F.min_by("recorded_at", order).alias("_made"),
        F.count_if(F.col("status") == "pending").cast("int").alias("_pending"),
        (F.min_by("status", order) == "pending").cast("int").alias("_first_pending"),
    )
    old = state.withColumn("_old", F.lit(True))
    joined = old.join(folded, key, "full")

    is_old = F.col("_old").isNotNull()
    frozen = is_old & F.col("status").eqNullSafe("abandoned")
    changed = F.col("_last").isNotNull() & ~frozen
    ratio = completeness(F.col("_last.actual_count"), F.col("_last.expected_count"))

    def pick(new: Column, name: str) -> Column:
        return F.when(changed, new).otherwise(F.col(name))

    values = {
        "processing_level": F.col("processing_level"),
        "partition_date": F.col("partition_date"),
        "period_name": pick(F.coalesce("_name", "period_name"), "period_name"),
        "completeness_ratio": pick(ratio, "completeness_ratio"),
        "is_acceptable": pick(ratio >= 1, "is_acceptable"),
        "retry_count": F.when(~is_old, F.col("_pending") - F.col("_first_pending"))
        .when(changed, F.col("retry_count") + F.col("_pending"))
        .otherwise(F.col("retry_count")),
        "created_at": F.when(is_old, F.col("created_at")).otherwise(F.coalesce("_made", now)),
        "updated_at": pick(F.coalesce("_last.recorded_at", now), "updated_at"),
    }
    for name in ("status", "expected_count", "actual_count", "error_type", "error_message"):
        values[name] = pick(F.col(f"_last.{name}"), name)
    return joined.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in STATE.fields])


def in_order(*steps: DataFrame, first: int = 0) -> DataFrame:
    """Events of consecutive steps as one frame, numbered by step from ``first`` on."""
    numbered = [_event_rows(step).withColumn("seq", F.lit(first + n).cast("bigint")) for n, step in enumerate(steps)]
    result = numbered[0]
    for step in numbered[1:]:
        result = result.unionByName(step)
    return result


def evidence(calendar: DataFrame, files: DataFrame | None = None, table: DataFrame | None = None) -> DataFrame:
    """Calendar partitions with ``status``: success in either source, partial is kept apart in ``found_in``.

    ``files`` and ``table`` hold the column ``partition_date``.
    """
    result = calendar
    flags = []
    for name, found in (("files", files), ("table", table)):
        if found is None:
            continue
        flags.append(f"_{name}")
        result = result.join(
            found.select("partition_date").distinct().withColumn(f"_{name}", F.lit(1)),
            "partition_date",
            "left",
        )
    count = sum((F.coalesce(F.col(flag), F.lit(0)) for flag in flags), F.lit(0))
    return result.select(
        *calendar.columns,
        F.when(count > 0, "success").otherwise("missing").alias("status"),
        F.when(count == 0, "none").when(count == len(flags), "all").otherwise("some").alias("found_in"),
    )


def reconcile(level: str, found: DataFrame, expected: Column | None = None) -> DataFrame:
    """State events for partitions with evidence: success with full count, or pending with none.

    ``found`` comes from ``evidence`` on a calendar of the level's grain.
    """
    partition = F.col("partition_date")
    count = expected_count(level, partition) if expected is None else expected.cast("int")
    done = F.col("status") == "success"
    return found.select(
        F.lit(level).alias("processing_level"),
        "partition_date",
        clock.period_label(partition, LEVELS[level].grain).alias("period_name"),
        F.when(done, "success").otherwise("pending").alias("status"),
        count.alias("expected_count"),
        F.when(done, count).otherwise(0).alias("actual_count"),
    )


def pending_work(
    state: DataFrame,
    level: str,
    statuses: Sequence[str] | None = None,
    error_types: Sequence[str | None] | None = None,
    max_retries: int | None = None,
    period_name: str | None = None,
) -> DataFrame:
    """Partitions of a level to work on, oldest first. Arguments default to the level's settings.

    A None in ``error_types`` also admits rows without an error; an empty list admits every row.
    """
    settings = LEVELS.get(level)
    statuses = settings.statuses if statuses is None else statuses
    error_types = settings.error_types if error_types is None else error_types
    max_retries = settings.max_retries if max_retries is None else max_retries
    named = [e for e in error_types if e is not None]
    condition = (
        (F.col("processing_level") == level)
        & F.col("status").isin(*statuses)
        & (F.col("retry_count") < max_retries)
    )
    error = F.col("error_type")
    if named and None in error_types:
        condition &= error.isin(*named) | error.isNull()
    elif named:
        condition &= error.isin(*named)
    elif None in error_types:
        condition &= error.isNull()
    if period_name is not None:
        condition &= F.col("period_name") == period_name
    return state.where(condition).orderBy("partition_date")


def last_reconciled(state: DataFrame, level: str, period_name: str | None = None) -> DataFrame:
    """One row with the newest partition of the level that is not abandoned, or null."""
    rows = state.where((F.col("processing_level") == level) & (F.col("status") != "abandoned"))
    if period_name is not None:
        rows = rows.where(F.col("period_name") == period_name)
    return rows.agg(F.max("partition_date").alias("last_reconciled"))


def with_retries(periods: DataFrame, state: DataFrame, level: str) -> DataFrame:
    """Add the current ``retry_count`` of each ``partition_date``; 0 where there is no state row."""
    counts = state.where(F.col("processing_level") == level).select("partition_date", "retry_count")
    return periods.join(counts, "partition_date", "left").withColumn(
        "retry_count", F.coalesce("retry_count", F.lit(0))
    )


def gate_events(periods: DataFrame, level: str, max_retries: int | None = None) -> DataFrame:
    """State events from gate verdicts.

    ``periods`` has partition_date, expected_count, actual_count, missing_count, required_count,
    accepted and retry_count. A period with too many missing partitions is pending again, or
    abandoned once the coming retry reaches the limit; one that misses few partitions but is
    still below the required count has failed.
    """
    limit = LEVELS[level].max_retries if max_retries is None else max_retries
    accepted = F.col("accepted")
    allowed = F.col("expected_count") - F.col("required_count")
    gap = F.col("missing_count") > allowed
    spent = F.col("retry_count") + 1 >= limit
    if LEVELS[level].grain == "year":
        # A running year can still complete itself.
        spent &= F.col("expected_count") == 12
    status = (
        F.when(accepted, "success")
        .when(gap & spent, "abandoned")
        .when(gap, "pending")
        .otherwise("failed")
    )
    message = F.when(
        gap, F.concat(F.lit("Missing partitions: "), F.col("missing_count").cast("string"))
    ).otherwise(
        F.concat(
            F.lit("Found "), F.col("actual_count").cast("string"),
            F.lit(" of at least "), F.col("required_count").cast("string"),
        )
    )
    return periods.select(
        F.lit(level).alias("processing_level"),
        "partition_date",
        clock.period_label(F.col("partition_date"), LEVELS[level].grain).alias("period_name"),
        status.alias("status"),
        "expected_count",
        F.when(accepted, F.col("expected_count")).otherwise(F.col("actual_count")).alias("actual_count"),
        F.when(accepted, None).when(gap, "missing_partitions").otherwise("insufficient_data").alias("error_type"),
        F.when(accepted, None).otherwise(message).alias("error_message"),
    )


def load_events(periods: DataFrame, level: str, primary: str | None, secondary: str | None) -> DataFrame:
    """State events after a load into two sinks: success if either took it, else failed.

    ``primary`` and ``secondary`` are null for a sink that took the load, else why it did not.
    Causes are kept, also when only one of the sinks failed.
    """
    ok = primary is None or secondary is None
    causes = [f"{name}: {why}" for name, why in (("primary", primary), ("fallback", secondary)) if why is not None]
    return periods.select(
        F.lit(level).alias("processing_level"),
        "partition_date",
        F.lit("success" if ok else "failed").alias("status"),
        "expected_count",
        (F.col("expected_count") if ok else F.lit(0)).alias("actual_count"),
        F.lit(None if ok else "missing_partitions").cast("string").alias("error_type"),
        F.lit("; ".join(causes) or None).cast("string").alias("error_message"),
    )


def processing_events(periods: DataFrame, level: str) -> DataFrame:
    """Mark partitions as being worked on."""
    return periods.select(
        F.lit(level).alias("processing_level"),
        "partition_date",
        F.lit("processing").alias("status"),
        "expected_count",
    )


def requeue_stale(state: DataFrame, older_than: dt.datetime) -> DataFrame:
    """Events that put rows left in ``processing`` by a stopped run back to pending."""
    stale = state.where((F.col("status") == "processing") & (F.col("updated_at") < F.lit(older_than)))
    return stale.select(
        *STATE_KEY, "period_name", F.lit("pending").alias("status"), "expected_count",
        F.lit(0).alias("actual_count"),
    )


def latest_per_level(state: DataFrame) -> DataFrame:
    """The row of each level with the newest partition.

    An aggregate rather than a window: one row per level leaves each map task.
    """
    rest = [name for name in state.columns if name != "processing_level"]
    newest = state.groupBy("processing_level").agg(
        F.max_by(F.struct(*rest), F.col("partition_date")).alias("_row")
    )
    return newest.select("processing_level", "_row.*").select(*state.columns)


def state_metrics(state: DataFrame) -> DataFrame:
    """Metrics table (metric, processing_level, label, value) of the newest row of each level."""
    latest = latest_per_level(state)
    metrics = F.array(
        F.struct(
            F.lit("completeness_ratio").alias("metric"),
            F.col("status").alias("label"),
            F.col("completeness_ratio").alias("value"),
        ),
        F.struct(
            F.lit("retry_count").alias("metric"),
            F.col("status").alias("label"),
            F.col("retry_count").cast("double").alias("value"),
        ),
        F.struct(
            F.lit("is_acceptable").alias("metric"),
            F.lit(None).cast("string").alias("label"),
            F.when(F.col("is_acceptable"), 1.0).otherwise(0.0).alias("value"),
        ),
        F.struct(
            F.lit("errors").alias("metric"),
            F.col("error_type").alias("label"),
            F.when(F.col("error_type").isNotNull(), 1.0).alias("value"),
        ),
    )
    return (
        latest.select("processing_level", F.inline(metrics))
        .where(F.col("value").isNotNull())
        .select("metric", "processing_level", "label", "value")
    )


def error_counts(state: DataFrame) -> DataFrame:
    """Rows per level and error type."""
    return (
        state.where(F.col("error_type").isNotNull())
        .groupBy("processing_level", "error_type")
        .agg(F.count("*").alias("errors"))
    )


def months_ready(state: DataFrame, level: str = "gold_monthly") -> DataFrame:
    """Successful months per year and quarter."""
    month = F.col("partition_date")
    return (
        state.where((F.col("processing_level") == level) & (F.col("status") == "success"))
        .groupBy(F.year(month).alias("year"), F.quarter(month).alias("quarter"))
        .agg(F.count("*").alias("months"))
    )


def bootstrap_start(seasonal: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row: start of the oldest stored season, else the season of the oldest stored month."""
    starts = seasonal.agg(F.min("period_start").alias("season"), F.lit(None).cast("date").alias("month"))
    starts = starts.unionByName(
        monthly.agg(F.lit(None).cast("date").alias("season"), F.min("month_start").alias("month"))
    )
    return starts.agg(
        F.coalesce(F.max("season"), clock.season_start(F.max("month"))).alias("start_date"),
        F.max("season").alias("oldest_season"),
        F.max("month").alias("oldest_month"),
    )


def run_summary(events: DataFrame) -> DataFrame:
    """Partitions per level and outcome of a run."""
    return events.groupBy("processing_level", "status").agg(F.count("*").alias("partitions"))
