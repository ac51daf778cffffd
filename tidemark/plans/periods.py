"""Weekly, monthly, seasonal and yearly rollups with processing state."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import clock
from tidemark.operators import merge, rollups, state as st
from tidemark.operators.layout import conform
from tidemark.plans.journal import Journal
from tidemark.plans.lake import TABLES, Lake
from tidemark.schemas import MEASURES, PARTIAL, STATE_EVENT
from tidemark.session import stage, staged
from tidemark.sources import slices


@dataclass(frozen=True)
class Period:
    level: str
    grain: str
    source: str
    source_part: str
    output_part: str


PERIODS = {
    "gold_weekly": Period("gold_weekly", "week", "gold_daily", "forecast_date_utc", "week_start"),
    "gold_monthly": Period("gold_monthly", "month", "gold_daily", "forecast_date_utc", "month_start"),
    "gold_seasonal": Period("gold_seasonal", "season", "gold_monthly", "month_start", "period_start"),
    "gold_yearly": Period("gold_yearly", "year", "gold_monthly", "month_start", "year_start"),
}


def _oldest(lake: Lake, period: Period) -> dt.date | None:
    """Start of the period that holds the oldest source partition of either copy."""
    tables = [lake.read(period.source)] + ([lake.read(period.source, fallback=True)] if lake.fallback else [])
    starts = [
        table.agg(F.min(clock.grain_start(F.col(period.source_part), period.grain))).first()[0] for table in tables
    ]
    return min((start for start in starts if start is not None), default=None)


def _range(
    lake: Lake, period: Period, state: DataFrame, as_of: dt.date, start: dt.date | None
) -> tuple[dt.date | None, dt.date]:
    """First partition to reconcile and the running one, which is excluded unless it is a year."""
    last = st.last_reconciled(state, period.level).first()[0]
    if last is None:
        last = start or _oldest(lake, period)
    end = dt.date(as_of.year + 1, 1, 1) if period.grain == "year" else as_of
    return last, end


def _stamp(level: str) -> str:
    return "updated_at" if level == "gold_yearly" else "generated_at"


def _judged(work: DataFrame, sums: DataFrame, period: Period, as_of: dt.date) -> DataFrame:
    """``work`` (partition_date, retry_count) with the gate's verdict on its partial sums."""
    verdicts = rollups.gate_partials(sums, period.grain, as_of).withColumnRenamed("period_start", "partition_date")
    expected = rollups.expected_parts(period.grain, F.col("partition_date"), as_of).cast("int")
    limit = rollups.allowed_missing(period.grain, F.col("_expected"))
    return (
        work.withColumn("_expected", expected)
        .join(verdicts, "partition_date", "left")
        .where(F.col("_expected") >= (2 if period.grain == "year" else 1))
        .select(
            "partition_date",
            "retry_count",
            F.col("_expected").alias("expected_count"),
            F.coalesce("actual_count", F.lit(0)).alias("actual_count"),
            F.coalesce("missing_count", F.col("_expected")).alias("missing_count"),
            F.coalesce("required_count", F.col("_expected") - limit).alias("required_count"),
            F.coalesce("accepted", F.lit(False)).alias("accepted"),
        )
    )


def run_rollup(
    lake: Lake, level: str, as_of: dt.date, now: dt.datetime, start: dt.date | None = None
) -> DataFrame:
    """Reconcile, roll up all pending periods of a level at once, load them and record the state.

    A first run starts at the oldest source partition, or at ``start``. The source rows are read
    once: their partial sums serve the gate and the rollup, and are stored for rows that
    come later (``roll_late``). Returns the number of periods per outcome.
    """
    period = PERIODS[level]
    journal = Journal(lake, level)
    known = journal.state()
    first, end = _range(lake, period, known, as_of, start)
    if first is None:
        return lake.spark.createDataFrame([], "processing_level STRING, status STRING, partitions BIGINT")

    calendar = slices.partition_calendar(lake.spark, first, end, period.grain)

    def existing(fallback: bool) -> DataFrame:
        output = slices.date_range(lake.scan(level, fallback), period.output_part, first - dt.timedelta(days=366), end)
        return slices.existing_partitions(output, period.output_part)

    found = st.evidence(calendar, existing(False), existing(True) if lake.fallback else None)
    expected = rollups.expected_parts(period.grain, F.col("partition_date"), as_of)
    with staged(st.reconcile(level, found, expected), "reconciled") as reconciled:
        state = st.apply_state(known, reconciled, F.lit(now).cast("timestamp_ntz"))
        pending = st.pending_work(state, level).select("partition_date", "retry_count")
        if period.grain == "year":
            # A running year is rolled up again as its months end.
            pending = calendar.join(pending, "partition_date", "left").fillna(0, ["retry_count"])
        pending = stage(pending, "pending")
        bounds = pending.agg(F.min("partition_date"), F.max("partition_date")).first()
        if bounds[0] is None:
            journal.compact(now, reconciled)
            return st.run_summary(pending.limit(0).select(F.lit(level).alias("processing_level"), F.lit("").alias("status")))
        journal.record(now, reconciled, st.processing_events(pending.withColumn("expected_count", expected), level))

    # The widest period is a year; a plain date range prunes the source partitions, and the
    # pending periods themselves keep what lies between them out.
    last = bounds[1] + dt.timedelta(days=366)
    wanted = pending.select(F.col("partition_date").alias("_start"))

    def keep(table: DataFrame) -> DataFrame:
        own = clock.grain_start(F.col(period.source_part), period.grain)
        ranged = slices.date_range(table, period.source_part, bounds[0], last)
        return ranged.join(wanted, own == F.col("_start"), "left_semi")

    rows = lake.read_complete(period.source, period.source_part, keep)
    with staged(rollups.partials(rows, period.source_part, period.grain), "sums") as sums:
        judged = stage(_judged(pending, sums, period, as_of), "judged")
        refused = st.gate_events(judged.where(~F.col("accepted")), level)
        taken = judged.where("accepted")
        if taken.isEmpty():
            events = refused
        else:
            passed = taken.select(F.col("partition_date").alias("period_start"), F.lit(True).alias("accepted"))
            summary = rollups.finish(sums, period.grain, passed).withColumn(
                _stamp(level), F.lit(now).cast("timestamp_ntz")
            )
            loaded = st.load_events(taken, level, *lake.load_both(level, summary))
            events = refused.unionByName(loaded, allowMissingColumns=True)
        lake.load("gold_partials", sums.withColumn("level", F.lit(level)), stored=True)
    journal.compact(now, events)
    return st.run_summary(events)


def roll_late(
    lake: Lake, level: str, late: DataFrame, as_of: dt.date, now: dt.datetime
) -> DataFrame:
    """Add source rows that come after their period was rolled up, and roll those periods up again.

    Only the late rows and the stored partial sums of their periods are read. A row counts once: what
    the sums have already is left out. Periods that pass the gate are written anew in both copies,
    and their state becomes success. Rows of periods that no run has summed up yet are loaded and left
    to the next run. Returns the number of periods per outcome.
    """
    period = PERIODS[level]
    source = TABLES[period.source]
    start = clock.grain_start(F.col(period.source_part), period.grain)
    with staged(merge.first_per_key(conform(late, source.schema), source.keys, source.order_by), "late") as late:
        bounds = late.agg(F.min(start), F.max(start)).first()
        if bounds[0] is None:
            return st.run_summary(lake.spark.createDataFrame([], STATE_EVENT))
        store = slices.date_range(
            lake.scan("gold_partials").where(F.col("level") == level), "period_start", bounds[0], bounds[1]
        ).select(*PARTIAL.names)
        stored = store.join(late.select(start.alias("period_start")).distinct(), "period_start", "left_semi")
        new = rollups.partials(
            rollups.not_summed(late, stored, period.source_part, period.grain), period.source_part, period.grain
        )
        summed = stored.select("period_start").distinct()
        changed = stage(new.select("period_start").distinct().join(summed, "period_start", "left_semi"), "changed")
        merged = rollups.merge_partials(
            stored.drop("level").unionByName(new).join(changed, "period_start", "left_semi")
        )
        with staged(merged, "sums") as sums:
            lake.load_copies(period.source, late)
            work = changed.select(F.col("period_start").alias("partition_date"), F.lit(0).alias("retry_count"))
            judged = stage(_judged(work, sums, period, as_of), "judged")
            passed = judged.where("accepted").select(F.col("partition_date").alias("period_start"), "accepted")
            summary = rollups.finish(sums, period.grain, passed).withColumn(
                _stamp(level), F.lit(now).cast("timestamp_ntz")
            )
            lake.revise(level, summary, (*MEASURES, _stamp(level)))
            lake.load("gold_partials", sums.withColumn("level", F.lit(level)), stored=True)
    events = st.load_events(judged.where("accepted"), level, None, None)
    journal = Journal(lake, level)
    journal.compact(now, events)
    return st.run_summary(events)
