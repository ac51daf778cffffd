import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import state as st
from tidemark.sources import slices

D = dt.date
NOW, LATER = dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 2)
EVENT = "processing_level string, partition_date date, seq bigint, status string, expected_count int, actual_count int, period_name string, error_type string, error_message string"


def now(moment=LATER):
    return F.lit(moment).cast("timestamp_ntz")


def state(spark, *rows):
    """(level, date, status, retries, period name, error)."""
    full = [
        (level, date, name, status, 7, 3, 0.4286, False, retries, NOW, NOW, error, None)
        for level, date, status, retries, name, error in rows
    ]
    return spark.createDataFrame(full, schemas.STATE)


def events(spark, *rows):
    return spark.createDataFrame([(l, d, s, status, 7, n, name, err, None) for l, d, s, status, n, name, err in rows], EVENT)


def apply(spark, old, *new):
    got = st.apply_state(old, events(spark, *new), now()).collect()
    return {(r["processing_level"], r["partition_date"]): r for r in got}


W, DAY = "gold_weekly", D(2026, 2, 2)


def test_first_event_inserts_without_retry(spark):
    row = apply(spark, state(spark), (W, DAY, 0, "pending", 0, "week_6_2026", None))[W, DAY]
    assert (row["status"], row["retry_count"], row["period_name"]) == ("pending", 0, "week_6_2026")
    assert (row["completeness_ratio"], row["is_acceptable"]) == (0.0, False)
    assert row["created_at"] == row["updated_at"] == LATER


def test_pending_adds_a_retry_other_states_do_not(spark):
    old = state(spark, (W, DAY, "pending", 1, "week_6_2026", None))
    row = apply(spark, old, (W, DAY, 0, "pending", 2, None, "missing_partitions"))[W, DAY]
    assert (row["retry_count"], row["period_name"], row["error_type"]) == (2, "week_6_2026", "missing_partitions")
    assert row["created_at"] == NOW and row["updated_at"] == LATER
    row = apply(spark, old, (W, DAY, 0, "processing", None, None, None))[W, DAY]
    assert (row["retry_count"], row["status"], row["completeness_ratio"], row["is_acceptable"]) == (1, "processing", None, None)
    row = apply(spark, old, (W, DAY, 0, "success", 7, None, None))[W, DAY]
    assert (row["completeness_ratio"], row["is_acceptable"]) == (1.0, True)


def test_abandoned_rows_are_frozen(spark):
    old = state(spark, (W, DAY, "abandoned", 3, "n", "missing_partitions"))
    row = apply(spark, old, (W, DAY, 0, "success", 7, "m", None))[W, DAY]
    assert (row["status"], row["period_name"], row["updated_at"]) == ("abandoned", "n", NOW)


def test_events_of_one_key_are_folded_in_order(spark):
    old = state(spark, (W, DAY, "failed", 1, "n", None))
    new = [
        (W, DAY, 3, "pending", 2, None, None), (W, DAY, 1, "pending", 1, "first", None),
        (W, DAY, 2, "processing", None, None, None), (W, DAY, 4, "success", 7, None, None),
    ]
    row = apply(spark, old, *new)[W, DAY]
    assert (row["status"], row["retry_count"], row["period_name"], row["actual_count"]) == ("success", 3, "first", 7)
    # Nothing after the first abandoned event counts; the first event of a new key adds no retry.
    new = [(W, DAY, 1, "pending", 1, None, None), (W, DAY, 2, "pending", 1, None, None), (W, DAY, 3, "abandoned", 1, None, "e"), (W, DAY, 4, "pending", 7, "late", None)]
    row = apply(spark, state(spark), *new)[W, DAY]
    assert (row["status"], row["retry_count"], row["period_name"], row["error_type"]) == ("abandoned", 1, None, "e")


def test_untouched_rows_stay(spark):
    old = state(spark, (W, DAY, "failed", 1, "n", None), ("silver", DAY, "pending", 0, None, None))
    got = apply(spark, old, (W, DAY, 0, "success", 7, None, None))
    assert got["silver", DAY]["status"] == "pending" and len(got) == 2


def test_ratio_without_expected_count(spark):
    event = events(spark, (W, DAY, 0, "success", 3, None, None)).withColumn("expected_count", F.lit(0))
    row = st.apply_state(state(spark), event, now()).first()
    assert row["completeness_ratio"] is None and row["is_acceptable"] is None


def test_pending_work_filters(spark):
    s = state(
        spark,
        (W, D(2026, 2, 16), "pending", 0, "c", None), (W, D(2026, 2, 2), "failed", 2, "a", "insufficient_data"),
        (W, D(2026, 2, 9), "failed", 3, "b", None), (W, D(2026, 2, 23), "failed", 0, "d", "transformation_error"),
        (W, D(2026, 3, 2), "success", 0, "e", None), ("silver", D(2026, 3, 2), "pending", 0, "f", None),
    )
    dates = lambda df: [r["partition_date"].day for r in df.collect()]
    assert dates(st.pending_work(s, W)) == [2, 16]
    assert dates(st.pending_work(s, W, error_types=["transformation_error"])) == [23]
    assert dates(st.pending_work(s, W, error_types=[None], max_retries=9)) == [9, 16]
    assert dates(st.pending_work(s, W, error_types=[], max_retries=9)) == [2, 9, 16, 23]
    assert dates(st.pending_work(s, W, period_name="c")) == [16]


def test_reconcile_or_joins_two_sources(spark):
    calendar = slices.partition_calendar(spark, D(2026, 2, 2), D(2026, 2, 23), "week")
    files = spark.createDataFrame([(D(2026, 2, 2),)] * 2, "partition_date date")
    table = spark.createDataFrame([(D(2026, 2, 2),), (D(2026, 2, 9),)], "partition_date date")
    found = st.evidence(calendar, files, table)
    assert {r[0].day: (r[1], r[2]) for r in found.collect()} == {2: ("success", "all"), 9: ("success", "some"), 16: ("missing", "none")}
    got = {r["partition_date"].day: r for r in st.reconcile(W, found).collect()}
    assert (got[2]["status"], got[2]["actual_count"], got[2]["period_name"]) == ("success", 7, "week_6_2026")
    assert (got[16]["status"], got[16]["actual_count"]) == ("pending", 0)
    month = st.evidence(slices.partition_calendar(spark, D(2026, 2, 1), D(2026, 3, 1), "month"), files.limit(0))
    assert st.reconcile("gold_monthly", month).first()["expected_count"] == 28


def test_last_reconciled_and_retries(spark):
    s = state(spark, (W, D(2026, 2, 2), "success", 0, "a", None), (W, D(2026, 2, 9), "failed", 2, "b", None), (W, D(2026, 2, 16), "abandoned", 3, "c", None))
    assert st.last_reconciled(s, W).first()[0] == D(2026, 2, 9)
    assert st.last_reconciled(s, W, "a").first()[0] == D(2026, 2, 2)
    assert st.last_reconciled(s, "silver").first()[0] is None
    periods = spark.createDataFrame([(D(2026, 2, 9),), (D(2026, 3, 2),)], "partition_date date")
    assert {r[0].month: r[1] for r in st.with_retries(periods, s, W).collect()} == {2: 2, 3: 0}


@pytest.mark.parametrize(
    "accepted, missing, retries, level, expected, status, error",
    [
        (True, 2, 0, W, 7, "success", None), (False, 4, 0, W, 7, "pending", "missing_partitions"),
        (False, 4, 1, W, 7, "pending", "missing_partitions"), (False, 4, 2, W, 7, "abandoned", "missing_partitions"),
        (False, 3, 0, W, 7, "failed", "insufficient_data"),
        (False, 5, 2, "gold_yearly", 12, "abandoned", "missing_partitions"),
        (False, 5, 2, "gold_yearly", 8, "pending", "missing_partitions"),
    ],
)
def test_gate_events(spark, accepted, missing, retries, level, expected, status, error):
    ddl = "partition_date date, expected_count int, actual_count int, missing_count int, required_count int, accepted boolean, retry_count int"
    allowed = 3 if level == W else 4
    periods = spark.createDataFrame([(D(2026, 1, 5), expected, expected - missing, missing, expected - allowed, accepted, retries)], ddl)
    row = st.gate_events(periods, level).first()
    assert (row["status"], row["error_type"]) == (status, error)
    assert row["actual_count"] == (expected if accepted else expected - missing)


def test_load_events_need_one_sink(spark):
    p = spark.createDataFrame([(DAY, 7)], "partition_date date, expected_count int")
    assert st.load_events(p, W, "gone", None).first()["status"] == "success"
    row = st.load_events(p, W, "gone", "full").first()
    assert (row["status"], row["actual_count"], row["error_type"]) == ("failed", 0, "missing_partitions")


def test_metrics_of_the_newest_row(spark):
    s = state(
        spark, (W, D(2026, 2, 2), "success", 0, "a", None), (W, D(2026, 2, 9), "failed", 2, "b", "insufficient_data"),
        ("silver", D(2026, 2, 9), "pending", 1, None, None),
    )
    got = {(r["metric"], r["processing_level"]): (r["label"], r["value"]) for r in st.state_metrics(s).collect()}
    assert got == {
        ("completeness_ratio", W): ("failed", 0.4286), ("retry_count", W): ("failed", 2.0), ("is_acceptable", W): (None, 0.0),
        ("errors", W): ("insufficient_data", 1.0), ("completeness_ratio", "silver"): ("pending", 0.4286),
        ("retry_count", "silver"): ("pending", 1.0), ("is_acceptable", "silver"): (None, 0.0),
    }
    assert [tuple(r) for r in st.error_counts(s).collect()] == [(W, "insufficient_data", 1)]


def test_bootstrap_prefers_the_oldest_season(spark):
    seasons = spark.createDataFrame([(D(2025, 3, 1),), (D(2024, 9, 1),)], "period_start date")
    months = spark.createDataFrame([(D(2026, 2, 1),)], "month_start date")
    assert st.bootstrap_start(seasons, months).first()["start_date"] == D(2024, 9, 1)
    assert st.bootstrap_start(seasons.limit(0), months).first()["start_date"] == D(2025, 12, 1)
    assert st.bootstrap_start(seasons.limit(0), months.limit(0)).first()["start_date"] is None


def test_requeue_and_quarters(spark):
    s = state(spark, (W, DAY, "processing", 0, "a", None), ("gold_monthly", D(2026, 1, 1), "success", 0, None, None), ("gold_monthly", D(2026, 2, 1), "success", 0, None, None))
    assert [r["status"] for r in st.requeue_stale(s, LATER).collect()] == ["pending"]
    assert st.requeue_stale(s, NOW).count() == 0
    assert [tuple(r) for r in st.months_ready(s).collect()] == [(2026, 1, 2)]
