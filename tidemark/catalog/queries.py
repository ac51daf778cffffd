"""Named queries over the given tables: one per operator."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.catalog import views
from tidemark.catalog.views import AS_OF, NOW
from tidemark.functions import clock
from tidemark.functions.text import split_date
from tidemark.operators import merge, parsers, profile, rollups, scrape, state as st
from tidemark.operators.cleaning import check_constraints, clean_report, clean_silver
from tidemark.operators.flatten import combine, flatten_paths as long_paths, flatten_payloads
from tidemark.operators.layout import blank_nat, conform
from tidemark.plans import hourly, periods
from tidemark.plans.lake import TABLES, Lake
from tidemark.session import stage, staged, work_folder
from tidemark.sources import bronze as bronze_source, slices
from tidemark.streaming.daily import start_daily_summary
from tidemark.streaming.ingest import start_silver_ingest
from tidemark.streaming.late import start_late_split

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A first day of the second half of the events' month.
MIDDLE = dt.date(2024, 1, 16)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_silver(views.observations(spark, sf_dir), "batch-1")


# ---------------------------------------------------------------- cleaning


@query
def cleaned_silver(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def constraint_violations(spark, sf_dir):
    rows = check_constraints(views.observations(spark, sf_dir))
    return (
        rows.select(F.explode("violations").alias("violation"))
        .groupBy("violation")
        .agg(F.count("*").alias("row_count"))
    )


@query
def cleaning_report(spark, sf_dir):
    raw = views.observations(spark, sf_dir)
    day_known = clean_silver(raw, "batch-1").where(F.col("sunrise").isNotNull())
    return clean_report(raw, day_known)


@query
def silver_load_rows(spark, sf_dir):
    """Silver rows to insert: all rows against a table that holds the first half of the month."""
    silver = stage(_silver(spark, sf_dir), "silver")
    old = silver.where(F.col("ingest_date") < F.lit(MIDDLE))
    new = merge.insert_ignore(
        old, silver, schemas.SILVER_KEY, ["event_id"], nullable=("forecast_hour_utc",)
    )
    return new.select(*schemas.SILVER_KEY, "event_id", "temp_max")


# ---------------------------------------------------------------- forecasts and summaries


@query
def daily_forecast(spark, sf_dir):
    return rollups.daily_forecast(_silver(spark, sf_dir))


@query
def five_day_forecast(spark, sf_dir):
    rows = rollups.five_day_forecast(_silver(spark, sf_dir))
    # The operator does not round; the last bits of a mean differ between engines.
    return rows.select(
        *[
            F.round(name, 6).alias(name) if name in schemas.MEASURES else F.col(name)
            for name in rows.columns
        ]
    )


@query
def daily_summary(spark, sf_dir):
    return rollups.daily_summary(rollups.daily_forecast(_silver(spark, sf_dir)))


# ---------------------------------------------------------------- period rollups


def _month_gate(spark, sf_dir):
    return rollups.gate(views.gold_days(spark, sf_dir), "day", "month", AS_OF)


def _monthly(spark, sf_dir, gate=None):
    gate = _month_gate(spark, sf_dir) if gate is None else gate
    return rollups.rollup(views.daily_gold(spark, sf_dir), "forecast_date_utc", "month", gate)


def _higher_gate(month_gate, level):
    # Months that have rows are the months their own gate accepted.
    months = month_gate.where("accepted").select(F.col("period_start").alias("month_start"))
    return rollups.gate(months, "month_start", level, AS_OF)


def _above_months(spark, sf_dir, level):
    # Verdicts used twice are written once: a row per month instead of another scan.
    months = stage(_month_gate(spark, sf_dir), "months")
    return rollups.rollup(_monthly(spark, sf_dir, months), "month_start", level, _higher_gate(months, level))


@query
def weekly_rollup(spark, sf_dir):
    verdicts = rollups.gate(views.gold_days(spark, sf_dir), "day", "week", AS_OF)
    return rollups.rollup(views.daily_gold(spark, sf_dir), "forecast_date_utc", "week", verdicts)


@query
def monthly_rollup(spark, sf_dir):
    return _monthly(spark, sf_dir)


@query
def seasonal_rollup(spark, sf_dir):
    return _above_months(spark, sf_dir, "season")


@query
def yearly_rollup(spark, sf_dir):
    return _above_months(spark, sf_dir, "year")


@query
def gate_verdicts(spark, sf_dir):
    """Verdicts of all levels from one scan of the rows' dates."""
    days = stage(views.gold_days(spark, sf_dir).distinct(), "days")
    months = rollups.gate(days, "day", "month", AS_OF)
    frames = {
        "week": rollups.gate(days, "day", "week", AS_OF),
        "month": months,
        "season": _higher_gate(months, "season"),
        "year": _higher_gate(months, "year"),
    }
    return combine([frame.withColumn("level", F.lit(level)) for level, frame in frames.items()])


@query
def gate_decisions(spark, sf_dir):
    """State events of the gates of all levels, with retry counts from the state table."""
    days = stage(views.gold_days(spark, sf_dir).distinct(), "days")
    months = rollups.gate(days, "day", "month", AS_OF)
    verdicts = {
        "gold_weekly": rollups.gate(days, "day", "week", AS_OF),
        "gold_monthly": months,
        "gold_seasonal": _higher_gate(months, "season"),
        "gold_yearly": _higher_gate(months, "year"),
    }
    state = views.processing_state(spark, sf_dir)
    return combine(
        [
            st.gate_events(st.with_retries(found.withColumnRenamed("period_start", "partition_date"), state, level), level)
            for level, found in verdicts.items()
        ]
    )


# ---------------------------------------------------------------- calendar


def _order_days(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


@query
def season_calendar(spark, sf_dir):
    day = F.col("day")
    return _order_days(spark, sf_dir).select(
        "day",
        clock.season_start(day).alias("season_start"),
        clock.season_name(day).alias("season_name"),
        clock.season_year(day).alias("season_year"),
        F.quarter(day).alias("quarter"),
    )


@query
def partition_calendar(spark, sf_dir):
    bounds = views.calendar_bounds(spark, sf_dir)
    grains = ("day", "week", "month", "season", "year")
    return combine(
        [slices.calendar_of(bounds, grain).withColumn("grain", F.lit(grain)) for grain in grains]
    )


@query
def period_labels(spark, sf_dir):
    day = F.col("day")
    columns = []
    for grain in ("day", "week", "month", "season"):
        start = clock.grain_start(day, grain)
        columns.append(clock.period_label(start, grain).alias(f"{grain}_label"))
        columns.append(clock.partition_path(start, grain).alias(f"{grain}_path"))
    return _order_days(spark, sf_dir).select("day", *columns)


@query
def iso_weeks(spark, sf_dir):
    day = F.col("day")
    return _order_days(spark, sf_dir).select(
        "day",
        F.weekofyear(day).alias("week_number"),
        clock.iso_year(day).cast("int").alias("iso_year"),
        clock.grain_start(day, "week").alias("week_start"),
        clock.first_iso_week(F.year(day)).alias("first_week"),
        clock.days_in_month(day).alias("days_in_month"),
        clock.grain_step(day, "season").alias("next_season"),
    )


@query
def season_month_groups(spark, sf_dir):
    groups = slices.season_groups(_order_days(spark, sf_dir), "day")
    return groups.select(
        "period_name",
        "period_start",
        F.array_join(F.transform("months", lambda m: m.cast("string")), ",").alias("months"),
        F.array_join(
            F.transform(clock.season_months(F.col("period_start")), lambda m: m.cast("string")), ","
        ).alias("expected_months"),
    )


# ---------------------------------------------------------------- scans


@query
def missing_partitions(spark, sf_dir):
    days = views.gold_days(spark, sf_dir)
    bounds = days.agg(F.min("day").alias("first"), F.date_add(F.max("day"), 1).alias("end"))
    return slices.missing_partitions(slices.calendar_of(bounds, "day"), days, "day")


@query
def fallback_union(spark, sf_dir):
    return slices.fallback_union(
        views.daily_gold(spark, sf_dir), views.second_daily_gold(spark, sf_dir), "forecast_date_utc"
    )


@query
def hourly_increment(spark, sf_dir):
    rows = slices.hourly_increment(
        views.observations(spark, sf_dir), dt.datetime(2024, 1, 9, 22), dt.datetime(2024, 1, 12, 5)
    )
    return rows.select("event_id", "ingest_date", "ingest_hour")


@query
def first_hourly_increment(spark, sf_dir):
    rows = slices.hourly_increment(views.observations(spark, sf_dir), None, dt.datetime(2024, 1, 12, 5))
    return rows.select("event_id", "ingest_date", "ingest_hour")


@query
def daily_increment(spark, sf_dir):
    return slices.daily_increment(
        views.daily_gold(spark, sf_dir), "forecast_date_utc", dt.datetime(1997, 5, 1, 7), dt.date(1997, 9, 15)
    )


@query
def short_days(spark, sf_dir):
    return slices.short_days(rollups.daily_forecast(_silver(spark, sf_dir)), "forecast_date_utc", 24 * 5)


@query
def snapshots_since(spark, sf_dir):
    rows = slices.since_hour(views.observations(spark, sf_dir), dt.date(2024, 1, 20), 9)
    return rows.select("event_id", "ingest_date", "ingest_hour")


@query
def bronze_hour(spark, sf_dir):
    return bronze_source.bronze_hour(views.mixed_bronze(spark, sf_dir), dt.date(2024, 1, 20), 9).select(
        "source", "place_name", "ingest_date", "ingest_hour"
    )


@query
def provider_gaps(spark, sf_dir):
    """Runs of hours without a record per provider and place, over all hours of the table."""
    records = views.observations(spark, sf_dir).withColumnRenamed("api_name", "source")
    places = records.select("place_name").distinct()
    hour = clock.snapshot_ts(F.col("ingest_date"), F.col("ingest_hour"))
    first, last = records.agg(F.min(hour), F.max(hour)).first()
    grid = bronze_source.provider_grid(places, views.EVENT_TYPES)
    return bronze_source.missing_pairs(
        records, grid, F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")
    )


@query
def hour_calendar(spark, sf_dir):
    bounds = views.table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("end"))
    return slices.calendar_of(bounds, "hour")


@query
def silver_hour(spark, sf_dir):
    return slices.hour_slice(_silver(spark, sf_dir), dt.date(2024, 1, 20), 9)


@query
def forecast_day(spark, sf_dir):
    return slices.day_slice(rollups.daily_forecast(_silver(spark, sf_dir)), "ingest_date", dt.date(2024, 1, 20))


@query
def daily_range(spark, sf_dir):
    return slices.date_range(
        views.daily_gold(spark, sf_dir), "forecast_date_utc", dt.date(1997, 5, 5), dt.date(1997, 5, 11)
    )


@query
def one_month(spark, sf_dir):
    return slices.month_slice(_monthly(spark, sf_dir), 1996, 4)


@query
def rows_per_place(spark, sf_dir):
    return _silver(spark, sf_dir).groupBy("place_name").agg(F.count("*").alias("row_count"))


# ---------------------------------------------------------------- loads


@query
def insert_ignore(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    target = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return merge.insert_ignore(target, orders, ("o_custkey", "o_orderstatus"), ["o_orderkey"])


@query
def upsert(spark, sf_dir):
    """Largest order per customer and year before 1999, updated by single orders from 1998 on."""
    orders = views.table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    first = F.to_date("o_orderdate")
    target = (
        orders.where("order_year < 1999")
        .groupBy("o_custkey", "order_year")
        .agg(F.max("o_totalprice").alias("amount"), F.min(first).alias("first_seen"))
    )
    batch = orders.where("order_year >= 1998").select(
        "o_custkey", "order_year", F.col("o_totalprice").alias("amount"), first.alias("first_seen"), "o_orderkey"
    )
    return merge.upsert(target, batch, ("o_custkey", "order_year"), ("amount",), ["o_orderkey"])


@query
def load_report(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    target = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return merge.load_report(target, orders, ("o_custkey", "o_orderstatus"), ("o_orderstatus",))


@query
def write_once_report(spark, sf_dir):
    daily, second = views.daily_gold(spark, sf_dir), views.second_daily_gold(spark, sf_dir)
    return merge.write_report(daily, second, ("forecast_date_utc",))


@query
def write_once_rows(spark, sf_dir):
    daily, second = views.daily_gold(spark, sf_dir), views.second_daily_gold(spark, sf_dir)
    return merge.new_partitions(daily, second, ("forecast_date_utc",))


@query
def conformed_forecast(spark, sf_dir):
    rows = rollups.daily_forecast(_silver(spark, sf_dir))
    return blank_nat(conform(rows.drop("humidity_avg"), schemas.GOLD_FORECAST))


def _stamped(rows, column):
    return rows.withColumn(column, F.lit(NOW).cast("timestamp_ntz"))


@query
def stored_months(spark, sf_dir):
    """Monthly table after two loads of the same rows and one of other rows with the same keys."""
    lake = Lake(spark, work_folder(spark, "stored-months"))
    monthly = stage(_stamped(_monthly(spark, sf_dir), "generated_at"), "monthly")
    for batch in (monthly, monthly, monthly.withColumn("temp_max", F.lit(-1.0))):
        lake.load("gold_monthly", batch)
    return lake.read("gold_monthly")


@query
def stored_years(spark, sf_dir):
    """Yearly table after a first load and an update of its measures."""
    lake = Lake(spark, work_folder(spark, "stored-years"))
    yearly = stage(_stamped(_above_months(spark, sf_dir, "year"), "updated_at"), "yearly")
    lake.load("gold_yearly", yearly)
    later = yearly.withColumns(
        {"temp_max": F.col("temp_max") + 1, "updated_at": F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")}
    )
    lake.load("gold_yearly", later.where("place_name <> 'A-F'"))
    return lake.read("gold_yearly")


@query
def stored_once(spark, sf_dir):
    """Monthly partitions written once: the second write adds only the partitions that were missing."""
    folder = work_folder(spark, "stored-once")
    keys = ("year", "month_number")
    monthly = stage(_stamped(_monthly(spark, sf_dir), "generated_at"), "monthly")
    merge.write_once(monthly.where("year < 1996"), folder, schemas.GOLD_MONTHLY, keys)
    merge.write_once(monthly.withColumn("snow_min", F.lit(0.0)), folder, schemas.GOLD_MONTHLY, keys)
    return merge.read_table(spark, folder, schemas.GOLD_MONTHLY)


@query
def watermarks(spark, sf_dir):
    """Watermark per job, first set by half of the month and then moved by all of it."""
    events = views.table(spark, sf_dir, "events")

    def newest(rows, stamp):
        return rows.groupBy(F.col("event_type").alias("job_name")).agg(
            F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("last_processed_ts"),
            F.lit(stamp).cast("timestamp_ntz").alias("updated_at"),
        )

    table = TABLES["watermarks"]
    old = newest(events.where(F.to_date("ts") < F.lit(MIDDLE)), dt.datetime(2024, 1, 16))
    return merge.upsert(old, newest(events, NOW), table.keys, table.update_columns, table.order_by)


# ---------------------------------------------------------------- state


@query
def reconcile_events(spark, sf_dir):
    """Monthly partitions checked against two sources of evidence."""
    bounds = views.calendar_bounds(spark, sf_dir)
    calendar = slices.calendar_of(bounds, "month")
    months = _month_gate(spark, sf_dir).where("accepted").select(F.col("period_start").alias("partition_date"))
    ordered = views.table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("partition_date"))
    return st.reconcile("gold_monthly", st.evidence(calendar, months, ordered.distinct()))


@query
def evidence(spark, sf_dir):
    calendar = slices.calendar_of(views.calendar_bounds(spark, sf_dir), "day")
    days = views.gold_days(spark, sf_dir).select(F.col("day").alias("partition_date"))
    orders = views.table(spark, sf_dir, "orders")
    return st.evidence(calendar, days, orders.select(F.to_date("o_orderdate").alias("partition_date")))


@query
def apply_state(spark, sf_dir):
    return st.apply_state(
        views.processing_state(spark, sf_dir),
        views.state_events(spark, sf_dir),
        F.lit(NOW).cast("timestamp_ntz"),
    )


@query
def pending_work(spark, sf_dir):
    return st.pending_work(views.processing_state(spark, sf_dir), "gold_weekly").select(
        "processing_level", "partition_date", "status", "error_type", "retry_count"
    )


@query
def last_reconciled(spark, sf_dir):
    return st.last_reconciled(views.processing_state(spark, sf_dir), "gold_monthly")


@query
def retry_counts(spark, sf_dir):
    calendar = slices.calendar_of(views.calendar_bounds(spark, sf_dir), "day")
    return st.with_retries(calendar, views.processing_state(spark, sf_dir), "gold_daily")


@query
def state_metrics(spark, sf_dir):
    return st.state_metrics(views.processing_state(spark, sf_dir))


@query
def error_counts(spark, sf_dir):
    return st.error_counts(views.processing_state(spark, sf_dir))


@query
def latest_state(spark, sf_dir):
    return st.latest_per_level(views.processing_state(spark, sf_dir)).select(
        "processing_level", "partition_date", "status", "completeness_ratio", "retry_count",
        "error_type", "is_acceptable",
    )


@query
def months_ready(spark, sf_dir):
    return st.months_ready(views.processing_state(spark, sf_dir))


@query
def bootstrap_start(spark, sf_dir):
    months = stage(_month_gate(spark, sf_dir), "months")
    monthly = stage(_monthly(spark, sf_dir, months), "monthly")
    seasonal = rollups.rollup(monthly, "month_start", "season", _higher_gate(months, "season"))
    return st.bootstrap_start(seasonal, monthly)


@query
def requeued_rows(spark, sf_dir):
    return st.requeue_stale(views.processing_state(spark, sf_dir), dt.datetime(2001, 1, 1))


@query
def outcome_counts(spark, sf_dir):
    return st.run_summary(views.processing_state(spark, sf_dir))


# ---------------------------------------------------------------- parsers


def _parse_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parsers.parse_provider(views.provider_bronze(spark, sf_dir, name), name)

    return run


for _name in views.PROVIDER_ORDER:
    QUERIES[f"parse_{_name}"] = _parse_query(_name)


@query
def parse_mixed(spark, sf_dir):
    return parsers.parse_bronze(views.mixed_bronze(spark, sf_dir))


@query
def parse_rejects(spark, sf_dir):
    return parsers.rejected(parsers.tag_forecasts(views.mixed_bronze(spark, sf_dir)))


@query
def parse_metrics(spark, sf_dir):
    return parsers.parse_metrics(parsers.tag_forecasts(views.mixed_bronze(spark, sf_dir)))


@query
def clean_parsed(spark, sf_dir):
    return clean_silver(parsers.parse_bronze(views.mixed_bronze(spark, sf_dir)), "batch-1")


@query
def added_provider(spark, sf_dir):
    """Forecasts of a provider that is added at run time, next to those known before."""
    readings = parsers.Provider(
        "day STRING, readings ARRAY<STRUCT<high: STRING, low: STRING>>",
        lambda p: F.transform(
            p.readings, lambda r: parsers.raw_forecast(p.day, parsers.ZONE, zone=F.lit("UTC"), temp_max=r.high, temp_min=r.low)
        ),
    )
    known = views.mixed_bronze(spark, sf_dir)
    own = views.readings(spark, sf_dir)
    tagged = parsers.tag_forecasts(known.unionByName(own), {**parsers.PARSERS, "own_station": readings})
    rows = parsers.accepted(tagged).groupBy("api_name", "ingest_date").agg(
        F.count("*").alias("forecasts"), F.max("temp_max").alias("temp_max"), F.min("temp_min").alias("temp_min")
    )
    return rows.withColumns({"temp_max": F.col("temp_max").cast("double"), "temp_min": F.col("temp_min").cast("double")})


@query
def canonical_sources(spark, sf_dir):
    records = parsers.to_records(views.mixed_bronze(spark, sf_dir))
    return records.groupBy("source").agg(F.count("*").alias("records"))


@query
def flatten_json(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    body = F.struct(
        F.struct(F.col("user_id").alias("id"), F.struct(k.alias("rank")).alias("props")).alias("station"),
        F.col("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
    )
    records = events.select(
        F.lit("flat").alias("source"),
        F.col("event_type").alias("place_name"),
        F.to_date("ts").alias("ingest_date"),
        F.hour("ts").alias("ingest_hour"),
        F.when(F.col("event_type") == "signup", "{}").otherwise(F.to_json(body)).alias("payload"),
    )
    return flatten_payloads(records)


@query
def flatten_paths(spark, sf_dir):
    """Leaves of payloads that have keys of their own, in long form."""
    e = F.col("event_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    inner = F.to_json(F.create_map(F.concat(F.lit("k"), e), k, F.lit("user"), F.col("user_id").cast("int")))
    payload = F.concat(
        F.lit('{"kind": "'), F.col("event_type"), F.lit('", "station": {"s'), e, F.lit('": '), inner, F.lit("}, \"list\": [1, 2], \"none\": null}")
    )
    records = views.table(spark, sf_dir, "events").select(
        F.lit("free").alias("source"), e.alias("place_name"), F.to_date("ts").alias("ingest_date"), F.hour("ts").alias("ingest_hour"),
        F.when(F.col("event_type") == "signup", "{}").otherwise(payload).alias("payload"),
    )
    return long_paths(records)


@query
def profile_by_day(spark, sf_dir):
    """Profile of the silver columns from sketches per day, merged over half the month and all of it."""
    columns = ["temp_max", "wind_speed", "clouds", "humidity"]
    silver = _silver(spark, sf_dir).select("ingest_date", *columns)
    with staged(profile.day_sketches(silver, "ingest_date", columns), "sketches") as sketches:
        half = F.col("day") < F.lit(MIDDLE)
        found = combine(
            [
                profile.merged_profile(part, (0.5,)).withColumn("days_of", F.lit(name))
                for name, part in (("half", sketches.where(half)), ("all", sketches))
            ]
        )
        found = stage(found, "profiles")
    # What the sketches say is held against exact ranks and counts.
    low, high = 0.5 - profile.RANK_ERROR, 0.5 + profile.RANK_ERROR
    exact = combine(
        [
            rows.agg(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("column_name"), F.percentile(name, F.array(F.lit(low), F.lit(high))).alias("between"),
                            F.count_distinct(name).alias("n"),
                        )
                        for name in columns
                    ]
                ).alias("all")
            ).select(F.lit(label).alias("days_of"), F.inline("all"))
            for label, rows in (("half", silver.where(F.col("ingest_date") < F.lit(MIDDLE))), ("all", silver))
        ]
    )
    return found.join(exact, ["days_of", "column_name"]).select(
        "days_of", "column_name", "days", "rows", "nulls", "minimum", "maximum",
        F.col("p50").between(F.floor(F.col("between")[0]), F.ceil(F.col("between")[1])).alias("median_within"),
        (F.abs(F.col("distinct_values") - F.col("n")) <= F.ceil(F.col("n") * profile.DISTINCT_ERROR)).alias("distinct_within"),
    )


@query
def silver_rejects(spark, sf_dir):
    """Everything a silver load turns away: unreadable records, and rows that break a constraint.

    Every 24th event comes without a place and the one after it with hour 31.
    """
    e = F.col("event_id")
    events = views.table(spark, sf_dir, "events")
    faulty = views.mix_providers(
        events, place=F.when(e % 24 != 0, F.concat(F.lit("place_"), "user_id")),
        hour=F.when(e % 24 == 1, 31).otherwise(F.hour("ts")),
    )
    _, rejects = hourly.split_silver(stage(parsers.tag_forecasts(faulty), "tagged"), "batch-1")
    unread = F.when(F.col("reason").isin("empty_payload", "malformed_json", "undated_forecast", "unknown_source"), F.col("detail"))
    return rejects.select("source", "place_name", "ingest_date", "ingest_hour", "reason", unread.alias("detail"))


# ---------------------------------------------------------------- whole runs


@query
def hourly_run_silver(spark, sf_dir):
    """Both copies of the silver table, without batch numbers, after two runs over the same bronze rows."""
    folder = work_folder(spark, "run-silver")
    lake = Lake(spark, f"{folder}/main", fallback=f"{folder}/copy")
    for _ in range(2):
        hourly.build_silver(lake, views.mixed_bronze(spark, sf_dir), "batch-1")
    main, copy = lake.read("silver"), lake.read("silver", fallback=True)
    return main.withColumn("copy", F.lit("main")).union(copy.withColumn("copy", F.lit("copy"))).drop("batch_id")


def _forecast_lake(spark: SparkSession, sf_dir: str, label: str) -> Lake:
    """A lake whose silver rows have been made into forecasts, in two runs."""
    lake = Lake(spark, work_folder(spark, label))
    silver = conform(_silver(spark, sf_dir), schemas.SILVER)
    merge.append(silver, lake.path("silver"), TABLES["silver"].partition_by, TABLES["silver"].keys)
    for target in (dt.datetime(2024, 1, 16, 12), dt.datetime(2025, 1, 1)):
        hourly.build_forecasts(lake, target, NOW)
    return lake


@query
def hourly_run_forecasts(spark, sf_dir):
    """Stored daily forecasts after the run up to the middle of the month and the run after it."""
    return _forecast_lake(spark, sf_dir, "run-forecasts").read("gold_daily_forecast")


@query
def stored_five_day(spark, sf_dir):
    """Stored five-day forecasts after the run up to the middle of the month and the run after it."""
    rows = _forecast_lake(spark, sf_dir, "run-five-day").read("gold_five_day_forecast")
    # Not rounded when they are stored; the last bits of a mean differ between engines.
    return rows.withColumns({name: F.round(name, 6) for name in schemas.MEASURES})


@query
def hourly_run_daily(spark, sf_dir):
    """Stored daily summaries after two runs over the stored forecasts."""
    lake = _forecast_lake(spark, sf_dir, "run-daily")
    for _ in range(2):
        hourly.build_daily(lake, dt.date(2025, 1, 1), NOW)
    return lake.read("gold_daily")


@query
def hourly_run_watermark(spark, sf_dir):
    """Newest snapshot that the forecast job has processed, as the next run reads it."""
    lake = _forecast_lake(spark, sf_dir, "run-watermark")
    job = "gold_daily_forecast"
    last = slices.last_processed(lake.read("watermarks"), job)
    return lake.read("watermarks").where(F.col("last_processed_ts") == F.lit(last).cast("timestamp_ntz"))


def _daily_lake(spark: SparkSession, sf_dir: str, label: str, keep: Column | None = None, copy: bool = False) -> Lake:
    """Daily rows of all years, stored; with ``copy`` a second copy holds all of them and the first those to ``keep``."""
    folder = work_folder(spark, label)
    lake = Lake(spark, f"{folder}/main", fallback=f"{folder}/copy" if copy else None)
    table, daily = TABLES["gold_daily"], conform(views.daily_gold(spark, sf_dir), schemas.GOLD_DAILY)
    merge.append(daily if keep is None else daily.where(keep), lake.path("gold_daily"), table.partition_by, table.keys)
    if copy:
        merge.append(daily, lake.path("gold_daily", fallback=True), table.partition_by, table.keys)
    return lake


def _rolled_up(spark: SparkSession, sf_dir: str, label: str, *levels: str, copy: bool = False) -> Lake:
    """A lake of daily rows after whole runs of some levels; with ``copy`` the first copy lacks every other day."""
    lake = _daily_lake(spark, sf_dir, label, F.dayofmonth("forecast_date_utc") % 2 == 0 if copy else None, copy)
    for level in levels:
        periods.run_rollup(lake, level, AS_OF, NOW)
    return lake


@query
def rollup_run_weekly(spark, sf_dir):
    """Stored weeks after a whole rollup run that starts at the oldest day."""
    return _rolled_up(spark, sf_dir, "run-weekly", "gold_weekly").read("gold_weekly")


@query
def rollup_run_state(spark, sf_dir):
    """State of each week after that run."""
    state = _rolled_up(spark, sf_dir, "run-state", "gold_weekly").read("processing_state")
    return state.select("processing_level", "partition_date", "status", "expected_count")


@query
def rollup_run_monthly(spark, sf_dir):
    """Stored months after a whole run."""
    return _rolled_up(spark, sf_dir, "run-monthly", "gold_monthly").read("gold_monthly")


@query
def rollup_run_seasonal(spark, sf_dir):
    """Stored seasons after whole runs of the months and the seasons."""
    return _rolled_up(spark, sf_dir, "run-seasonal", "gold_monthly", "gold_seasonal").read("gold_seasonal")


@query
def rollup_run_yearly(spark, sf_dir):
    """Stored years of both copies after whole runs; every other day comes from the fallback copy."""
    lake = _rolled_up(spark, sf_dir, "run-yearly", "gold_monthly", "gold_yearly", copy=True)
    main, copy = lake.read("gold_yearly"), lake.read("gold_yearly", fallback=True)
    return main.withColumn("copy", F.lit("main")).union(copy.withColumn("copy", F.lit("copy")))


@query
def rollup_after_late_days(spark, sf_dir):
    """Stored weeks when some days and some places' rows arrive after the run, in two parts that overlap."""
    day = F.dayofmonth("forecast_date_utc")
    late = (day % 7 == 3) | ((F.col("place_name") == "R-F") & (day % 5 == 0))
    lake = _daily_lake(spark, sf_dir, "run-late", ~late)
    periods.run_rollup(lake, "gold_weekly", AS_OF, NOW)
    rows = stage(conform(views.daily_gold(spark, sf_dir), schemas.GOLD_DAILY).where(late), "late")
    for part in (rows.where(day > 12), rows.where(day < 24)):
        periods.roll_late(lake, "gold_weekly", part, AS_OF, NOW)
    return lake.read("gold_weekly")


@query
def stored_seasons(spark, sf_dir):
    """Seasonal table after a first load and an update of its measures in some (year, season) pairs."""
    lake = Lake(spark, work_folder(spark, "stored-seasons"))
    seasonal = stage(_stamped(_above_months(spark, sf_dir, "season"), "generated_at"), "seasonal")
    lake.load("gold_seasonal", seasonal)
    later = seasonal.where((F.col("year") + F.length("season_name")) % 2 == 0)
    lake.load("gold_seasonal", later.withColumn("temp_max", F.col("temp_max") + 1))
    return lake.read("gold_seasonal")


def _seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(_stamped(_above_months(spark, sf_dir, "season"), "generated_at"), "seasonal")


@query
def dual_sink_events(spark, sf_dir):
    """State events of the seasons after loads into two sinks of which none, either one or both can't be written."""
    seasonal = _seasons(spark, sf_dir)
    work = seasonal.select(F.col("period_start").alias("partition_date"), F.lit(3).alias("expected_count")).distinct()
    events = []
    for main, copy in ((False, False), (True, False), (False, True), (True, True)):
        folder = work_folder(spark, "dual-sink")
        for name, blocked in (("main", main), ("copy", copy)):
            if blocked:
                views.block(spark, f"{folder}/{name}")
        outcome = Lake(spark, f"{folder}/main", f"{folder}/copy").load_both("gold_seasonal", seasonal)
        events.append(
            st.load_events(work, "gold_seasonal", *outcome)
            .withColumns({"main_blocked": F.lit(main), "copy_blocked": F.lit(copy)})
        )
    message = F.coalesce("error_message", F.lit(""))
    return combine(events).select(
        "main_blocked", "copy_blocked", "processing_level", "partition_date", "status", "expected_count", "actual_count",
        "error_type", message.contains("primary: ").alias("names_main"), message.contains("fallback: ").alias("names_copy"),
    )


@query
def dual_sink_repair(spark, sf_dir):
    """The fallback copy of the seasons after a load that failed there for half of them, and its repair alone."""
    folder = work_folder(spark, "dual-repair")
    lake = Lake(spark, f"{folder}/main", f"{folder}/copy")
    seasonal = _seasons(spark, sf_dir)
    lake.load_both("gold_seasonal", seasonal.where("season_name IN ('winter', 'summer')"))
    lake.load("gold_seasonal", seasonal)
    repaired = lake.repair("gold_seasonal", fallback=True)
    left = lake.differing("gold_seasonal").count()
    rows = lake.read("gold_seasonal", fallback=True)
    return rows.withColumns({"loaded": F.lit(repaired.rows_in), "still_different": F.lit(left)})


@query
def stored_weeks(spark, sf_dir):
    """Weekly table after two loads of the same rows."""
    lake = Lake(spark, work_folder(spark, "stored-weeks"))
    weekly = stage(_stamped(weekly_rollup(spark, sf_dir), "generated_at"), "weekly")
    for batch in (weekly, weekly.withColumn("temp_max", F.lit(-1.0))):
        lake.load("gold_weekly", batch)
    return lake.read("gold_weekly")


@query
def bronze_files(spark, sf_dir):
    """Bronze rows from raw files of two halves of the month, and the number of files the second scan has read."""
    folder = work_folder(spark, "bronze-files")
    paths = (f"{folder}/raw", f"{folder}/bronze", f"{folder}/rejects", f"{folder}/registry")
    read = []
    for half in (F.to_date("ts") < F.lit(MIDDLE), F.to_date("ts") >= F.lit(MIDDLE)):
        views.write_raw_files(views.table(spark, sf_dir, "events").where(half), paths[0])
        read.append(bronze_source.ingest_new_files(spark, *paths, TABLES["bronze"]).rows_in)
    # A text file ends with a line break.
    payload = F.regexp_replace("payload", "\n$", "")
    bronze = merge.read_table(spark, paths[1], schemas.BRONZE).withColumn("payload", payload)
    return bronze.withColumn("read_by_second_scan", F.lit(read[1]).cast("long"))


@query
def bronze_uploads(spark, sf_dir):
    """What a write-once load of all hours says of each, where the first half of the month is stored; rows after it."""
    table, folder = TABLES["bronze"], work_folder(spark, "bronze-uploads")
    records = stage(_hourly_records(spark, sf_dir).dropDuplicates(list(table.keys)), "records")
    first = records.where(F.col("ingest_date") < F.lit(MIDDLE))
    merge.write_once(first, folder, table.schema, table.keys, table.partition_by, table.keys)
    report = stage(bronze_source.upload_report(merge.read_table(spark, folder, table.schema), records), "report")
    merge.write_once(records, folder, table.schema, table.keys, table.partition_by, table.keys)
    return report.withColumn("stored", F.lit(merge.read_table(spark, folder, table.schema).count()).cast("long"))


def _hourly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), F.concat(F.lit("place_"), F.col("user_id") % 5).alias("place_name"),
        F.to_date("ts").alias("ingest_date"), F.hour("ts").alias("ingest_hour"), F.col("props").alias("payload"),
    )


@query
def stored_bronze(spark, sf_dir):
    """Bronze table after two loads: of several payloads under one key the first by text is kept."""
    lake = Lake(spark, work_folder(spark, "stored-bronze"))
    for _ in range(2):
        lake.load("bronze", _hourly_records(spark, sf_dir))
    return lake.read("bronze")


# ---------------------------------------------------------------- pages


@query
def scrape_fields(spark, sf_dir):
    """Title, heading, first link and first notice of each stored page."""
    layout = {
        "title": (("title",),),
        "heading": (("article",), ("h1",)),
        "first_link": (("nav",), ("li",), ("a",)),
        "notice": (("div", "class", "ad"),),
    }
    return scrape.extract_fields(
        views.table(spark, sf_dir, "pages"), layout, keep=("page_id",)
    )


@query
def unreadable_pages(spark, sf_dir):
    """Stored pages that lack one of the declared fields."""
    layout = {"title": (("title",),), "notice": (("div", "class", "ad"),), "table": (("table",), ("tr",))}
    pages = scrape.extract_fields(views.table(spark, sf_dir, "pages"), layout, keep=("page_id",))
    declared = pages.drop("page_id").schema
    _, bad = scrape.split_readable(pages, declared)
    return bad.select("page_id", F.array_join("missing_fields", ",").alias("missing_fields"))


def _site_query(site: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = scrape.scrape_site(views.site_pages(spark, sf_dir, site), site, ("page_id",))
        return scrape.transform_site(rows, site, ("page_id",))

    return run


for _site in scrape.LAYOUTS:
    QUERIES[f"scrape_{_site}"] = _site_query(_site)


@query
def split_date_text(spark, sf_dir):
    ts = F.col("ts")
    e = F.col("event_id")
    text = (
        F.when(e % 4 == 0, F.concat(F.lit("Mon, "), F.dayofmonth(ts), F.lit(" january")))
        .when(e % 4 == 1, F.concat(F.dayofmonth(ts), F.lit("; january")))
        .when(e % 4 == 2, F.concat(F.lit("Monday "), F.dayofmonth(ts), F.lit(" january 2024")))
        .otherwise("day january")
    )
    rows = views.table(spark, sf_dir, "events").select("event_id", split_date(text).alias("d"))
    return rows.select("event_id", "d.weekday", "d.day", "d.month")


# ---------------------------------------------------------------- streams


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    # A pattern, because a stream's plain path must be a folder and the table may be one file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


@query
def stream_silver(spark, sf_dir):
    """The silver table, without its batch numbers, after the stream has ingested every event's payload, sent twice."""
    folder = work_folder(spark, "stream-silver")
    sent = views.mix_providers(_events_stream(spark, sf_dir))
    started = start_silver_ingest(
        sent.union(sent),
        f"{folder}/silver", f"{folder}/rejects", f"{folder}/checkpoint",
    )
    started.awaitTermination()
    silver = merge.read_table(spark, f"{folder}/silver", TABLES["silver"].schema)
    return silver.drop("batch_id")


@query
def stream_daily(spark, sf_dir):
    """Closed days of the streaming daily summary."""
    folder = work_folder(spark, "stream-daily")
    stream = _events_stream(spark, sf_dir)
    silver = clean_silver(views.observe(stream, "ts"), "stream")
    start_daily_summary(silver, "ts", f"{folder}/daily", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/daily")


@query
def stream_late_rows(spark, sf_dir):
    """Rows behind the watermark when every sixth event arrives after all others, and the days without them."""
    folder = work_folder(spark, "stream-late")
    events = views.table(spark, sf_dir, "events")
    for part in (F.col("event_id") % 6 != 0, F.col("event_id") % 6 == 0):
        events.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/events")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    start_late_split(
        arriving, "ts", f"{folder}/in-time", f"{folder}/late", f"{folder}/marks", f"{folder}/checkpoint"
    ).awaitTermination()
    late = spark.read.parquet(f"{folder}/late").select("event_id", "ts", F.lit(True).alias("late"))
    in_time = spark.read.parquet(f"{folder}/in-time").select("event_id", "ts", F.lit(False).alias("late"))
    return late.union(in_time)
