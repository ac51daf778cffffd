"""Whole runs over a small lake: bronze to yearly rollups, twice, with gaps and a fallback copy."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import schemas
from tidemark.operators import merge, rollups
from tidemark.plans import hourly, periods
from tidemark.plans.journal import Journal
from tidemark.plans.lake import Lake, TABLES
from tidemark.sources import bronze as bronze_source
from tidemark.streaming.daily import start_daily_summary
from tidemark.streaming.ingest import start_file_ingest, start_silver_ingest
from tidemark.streaming.late import start_late_split

D = dt.date


def payload(day, warm):
    days = [day + dt.timedelta(days=i) for i in range(2)]
    return json.dumps({"forecast": [{"date": str(d), "maxTemp": warm + i, "minTemp": warm - 5, "cloudiness": 40} for i, d in enumerate(days)]})


def bronze_rows(days, hours=(6, 7)):
    return [
        ("foreca_api", place, day, hour, payload(day, hour + shift))
        for day in days for hour in hours for place, shift in (("Hilltop", 0), ("Lakeside", 10))
    ]


def test_hourly_and_daily_runs(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    days = [D(2026, 2, 16), D(2026, 2, 17)]
    records = bronze_rows(days) + [("nobody", "Hilltop", days[0], 6, "{}")]
    bronze = spark.createDataFrame(records, schemas.BRONZE)
    assert lake.load("bronze", bronze).inserted == 9
    assert lake.load("bronze", bronze).inserted == 0

    result, rejected = hourly.build_silver(lake, lake.read("bronze"), "run-1")
    assert (result.rows_in, result.inserted) == (16, 16)
    assert [r["reason"] for r in rejected.collect()] == ["unknown_source"]
    assert hourly.build_silver(lake, lake.read("bronze"), "run-2")[0].inserted == 0

    now = dt.datetime(2026, 2, 17, 8)
    done = hourly.build_forecasts(lake, dt.datetime(2026, 2, 17, 7), now)
    # The first run starts at the oldest snapshot.
    assert done["gold_daily_forecast"].inserted == 8
    assert done["gold_five_day_forecast"].inserted == 16
    again = hourly.build_forecasts(lake, dt.datetime(2026, 2, 17, 7), now)
    assert again["gold_daily_forecast"].rows_in == 0
    assert lake.read("watermarks").first()["last_processed_ts"] == dt.datetime(2026, 2, 17, 7)

    assert hourly.build_daily(lake, D(2026, 2, 17), now).inserted == 4
    last = lake.read("gold_daily").where("forecast_date_utc = '2026-02-17'")
    got = {r["place_name"]: (r["temp_min"], r["temp_max"]) for r in last.collect()}
    assert got == {"Hilltop": (1.0, 7.0), "Lakeside": (11.0, 17.0)}
    assert hourly.build_daily(lake, D(2026, 2, 17), now).rows_in == 0


def test_hourly_run_over_two_copies(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "main"), fallback=str(tmp_path / "copy"))
    day, now = D(2026, 2, 17), dt.datetime(2026, 2, 17, 8)
    hourly.build_silver(lake, spark.createDataFrame(bronze_rows([day], hours=(6,)), schemas.BRONZE), "run-1")
    assert lake.read("silver").count() == lake.read("silver", fallback=True).count() == 4
    # An hour that only the copy has is used as well.
    alone = Lake(spark, str(tmp_path / "copy"))
    hourly.build_silver(alone, spark.createDataFrame(bronze_rows([day], hours=(6, 7)), schemas.BRONZE), "run-2")
    done = hourly.build_forecasts(lake, dt.datetime(2026, 2, 17, 7), now)
    assert done["gold_daily_forecast"].inserted == 4
    assert lake.read("gold_daily_forecast", fallback=True).count() == 4
    assert hourly.build_daily(lake, day, now).inserted == 2
    assert lake.read("gold_daily", fallback=True).count() == 2


def gold_daily(spark, days, value=1.0, places=("A", "B")):
    made = dt.datetime(2026, 1, 1)
    data = [(p, d, d, 23, *[value + i] * len(schemas.MEASURES), made) for i, d in enumerate(days) for p in places]
    return spark.createDataFrame(data, schemas.GOLD_DAILY)


def span(first, count):
    return [first + dt.timedelta(days=n) for n in range(count)]


def states(lake, level):
    found = lake.read("processing_state").where(F.col("processing_level") == level).collect()
    return {r["partition_date"]: (r["status"], r["retry_count"]) for r in found}


def test_weekly_run_with_gaps_and_fallback(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "main"), fallback=str(tmp_path / "copy"))
    full, short, patched = D(2025, 12, 29), D(2026, 1, 5), D(2026, 1, 12)
    lake.load("gold_daily", gold_daily(spark, span(full, 7) + span(short, 3) + span(patched, 2)))
    lake.load("gold_daily", gold_daily(spark, span(patched, 4), value=50.0), fallback=True)

    summary = periods.run_rollup(lake, "gold_weekly", D(2026, 1, 21), dt.datetime(2026, 1, 21))
    assert rows(summary) == [("gold_weekly", "pending", 1), ("gold_weekly", "success", 2)]
    assert states(lake, "gold_weekly") == {full: ("success", 0), short: ("pending", 1), patched: ("success", 0)}
    weekly = {(r["place_name"], r["week_start"]): r["temp_max"] for r in lake.read("gold_weekly").collect()}
    assert set(weekly) == {(p, w) for p in "AB" for w in (full, patched)}
    # Days the main copy has come from it, the two others from the fallback.
    assert weekly["A", patched] == 53.0
    assert lake.read("gold_weekly", fallback=True).count() == 4

    # The missing day arrives: only the pending week is rolled up.
    lake.load("gold_daily", gold_daily(spark, [D(2026, 1, 9)]))
    summary = periods.run_rollup(lake, "gold_weekly", D(2026, 1, 21), dt.datetime(2026, 1, 22))
    assert rows(summary) == [("gold_weekly", "success", 1)]
    assert states(lake, "gold_weekly")[short][0] == "success"
    assert lake.read("gold_weekly").count() == 6


def test_a_run_writes_the_state_once(spark, tmp_path, monkeypatch):
    lake, written = Lake(spark, str(tmp_path)), []
    lake.load("gold_daily", gold_daily(spark, span(D(2025, 12, 29), 10)))
    plain = merge.replace_partitions
    monkeypatch.setattr(merge, "replace_partitions", lambda df, path, *a: written.append(path) or plain(df, path, *a))
    periods.run_rollup(lake, "gold_weekly", D(2026, 1, 14), dt.datetime(2026, 1, 14))
    assert [path for path in written if path.endswith("processing_state")] == [lake.path("processing_state")]
    assert states(lake, "gold_weekly") == {D(2025, 12, 29): ("success", 0), D(2026, 1, 5): ("pending", 1)}
    assert not list((tmp_path / "state_events").glob("*/*.parquet"))


def test_logged_events_of_a_stopped_run_count_once(spark, tmp_path, monkeypatch):
    lake, level = Lake(spark, str(tmp_path)), "gold_weekly"
    event = spark.createDataFrame([(level, D(2026, 1, 5), "pending", 7)], "processing_level string, partition_date date, status string, expected_count int")
    journal = Journal(lake, level)
    journal.record(dt.datetime(2026, 1, 12), event, event)
    # Another run sees what was logged, with its time.
    seen = Journal(lake, level).state().first()
    assert (seen.status, seen.retry_count, seen.updated_at) == ("pending", 1, dt.datetime(2026, 1, 12))
    with monkeypatch.context() as patch:
        # Stopped after the fold, before the log is dropped.
        patch.setattr("tidemark.plans.journal.remove_folder", lambda *_: None)
        Journal(lake, level).compact(dt.datetime(2026, 1, 13), event)
    assert states(lake, level) == {D(2026, 1, 5): ("pending", 2)}
    assert Journal(lake, level).state().first().retry_count == 2
    Journal(lake, level).compact(dt.datetime(2026, 1, 14), event.withColumn("status", F.lit("success")))
    row = lake.read("processing_state").first()
    assert (row.status, row.retry_count, row.created_at, row.updated_at) == ("success", 2, dt.datetime(2026, 1, 12), dt.datetime(2026, 1, 14))


def test_late_days_are_added_without_reading_the_others(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "main"), fallback=str(tmp_path / "copy"))
    full, short = D(2025, 12, 29), D(2026, 1, 5)
    first = gold_daily(spark, span(full, 6) + span(short, 3))
    lake.load("gold_daily", first)
    lake.load("gold_daily", first, fallback=True)
    as_of, now = D(2026, 1, 14), dt.datetime(2026, 1, 14)
    periods.run_rollup(lake, "gold_weekly", as_of, now)
    late = gold_daily(spark, [D(2026, 1, 4), D(2026, 1, 8), D(2026, 1, 13)], value=100.0).unionByName(first)
    # The rows of the run are gone: nothing but the stored sums says what they were.
    import shutil

    shutil.rmtree(tmp_path / "main" / "gold_daily")
    for _ in range(2):
        periods.roll_late(lake, "gold_weekly", late, as_of, now)
    weekly = {(r.place_name, r.week_start): (r.temp_min, r.temp_max, r.temp_avg) for r in lake.read("gold_weekly").collect()}
    values, more = [float(i + 1) for i in range(6)], [float(i + 1) for i in range(6, 9)]
    for place in "AB":
        assert weekly[place, full] == (1.0, 100.0, round((sum(values) + 100) / 7, 2))
        assert weekly[place, short] == (7.0, 101.0, round((sum(more) + 101) / 4, 2))
    assert set(weekly) == {(p, w) for p in "AB" for w in (full, short)}
    assert rows(lake.read("gold_weekly")) == rows(lake.read("gold_weekly", fallback=True))
    assert states(lake, "gold_weekly")[short][0] == "success"
    assert periods.roll_late(lake, "gold_weekly", late.limit(0), as_of, now).count() == 0


def test_partial_sums_are_the_same_for_any_partitioning(spark):
    data = gold_daily(spark, span(D(2026, 1, 1), 200), value=0.1).withColumn("temp_avg", F.col("temp_avg") / 7 + 1e9)
    whole = rows(rollups.partials(data, "forecast_date_utc", "month"))
    for n in (1, 3, 17):
        assert rows(rollups.partials(data.repartition(n), "forecast_date_utc", "month")) == whole
    halves = [rollups.partials(data.where(F.dayofmonth("forecast_date_utc") % 2 == k), "forecast_date_utc", "month") for k in (0, 1)]
    assert rows(rollups.merge_partials(halves[0].union(halves[1]))) == whole


def test_hopeless_week_is_abandoned(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.load("gold_daily", gold_daily(spark, span(D(2025, 12, 29), 2)))
    seen = []
    for n in range(4):
        periods.run_rollup(lake, "gold_weekly", D(2026, 1, 7), dt.datetime(2026, 1, 7 + n))
        seen.append(states(lake, "gold_weekly")[D(2025, 12, 29)][0])
    assert seen[-1] == "abandoned" and seen[0] == "pending"
    assert lake.read("gold_weekly").count() == 0


def test_months_seasons_and_years(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.load("gold_daily", gold_daily(spark, span(D(2026, 1, 1), 31 + 28 + 31 + 30 + 20)))
    as_of = D(2026, 6, 3)
    rows_of = lambda name, *c: rows(lake.read(name).select(*c))
    periods.run_rollup(lake, "gold_monthly", as_of, dt.datetime(2026, 6, 3))
    assert rows_of("gold_monthly", "place_name", "month_number") == [(p, m) for p in "AB" for m in (1, 2, 3, 4)]
    assert states(lake, "gold_monthly")[D(2026, 5, 1)] == ("pending", 1)
    # A first run starts at the oldest day.
    assert min(states(lake, "gold_monthly")) == D(2026, 1, 1)

    periods.run_rollup(lake, "gold_seasonal", as_of, dt.datetime(2026, 6, 3))
    # Winter lacks December, spring lacks May.
    assert rows_of("gold_seasonal", "season_name") == []
    assert states(lake, "gold_seasonal") == {D(2025, 12, 1): ("pending", 1), D(2026, 3, 1): ("pending", 1)}

    periods.run_rollup(lake, "gold_yearly", as_of, dt.datetime(2026, 6, 3))
    # Five months have ended, one may be missing.
    assert rows_of("gold_yearly", "place_name", "year", "temp_max") == [("A", 2026, 120.0), ("B", 2026, 120.0)]

    lake.load("gold_daily", gold_daily(spark, span(D(2026, 5, 1), 31), value=500.0))
    periods.run_rollup(lake, "gold_monthly", as_of, dt.datetime(2026, 6, 4))
    periods.run_rollup(lake, "gold_seasonal", as_of, dt.datetime(2026, 6, 4))
    periods.run_rollup(lake, "gold_yearly", as_of, dt.datetime(2026, 6, 4))
    assert rows_of("gold_seasonal", "place_name", "year", "season_name") == [("A", 2026, "spring"), ("B", 2026, "spring")]
    # The year is replaced, its first load time kept.
    assert {(r["temp_max"], r["updated_at"]) for r in lake.read("gold_yearly").collect()} == {(530.0, dt.datetime(2026, 6, 3))}


def test_first_rollup_on_an_empty_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    assert periods.run_rollup(lake, "gold_seasonal", D(2026, 6, 3), dt.datetime(2026, 6, 3)).count() == 0


# ---------------------------------------------------------------- streams


def test_stream_ingests_new_files_once(spark, tmp_path):
    landing, silver = tmp_path / "landing", str(tmp_path / "silver")

    def land(name, days):
        spark.createDataFrame(bronze_rows(days), schemas.BRONZE).coalesce(1).write.mode("append").parquet(str(landing))

    def run():
        stream = spark.readStream.schema(schemas.BRONZE).parquet(str(landing))
        start_silver_ingest(stream, silver, str(tmp_path / "rejects"), str(tmp_path / "checkpoint")).awaitTermination()
        return merge.read_table(spark, silver, schemas.SILVER)

    land("a", [D(2026, 2, 16)])
    assert run().count() == 8
    # The same hour again and a new one: only the new one adds rows.
    land("b", [D(2026, 2, 16), D(2026, 2, 17)])
    second = run()
    assert second.count() == 16
    assert rows(second.groupBy("ingest_date").count()) == [(D(2026, 2, 16), 8), (D(2026, 2, 17), 8)]
    assert run().count() == 16
    batch = Lake(spark, str(tmp_path / "lake"))
    hourly.build_silver(batch, spark.createDataFrame(bronze_rows([D(2026, 2, 16), D(2026, 2, 17)]), schemas.BRONZE), "b")
    columns = [c for c in schemas.SILVER.names if c != "batch_id"]
    assert rows(second.select(*columns)) == rows(batch.read("silver").select(*columns))


def test_stream_emits_closed_days_and_drops_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "ts timestamp_ntz, place_name string, forecast_date_utc date, " + ", ".join(
        f"{c} double" for c in ("temp_min", "temp_max", "temp_avg", "rain", "snow", "wind_speed", "clouds", "humidity")
    )

    def add(*moments):
        data = [(dt.datetime(2026, 2, d, h), "A", D(2026, 2, d), *[float(v)] * 8) for d, h, v in moments]
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        start_daily_summary(stream, "ts", out, str(tmp_path / "cp")).awaitTermination()
        return rows(spark.read.parquet(out).select("day", "temp_min", "temp_max", "temp_avg"))

    add((16, 1, 1), (16, 1, 3), (16, 5, 8), (17, 2, 5), (17, 3, 9))
    assert run() == [(D(2026, 2, 16), 1.0, 8.0, 5.0)]
    add((16, 9, 99), (18, 9, 1))
    assert run() == [(D(2026, 2, 16), 1.0, 8.0, 5.0), (D(2026, 2, 17), 5.0, 9.0, 7.0)]


def test_stream_of_json_files(spark, tmp_path):
    from tidemark.sources.bronze import stream_bronze_files

    folder = tmp_path / "raw" / "2026-02-16_foreca_Hilltop"
    folder.mkdir(parents=True)
    for hour in (6, 7):
        (folder / f"{hour:02d}.json").write_text(json.dumps(json.loads(payload(D(2026, 2, 16), hour)), indent=1))
    stream = stream_bronze_files(spark, str(tmp_path / "raw"), files_per_batch=1)
    paths = [str(tmp_path / name) for name in ("silver", "rejects", "checkpoint")]
    start_silver_ingest(stream, *paths).awaitTermination()
    got = merge.read_table(spark, paths[0], schemas.SILVER)
    assert rows(got.select("api_name", "place_name", "ingest_hour", "temp_max")) == [
        ("foreca", "Hilltop", 6, 6.0), ("foreca", "Hilltop", 6, 7.0), ("foreca", "Hilltop", 7, 7.0), ("foreca", "Hilltop", 7, 8.0),
    ]


def test_records_sent_again_are_parsed_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    records = bronze_rows([D(2026, 2, 16)]) + [("nobody", "Hilltop", None, None, "{}"), ("foreca", None, D(2026, 2, 16), 6, None)]
    spark.createDataFrame(records * 3, schemas.BRONZE).repartition(3).write.parquet(landing)
    stream = spark.readStream.schema(schemas.BRONZE).option("maxFilesPerTrigger", 1).parquet(landing)
    paths = [str(tmp_path / name) for name in ("silver", "rejects", "checkpoint")]
    start_silver_ingest(stream, *paths).awaitTermination()
    assert merge.read_table(spark, paths[0], schemas.SILVER).count() == 8
    # Nothing is lost by having no date, and no reject comes twice.
    assert spark.read.parquet(paths[1]).count() == 2


def test_file_stream_turns_odd_paths_away_whole(spark, tmp_path):
    for folder, hour in (("2026-02-16_foreca_Hilltop", "06"), ("2026-02-16_foreca", "06"), ("2026-02-30_foreca_Hilltop", "07"), ("2026-02-16_foreca_Hilltop", "77")):
        (tmp_path / "raw" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / folder / f"{hour}.json").write_text(payload(D(2026, 2, 16), 6))
    paths = [str(tmp_path / name) for name in ("silver", "rejects", "checkpoint")]
    for _ in range(2):
        start_file_ingest(spark, str(tmp_path / "raw"), *paths).awaitTermination()
    assert merge.read_table(spark, paths[0], schemas.SILVER).count() == 2
    odd = spark.read.parquet(paths[1]).collect()
    assert [r.reason for r in odd] == ["odd_path"] * 3 and all("maxTemp" in r.detail for r in odd)


def test_second_scan_reads_new_files_only(spark, tmp_path):
    raw = tmp_path / "raw"

    def put(folder, hour, text):
        (raw / folder).mkdir(parents=True, exist_ok=True)
        (raw / folder / f"{hour}.json").write_text(text)

    paths = [str(tmp_path / name) for name in ("raw", "bronze", "rejects", "registry")]
    scan = lambda: bronze_source.ingest_new_files(spark, *paths, TABLES["bronze"])
    put("2026-02-16_foreca_Hilltop", "06", "{}")
    put("2026-02-16_foreca", "06", "odd")
    first = scan()
    assert (first.rows_in, first.inserted) == (1, 1)
    assert scan().rows_in == 0
    put("2026-02-16_foreca_Hilltop", "07", "{}")
    assert scan().inserted == 1
    assert merge.read_table(spark, paths[1], schemas.BRONZE).count() == 2
    assert [r.detail.split("\n")[1] for r in spark.read.parquet(paths[2]).collect()] == ["odd"]
    registry = spark.read.parquet(paths[3])
    assert registry.count() == 3
    # Files older than the newest one known, less the overlap, are not even listed.
    later = registry.withColumn("modified", F.col("modified") + F.expr("interval 3 hours")).where("path NOT LIKE '%07.json'")
    assert bronze_source.new_files(spark, paths[0], later).count() == 0


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    source, paths = str(tmp_path / "in"), [str(tmp_path / n) for n in ("ok", "late", "marks", "cp")]
    ddl = "ts timestamp_ntz, place_name string, forecast_date_utc date, " + ", ".join(
        f"{c} double" for c in ("temp_min", "temp_max", "temp_avg", "rain", "snow", "wind_speed", "clouds", "humidity")
    )

    def add(*moments):
        data = [(dt.datetime(2026, 2, d, h, 30) if d else None, "A", D(2026, 2, d or 1), *[float(v)] * 8) for d, h, v in moments]
        spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        start_late_split(stream, "ts", *paths).awaitTermination()

    add((16, 1, 1), (16, 5, 8), (17, 3, 9), (None, 0, 0))
    # The hour from two to three is closed at half past two, one hour behind; the hour before is, too.
    add((17, 1, 7), (17, 2, 5), (16, 9, 99), (18, 9, 1))
    add((17, 23, 6), (18, 8, 4))
    late = spark.read.parquet(paths[1])
    assert rows(late.select("ts")) == [(None,), (dt.datetime(2026, 2, 16, 9, 30),), (dt.datetime(2026, 2, 17, 1, 30),), (dt.datetime(2026, 2, 17, 23, 30),)]
    # The summary over the rows in time drops none of them.
    ok = spark.read.parquet(paths[0])
    stream = spark.readStream.schema(ok.schema).parquet(paths[0])
    start_daily_summary(stream, "ts", str(tmp_path / "out"), str(tmp_path / "cp2")).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "out")).select("day", "temp_min", "temp_max"))
    assert got == [(D(2026, 2, 16), 1.0, 8.0), (D(2026, 2, 17), 5.0, 9.0)]
