import datetime as dt
import re

import pytest

from pyspark.sql import functions as F

from conftest import rows
from tidemark import schemas
from tidemark.operators import merge
from tidemark.operators.layout import Month, folder_sources
from tidemark.plans.lake import Lake, TABLES
from tidemark.sources import slices

D = dt.date


def test_insert_ignore_keeps_the_first_of_a_key(spark):
    target = spark.createDataFrame([(1, 9, "old")], "k int, o int, v string")
    batch = spark.createDataFrame([(1, 1, "a"), (2, 2, "c"), (2, 1, "b"), (3, 1, "d")], "k int, o int, v string")
    assert rows(merge.insert_ignore(target, batch, ["k"], ["o"])) == [(2, 1, "b"), (3, 1, "d")]


def test_null_keys_match_null_where_asked(spark):
    ddl = "p string, h int, v int"
    target = spark.createDataFrame([("a", None, 0)], ddl)
    batch = spark.createDataFrame([("a", None, 1), ("b", None, 3), ("b", None, 2), ("a", 5, 4)], ddl)
    assert rows(merge.insert_ignore(target, batch, ["p", "h"], ["v"], nullable=["h"])) == [("a", 5, 4), ("b", None, 2)]


def test_upsert_updates_only_the_listed_columns(spark):
    ddl = "k int, o int, value int, made string"
    target = spark.createDataFrame([(1, 0, 10, "first"), (2, 0, 20, "first")], ddl)
    batch = spark.createDataFrame([(2, 1, 21, "x"), (2, 2, None, "y"), (3, 1, 30, "new")], ddl)
    assert rows(merge.upsert(target, batch, ["k"], ["value"], ["o"])) == [
        (1, 0, 10, "first"), (2, 0, None, "first"), (3, 1, 30, "new"),
    ]


def test_load_report(spark):
    target = spark.createDataFrame([("a", 1)], "g string, k int")
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), ("b", 1)], "g string, k int")
    assert rows(merge.load_report(target, batch, ["g", "k"], ["g"])) == [("a", 3, 1, 2), ("b", 2, 1, 1)]


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    batch = spark.range(1000).selectExpr("0 as k", "id as o", "cast(id as string) as v")
    plan = merge.first_per_key(batch, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan
    assert rows(merge.first_per_key(batch, ["k"], ["o"], last=True)) == [(0, 999, "999")]


def daily(spark, *keys, value=1.0):
    made = dt.datetime(2026, 2, 21, 12)
    data = [(p, d, D(2026, 2, 21), 12, *[value] * len(schemas.MEASURES), made) for p, d in keys]
    return spark.createDataFrame(data, schemas.GOLD_DAILY)


def test_loading_twice_inserts_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    batch = daily(spark, ("Testville", D(2026, 2, 22)), ("Testopolis", D(2026, 2, 23)))
    first, second = lake.load("gold_daily", batch), lake.load("gold_daily", batch)
    assert (first.rows_in, first.inserted, first.skipped) == (2, 2, 0)
    assert (second.inserted, second.skipped) == (0, 2)
    mixed = daily(spark, ("Testville", D(2026, 2, 22)), ("Testville", D(2026, 2, 23)), ("Testville", D(2026, 2, 23)), value=9.0)
    third = lake.load("gold_daily", mixed)
    assert (third.rows_in, third.inserted) == (3, 1)
    assert lake.read("gold_daily").count() == 3
    assert lake.read("gold_daily").where("temp_max = 9").count() == 1


def test_a_month_is_one_folder_of_sorted_files(spark, tmp_path):
    lake, table = Lake(spark, str(tmp_path)), TABLES["gold_daily"]
    lake.load("gold_daily", daily(spark, *[(p, D(2026, m, d)) for p in "BCA" for m in (1, 2) for d in range(28, 0, -1)]))
    folders = sorted(f.name for f in (tmp_path / "gold_daily").iterdir() if f.is_dir())
    assert folders == ["forecast_date_utc_month=2026-01-01", "forecast_date_utc_month=2026-02-01"]
    for file in lake.read("gold_daily").inputFiles():
        stored = [(r.forecast_date_utc, r.place_name) for r in spark.read.parquet(file).collect()]
        assert stored == sorted(stored)
    assert lake.read("gold_daily").columns == table.schema.names


def test_load_reads_only_the_folders_and_rows_it_touches(spark, tmp_path):
    lake, folders = Lake(spark, str(tmp_path)), TABLES["gold_daily"].partition_by
    lake.load("gold_daily", daily(spark, *[("A", D(2026, m, d)) for m in range(1, 11) for d in (4, 9)]))
    batch = daily(spark, ("A", D(2026, 4, 4)), ("B", D(2026, 5, 4)))
    slice_ = merge.touched(lake.scan("gold_daily"), batch, folders, ("forecast_date_utc",))
    plan = slice_._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*forecast_date_utc_month#\d+ >= 2026-04-01", plan)
    assert re.search(r"\(forecast_date_utc#\d+ >= 2026-04-04\)", plan)
    assert slice_.count() == 3
    # Nothing of the months between two months of a batch.
    apart = daily(spark, ("A", D(2026, 2, 2)), ("B", D(2026, 9, 9)))
    slice_ = merge.touched(lake.scan("gold_daily"), apart, folders)
    assert sorted({r.forecast_date_utc.month for r in slice_.collect()}) == [2, 9]


def test_increments_read_only_their_months(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.load("gold_daily", daily(spark, *[("A", D(2026, m, 15)) for m in range(1, 13)]))
    rows_ = slices.daily_increment(lake.scan("gold_daily"), "forecast_date_utc", dt.datetime(2026, 3, 20), D(2026, 5, 31))
    assert "PartitionFilters: [isnotnull(forecast_date_utc_month" in rows_._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.forecast_date_utc.month for r in rows_.collect()) == [4, 5]
    # A date column other than the folders' one prunes no folder.
    other = slices.date_range(lake.scan("gold_daily"), "ingest_date", D(2000, 1, 1), D(2000, 1, 2))
    assert "PartitionFilters: []" in other._jdf.queryExecution().executedPlan().toString()


def test_upsert_rewrites_the_pairs_of_the_batch_only(spark, tmp_path):
    schema, path = "a int, b string, v int", str(tmp_path / "t")
    rows_ = [(a, b, 0) for a in range(20) for b in ("x", "y", None)]
    load = lambda data: merge.upsert_into(
        spark.createDataFrame(data, schema), path, spark.createDataFrame([], schema).schema, ("a", "b"), ("v",), ("v",), ("a", "b")
    )
    load(rows_)
    before = set(spark.read.parquet(path).inputFiles())
    # Ten pairs (a, b), one of them with a null: not the twenty that their values could form.
    load([(a, "x" if a % 2 else "y", 1) for a in range(9)] + [(9, None, 1)])
    after = set(spark.read.parquet(path).inputFiles())
    assert len(before - after) == 10
    # Keys with a null match nothing, so that row is new.
    assert spark.read.parquet(path).count() == 61


@pytest.mark.parametrize("order", [1, -1])
def test_the_same_duplicate_wins_in_any_order(spark, order):
    data = [("A", 1, 2.0), ("A", 1, 1.0), ("A", 1, 3.0)][::order]
    batch = spark.createDataFrame(data, "k string, o int, v double").coalesce(1)
    assert merge.first_per_key(batch, ["k"], ["o"]).first()["v"] == 1.0


def test_a_run_with_a_fallback_stages_thrice(spark, tmp_path, monkeypatch):
    from tidemark import session
    from tidemark.plans import hourly

    folders = []
    plain = session.work_folder
    monkeypatch.setattr(session, "work_folder", lambda spark, label: folders.append(plain(spark, label)) or folders[-1])
    payload = '{"forecast": [{"date": "2026-02-21", "maxTemp": 3}]}'
    bronze = spark.createDataFrame([("foreca", "A", D(2026, 2, 21), 8, payload)], schemas.BRONZE)
    lake = Lake(spark, str(tmp_path / "main"), fallback=str(tmp_path / "copy"))
    result, _ = hourly.build_silver(lake, bronze, "b1")
    # The tagged rows, the batch, and the rows that a copy lacks.
    assert result.inserted == 1 and len(folders) == 3
    import os

    assert [os.path.exists(f) for f in folders] == [True, False, False]


def test_upsert_rewrites_only_its_partitions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))

    def yearly(year, value, stamp):
        data = [("A", year, D(year, 1, 1), "yearly", *[value] * len(schemas.MEASURES), stamp)]
        return spark.createDataFrame(data, schemas.GOLD_YEARLY)

    early, late = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    lake.load("gold_yearly", yearly(2024, 1.0, early).unionByName(yearly(2025, 2.0, early)))
    before = set(spark.read.parquet(lake.path("gold_yearly")).where("year_start = '2024-01-01'").inputFiles())
    lake.load("gold_yearly", yearly(2025, 3.0, late).unionByName(yearly(2026, 4.0, late)))
    got = {r["year"]: (r["temp_max"], r["updated_at"]) for r in lake.read("gold_yearly").collect()}
    # The time of the first insert stays on conflict.
    assert got == {2024: (1.0, early), 2025: (3.0, early), 2026: (4.0, late)}
    after = set(spark.read.parquet(lake.path("gold_yearly")).where("year_start = '2024-01-01'").inputFiles())
    assert {f for f in before if "2024-01-01" in f} == {f for f in after if "2024-01-01" in f}


def test_write_once_skips_existing_partitions(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ("forecast_date_utc",)
    first = merge.write_once(daily(spark, ("A", D(2026, 1, 1))), path, schemas.GOLD_DAILY, keys)
    second = merge.write_once(daily(spark, ("B", D(2026, 1, 1)), ("B", D(2026, 1, 2))), path, schemas.GOLD_DAILY, keys)
    assert (first.inserted, second.inserted, second.skipped) == (1, 1, 1)
    # Days are written once, also where a folder holds a month of them.
    months = str(tmp_path / "months")
    for batch, inserted in ((daily(spark, ("A", D(2026, 1, 1))), 1), (daily(spark, ("B", D(2026, 1, 1)), ("B", D(2026, 1, 2))), 1)):
        assert merge.write_once(batch, months, schemas.GOLD_DAILY, keys, (Month("forecast_date_utc"),), keys).inserted == inserted
    stored = merge.read_table(spark, path, schemas.GOLD_DAILY)
    assert rows(stored.select("place_name", "forecast_date_utc")) == [("A", D(2026, 1, 1)), ("B", D(2026, 1, 2))]
    report = merge.write_report(stored, daily(spark, ("C", D(2026, 1, 2)), ("C", D(2026, 1, 3))), keys)
    assert rows(report) == [(D(2026, 1, 2), False, "already_exists"), (D(2026, 1, 3), True, "created")]


def test_one_failing_sink_is_enough(spark, tmp_path):
    blocked = tmp_path / "blocked"
    blocked.write_text("a file, not a folder")
    lake = Lake(spark, str(tmp_path / "main"), fallback=str(blocked))
    worked, failed = lake.load_both("gold_daily", daily(spark, ("A", D(2026, 1, 1))))
    assert worked is None and "blocked" in failed
    lake = Lake(spark, str(blocked), fallback=str(tmp_path / "copy"))
    failed, worked = lake.load_both("gold_daily", daily(spark, ("A", D(2026, 1, 1))))
    assert worked is None and "blocked" in failed


def test_a_failed_copy_is_repaired_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "main"), fallback=str(tmp_path / "copy"))
    both = daily(spark, ("A", D(2026, 1, 1)), ("B", D(2026, 1, 2)), ("A", D(2026, 3, 1)))
    lake.load_both("gold_daily", both)
    assert lake.differing("gold_daily").count() == 0
    lake.load("gold_daily", daily(spark, ("A", D(2026, 3, 2)), ("A", D(2026, 4, 1))))
    lake.load("gold_daily", daily(spark, ("C", D(2026, 5, 1))), fallback=True)
    months = lambda: sorted(r[0].month for r in lake.differing("gold_daily").collect())
    assert months() == [3, 4, 5]
    before = {p.name for p in (tmp_path / "copy" / "gold_daily").glob("*2026-01-01/*.parquet")}
    result = lake.repair("gold_daily", fallback=True)
    # Two rows of March are read, one of them known; what only the copy has stays there.
    assert (result.rows_in, result.inserted) == (3, 2) and months() == [5]
    assert {p.name for p in (tmp_path / "copy" / "gold_daily").glob("*2026-01-01/*.parquet")} == before
    assert lake.repair("gold_daily", fallback=False).inserted == 1 and months() == []


def test_fingerprints_see_any_change_of_a_row(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, None, 2.0), (None, "n", 0.0)], "p int, s string, v double")
    assert merge.differing(left, left.repartition(3), ["p"]).collect() == []
    right = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.5), (None, "n", 0.0), (4, "new", 1.0)], left.schema)
    assert rows(merge.differing(left, right, ["p"])) == [(1,), (2,), (4,)]


def test_watermark_moves_to_the_newest_row_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    now = dt.datetime(2026, 2, 1)
    made = spark.createDataFrame([(dt.datetime(2026, 1, 31, 5),), (dt.datetime(2026, 1, 30),)], "ts timestamp_ntz")
    lake.save_watermark("job", made, "ts", now)
    lake.save_watermark("other", made.limit(0), "ts", now)
    got = lake.read("watermarks").collect()
    assert [(r["job_name"], r["last_processed_ts"]) for r in got] == [("job", dt.datetime(2026, 1, 31, 5))]


def test_partition_columns_are_part_of_every_key():
    for name, table in TABLES.items():
        assert set(folder_sources(table.partition_by)) <= set(table.keys), name
        assert set(table.keys) | set(table.order_by) <= set(table.schema.names), name
