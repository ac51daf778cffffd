import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import views
from tidemark.operators import parsers


def events(spark, folder, rows, props='{"k": 7}'):
    """A table of events in a single row group."""
    made = spark.range(rows).select(
        F.col("id").alias("event_id"),
        F.lit(dt.datetime(2024, 1, 1, 5, 30)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.lit(props).alias("props"),
    )
    made.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_one_row_group_is_parsed_by_several_tasks(spark, tmp_path):
    n = 2 * views.PAYLOADS + 10
    folder = events(spark, tmp_path, n)
    bronze = views.provider_bronze(spark, folder, "openweathermap").select(F.spark_partition_id().alias("task"))
    sizes = [r["count"] for r in bronze.groupBy("task").count().collect()]
    assert len(sizes) == 3 and sum(sizes) == n and max(sizes) < 1.2 * views.PAYLOADS
    mixed = views.mixed_bronze(spark, folder)
    assert mixed.select(F.spark_partition_id()).distinct().count() == 3 and mixed.count() == n


def test_spread_keeps_every_row_with_copies_and_nulls(spark):
    rows = spark.createDataFrame([(1, None)] * 30 + [(None, None)] * 30 + [(2, "x")] * 7, "a int, b string")
    dealt = views.spread(rows, 10)
    assert dealt.rdd.getNumPartitions() == 7
    assert sorted(dealt.collect(), key=repr) == sorted(rows.collect(), key=repr)
    assert views.spread(rows.limit(0), 10).count() == 0


def test_number_of_an_event_is_read_once(spark, tmp_path, capsys):
    folder = events(spark, tmp_path, 3)
    bronze = views.provider_bronze(spark, folder, "openweathermap")
    bronze.explain()
    assert capsys.readouterr().out.count("get_json_object") == 1
    parsed = parsers.parse_provider(bronze, "openweathermap").select("humidity", "weather_code", "precip_prob").distinct()
    # Every ninth event has no weather.
    assert sorted(map(tuple, parsed.collect()), key=repr) == [(7.0, 207, 0.07), (7.0, None, 0.07)]


def test_odd_number_of_an_event_is_no_fault_where_no_payload_shows_it(spark, tmp_path):
    folder = events(spark, tmp_path, 3, props='{"k": "seven"}')
    parsed = parsers.parse_provider(views.provider_bronze(spark, folder, "meteoblue"), "meteoblue")
    assert parsed.count() == 9
