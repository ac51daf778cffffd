"""Streaming ingest: bronze records to the silver table, exactly once per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import merge
from tidemark.operators.parsers import tag_forecasts
from tidemark.plans.hourly import split_silver
from tidemark.plans.lake import TABLES
from tidemark.session import staged
from tidemark.sources import bronze as source


def without_repeats(records: DataFrame, within: str) -> DataFrame:
    """A stream of records without those that have come before, byte for byte, less than ``within`` ago.

    The time is that of arrival, so no record is ever too late to be taken. State holds a key for that time; what is sent
    again later goes as far as the sink, which ignores known keys.
    """
    keys = [name for name in records.columns if name != "payload"]
    return (
        records.withColumns({"_arrived": F.current_timestamp(), "_payload": F.sha2("payload", 256)})
        .withWatermark("_arrived", within)
        .dropDuplicatesWithinWatermark([*keys, "_payload"])
        .drop("_arrived", "_payload")
    )


def _load(tagged: DataFrame, odd: DataFrame | None, silver_path: str, rejects_path: str, number: int) -> None:
    silver = TABLES["silver"]
    valid, rejects = split_silver(tagged, f"batch-{number}")
    if odd is not None:
        rejects = rejects.unionByName(odd)
    merge.insert_ignore_into(
        valid, silver_path, silver.schema, silver.keys, silver.order_by, silver.partition_by, silver.nullable
    )
    merge.replace_partitions(rejects.withColumn("batch", F.lit(number)), rejects_path, ("batch",))


def start_silver_ingest(
    bronze: DataFrame, silver_path: str, rejects_path: str, checkpoint: str, within: str | None = "1 hour"
) -> StreamingQuery:
    """Process all new bronze records, then stop.

    Records sent again ``within`` that time are dropped before they are parsed (None: never). The batch functions do the
    rest. A batch that runs again after a failure inserts nothing twice: silver ignores known
    keys, and rejects overwrite their own batch's partition.
    """
    records = bronze if within is None else without_repeats(bronze, within)

    def load(batch: DataFrame, number: int) -> None:
        with staged(batch, "tagged") as tagged:
            _load(tagged, None, silver_path, rejects_path, number)

    return (
        tag_forecasts(records)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_file_ingest(
    spark: SparkSession, base: str, silver_path: str, rejects_path: str, checkpoint: str, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Process all new raw files below ``base``, then stop.

    Files whose path does not say provider, place, date and hour come out with the rejects, whole.
    """

    def load(batch: DataFrame, number: int) -> None:
        with staged(batch, "files") as files, staged(tag_forecasts(source.named_files(files)), "tagged") as tagged:
            _load(tagged, source.odd_files(files), silver_path, rejects_path, number)

    return (
        source.stream_files(spark, base, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
