"""Rows that come behind the watermark, kept in a table of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import merge
from tidemark.session import staged

BATCH = ("batch",)
MARKS = T.StructType([T.StructField("newest", T.TimestampNTZType()), T.StructField("batch", T.LongType())])


def split_late(batch: DataFrame, event_time: str, newest, delay: str) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows): late is what an hourly window closed by ``newest`` minus ``delay`` no longer takes.

    ``newest`` is the largest event time of the batches before, or None. Rows without an event time are late.
    """
    moment = F.col(event_time)
    if newest is None:
        late = moment.isNull()
    else:
        closed = F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {delay}")
        late = moment.isNull() | (F.date_trunc("hour", moment) + F.expr("interval 1 hour") <= closed)
    return batch.where(~late), batch.where(late)


def start_late_split(
    rows: DataFrame, event_time: str, in_time_path: str, late_path: str, marks_path: str, checkpoint: str,
    delay: str = "1 hour",
) -> StreamingQuery:
    """Deal all new rows to a table of those in time and one of those behind the watermark, then stop.

    The daily summary reads the first table as its stream: its watermark never passes this one, so it
    drops nothing, and each row is either in a summary or in the late table. The newest event
    time of each batch is written beside them; a batch that runs again after a failure replaces its own parts
    and is cut at the same time as before.
    """

    def deal(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks = merge.read_table(spark, marks_path, MARKS)
        newest = marks.where(F.col("batch") < number).agg(F.max("newest")).first()[0]
        with staged(batch, "late") as batch:
            for part, path in zip(split_late(batch, event_time, newest, delay), (in_time_path, late_path)):
                merge.replace_partitions(part.withColumn("batch", F.lit(number).cast("bigint")), path, BATCH)
            seen = batch.agg(F.max(event_time).cast("timestamp_ntz").alias("newest"))
            merge.replace_partitions(seen.withColumn("batch", F.lit(number).cast("bigint")), marks_path, BATCH)

    return (
        rows.writeStream.foreachBatch(deal)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
