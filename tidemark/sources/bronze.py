"""Reading raw payloads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions import clock
from tidemark.operators.merge import LoadResult, append, insert_ignore_into, read_table, write_report
from tidemark.schemas import BRONZE
from tidemark.session import staged
from tidemark.sources.slices import hour_slice

# Fixed value: {date}_{source}_{place}/{hour}.json
_FILE = r"(\d{4}-\d{2}-\d{2})_(.+)_([^_/]+)/(\d{2})\.json$"


def _named() -> Column:
    read = (F.col("source") != "") & (F.col("place_name") != "") & F.col("ingest_date").isNotNull()
    return read & F.coalesce(F.col("ingest_hour").between(0, 23), F.lit(False))


def _from_path(lines: DataFrame, *more: Column) -> DataFrame:
    path = F.url_decode(F.col("_metadata.file_path"))
    return lines.select(
        F.regexp_extract(path, _FILE, 2).alias("source"),
        F.regexp_extract(path, _FILE, 3).alias("place_name"),
        F.regexp_extract(path, _FILE, 1).try_cast("date").alias("ingest_date"),
        F.regexp_extract(path, _FILE, 4).try_cast("int").alias("ingest_hour"),
        F.col("value").alias("payload"),
        path.alias("path"),
        *more,
    )


def named_files(files: DataFrame) -> DataFrame:
    """Files whose path says source, place, date and hour, as bronze rows."""
    return files.where(_named()).drop("path")


def odd_files(files: DataFrame) -> DataFrame:
    """The other files, in the layout of rejected records; the detail is the path and the whole text."""
    return files.where(~_named()).select(
        *[F.nullif(F.col(name), F.lit("")).alias(name) for name in ("source", "place_name")],
        "ingest_date", "ingest_hour", F.lit("odd_path").alias("reason"),
        F.concat_ws("\n", "path", "payload").alias("detail"),
    )


def _globs(base: str, date: dt.date | None, hour: int | None) -> str:
    day = f"{date:%Y-%m-%d}" if date else "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
    file = f"{hour:02d}" if hour is not None else "[0-9][0-9]"
    return f"{base.rstrip('/')}/{day}_*/{file}.json"


def read_bronze_files(
    spark: SparkSession, base: str, date: dt.date | None = None, hour: int | None = None
) -> DataFrame:
    """Raw JSON files as bronze rows, any number of days and hours in one scan.

    Source, place and date come from the folder name, the hour from the file name. Files whose
    path does not say them are left to ``read_odd_files``.
    """
    return named_files(_scan(spark, base, date, hour))


def read_odd_files(spark: SparkSession, base: str) -> DataFrame:
    """Files below ``base`` that lie in a dated folder but under a name that can't be read."""
    return odd_files(_scan(spark, base, None, None))


def _scan(spark: SparkSession, base: str, date: dt.date | None, hour: int | None) -> DataFrame:
    return _from_path(spark.read.text(_globs(base, date, hour), wholetext=True))


def stream_files(spark: SparkSession, base: str, files_per_batch: int = 10_000) -> DataFrame:
    """All files in dated folders as a stream, each new file once, odd paths among them."""
    stream = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(
        _globs(base, None, None), wholetext=True
    )
    return _from_path(stream)


def stream_bronze_files(spark: SparkSession, base: str, files_per_batch: int = 10_000) -> DataFrame:
    """The files of that stream whose path can be read, as bronze rows."""
    return named_files(stream_files(spark, base, files_per_batch))


def new_files(spark: SparkSession, base: str, known: DataFrame, overlap: dt.timedelta = dt.timedelta(hours=1)) -> DataFrame:
    """Files below ``base`` that ``known`` (path, modified) does not hold, with path and time of modification.

    The listing leaves out files older than the newest known one less ``overlap``, which covers files that became
    visible late; an anti join on the path leaves out those that were taken. Only the others are read.
    """
    newest = known.agg(F.max("modified")).first()[0]
    reader = spark.read
    if newest is not None:
        reader = reader.option("modifiedAfter", (newest - overlap).strftime("%Y-%m-%dT%H:%M:%S"))
    files = reader.text(_globs(base, None, None), wholetext=True)
    stamp = clock.instant_utc(F.col("_metadata.file_modification_time"))
    named = _from_path(files, stamp.alias("modified"))
    return named.join(known.select("path"), "path", "left_anti").select(*named.columns)


def _ingest_schema() -> str:
    return "path STRING, modified TIMESTAMP_NTZ"


def ingest_new_files(spark: SparkSession, base: str, bronze_path: str, rejects_path: str, registry_path: str, table) -> LoadResult:
    """Load files not taken before into bronze, odd ones into the rejects, and note them all.

    ``table`` says schema, key and folders of the bronze table. The note comes last: a run that stops before it
    takes the same files again, and bronze ignores the known keys.
    """
    known = read_table(spark, registry_path, spark.createDataFrame([], _ingest_schema()).schema)
    with staged(new_files(spark, base, known), "files") as files:
        result = insert_ignore_into(
            named_files(files).drop("modified"), bronze_path, table.schema, table.keys, table.order_by, table.partition_by
        )
        append(odd_files(files), rejects_path)
        append(files.select("path", "modified"), registry_path)
    return result


def upload_report(bronze: DataFrame, records: DataFrame) -> DataFrame:
    """Per provider, place and hour of ``records``: whether a write-once load writes it, its path, and why."""
    key = ("source", "place_name", "ingest_date", "ingest_hour")
    folder = F.concat_ws("_", F.col("ingest_date").cast("string"), "source", "place_name")
    file = F.concat(F.lpad(F.col("ingest_hour").cast("string"), 2, "0"), F.lit(".json"))
    return write_report(bronze, records, key).withColumn("path", F.concat_ws("/", folder, file))


def read_bronze_table(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BRONZE)


def bronze_hour(bronze: DataFrame, date: dt.date, hour: int) -> DataFrame:
    """Bronze rows of one hour."""
    return hour_slice(bronze, date, hour)


def provider_grid(locations: DataFrame, providers: Sequence[str]) -> DataFrame:
    """Every (source, place) pair that should deliver, from the location dimension."""
    return locations.select(
        F.explode(F.array(*[F.lit(name) for name in providers])).alias("source"), "place_name"
    )


def missing_pairs(bronze: DataFrame, grid: DataFrame, first: Column, last: Column) -> DataFrame:
    """Runs of hours in [first, last] that the grid expects and bronze does not have.

    One row per (source, place) and run: its first and last hour, and their number. Only hours
    that exist, and two marks around the bounds, are sorted per pair; absent hours are not made.
    """
    hour = F.expr("interval 1 hour")
    pair = ["source", "place_name"]
    stamp = clock.snapshot_ts(F.col("ingest_date"), F.col("ingest_hour"))
    had = bronze.select(*pair, stamp.alias("at")).where(F.col("at").between(first, last)).distinct()
    marks = grid.distinct().select(*pair, F.explode(F.array(first - hour, last + hour)).alias("at"))
    # A left semi join keeps pairs that nobody expects out.
    known = had.join(grid.select(*pair).distinct(), pair, "left_semi").union(marks)
    before = F.lag("at").over(Window.partitionBy(*pair).orderBy("at"))
    runs = known.withColumn("_before", before).where(F.col("at") > F.col("_before") + hour)
    return runs.select(
        *pair, (F.col("_before") + hour).alias("first_missing"), (F.col("at") - hour).alias("last_missing"),
    ).withColumn(
        "hours", (F.timestamp_diff("HOUR", F.col("first_missing"), F.col("last_missing")) + 1).cast("long")
    )
