"""Tables of the lake: layout, keys and partitions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas
from tidemark.operators import merge
from tidemark.operators.layout import Month, conform, folder_names
from tidemark.session import staged
from tidemark.sources.slices import fallback_union


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    keys: tuple[str, ...]
    partition_by: tuple[str | Month, ...]
    order_by: tuple[str, ...]
    update_columns: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()


TABLES: dict[str, Table] = {
    "bronze": Table(
        schemas.BRONZE,
        ("source", "place_name", "ingest_date", "ingest_hour"),
        (Month("ingest_date"),),
        ("payload",),
    ),
    "silver": Table(
        schemas.SILVER, schemas.SILVER_KEY, (Month("ingest_date"),), ("original_ts", "temp_max"),
        nullable=("forecast_hour_utc",),
    ),
    # One run may cover several snapshots, so the snapshot belongs to the key.
    "gold_daily_forecast": Table(
        schemas.GOLD_FORECAST,
        ("place_name", "forecast_date_utc", "snapshot_ts"),
        (Month("forecast_date_utc"),),
        ("generated_at",),
    ),
    "gold_five_day_forecast": Table(
        schemas.GOLD_FORECAST,
        ("place_name", "forecast_date_utc", "ingest_date", "ingest_hour"),
        (Month("ingest_date"),),
        ("generated_at",),
    ),
    "gold_daily": Table(
        schemas.GOLD_DAILY, ("place_name", "forecast_date_utc"), (Month("forecast_date_utc"),), ("generated_at",),
    ),
    # Keyed on the Monday: two weeks of a calendar year can carry the same ISO number.
    "gold_weekly": Table(
        schemas.GOLD_WEEKLY, ("place_name", "week_start"), (Month("week_start", "year"),), ("generated_at",),
    ),
    "gold_monthly": Table(
        schemas.GOLD_MONTHLY,
        ("place_name", "year", "month_number"),
        ("year", "month_number"),
        ("generated_at",),
    ),
    "gold_seasonal": Table(
        schemas.GOLD_SEASONAL,
        ("place_name", "year", "season_name"),
        ("year", "season_name"),
        ("generated_at",),
        ("period_start", *schemas.MEASURES),
    ),
    "gold_yearly": Table(
        schemas.GOLD_YEARLY,
        ("place_name", "year_start", "period_type"),
        ("year_start",),
        ("updated_at",),
        schemas.MEASURES,
    ),
    "processing_state": Table(
        schemas.STATE, ("processing_level", "partition_date"), ("processing_level",), ("updated_at",),
    ),
    # One row per place and period, from which late rows are added up without reading the others again.
    "gold_partials": Table(
        schemas.PARTIAL, ("level", "period_start", "place_name"), ("level", Month("period_start", "year")), ("parts",),
        tuple(name for name in schemas.PARTIAL.names if name not in ("level", "period_start", "place_name")),
    ),
    "watermarks": Table(
        schemas.WATERMARK,
        ("job_name",),
        ("job_name",),
        ("last_processed_ts",),
        ("last_processed_ts", "updated_at"),
    ),
}


@dataclass(frozen=True)
class Lake:
    """Tables below ``base``; a second base holds the fallback copy of the gold tables."""

    spark: SparkSession
    base: str
    fallback: str | None = None

    def path(self, name: str, fallback: bool = False) -> str:
        base = self.fallback if fallback else self.base
        return f"{base.rstrip('/')}/{name}"

    def read(self, name: str, fallback: bool = False) -> DataFrame:
        return merge.read_table(self.spark, self.path(name, fallback), TABLES[name].schema)

    def scan(self, name: str, fallback: bool = False) -> DataFrame:
        """The table with its folder columns, by which the slices prune whole months."""
        table = TABLES[name]
        return merge.read_table(self.spark, self.path(name, fallback), table.schema, table.partition_by)

    def read_complete(
        self, name: str, column: str | Sequence[str], keep: Callable[[DataFrame], DataFrame] = lambda df: df
    ) -> DataFrame:
        """Rows ``keep`` selects, completed with partitions that only the fallback copy has.

        Partitions are values of ``column``, and ``keep`` decides by them alone. What the table itself
        covers is read from these columns and the files ``keep`` leaves.
        """
        names = TABLES[name].schema.names
        primary = keep(self.scan(name)).select(*names)
        if self.fallback is None:
            return primary
        columns = [column] if isinstance(column, str) else list(column)
        covered = primary.select(*columns).distinct()
        return fallback_union(primary, keep(self.scan(name, fallback=True)).select(*names), column, covered)

    def revise(self, name: str, batch: DataFrame, columns: Sequence[str]) -> merge.LoadResult:
        """Upsert ``columns`` in all copies, also where a load as such ignores known keys."""
        table = TABLES[name]
        with staged(conform(batch, table.schema), name) as batch:
            results = [
                merge.upsert_into(
                    batch, self.path(name, fallback), table.schema, table.keys, columns, table.order_by,
                    table.partition_by, stored=True,
                )
                for fallback in ([False] if self.fallback is None else [False, True])
            ]
        return results[0]

    def load(
        self, name: str, batch: DataFrame, fallback: bool = False, stored: bool = False
    ) -> merge.LoadResult:
        """Upsert where the table has columns to update, else insert-ignore."""
        table, path = TABLES[name], self.path(name, fallback)
        if table.update_columns:
            return merge.upsert_into(
                batch, path, table.schema, table.keys, table.update_columns, table.order_by, table.partition_by, stored,
            )
        return merge.insert_ignore_into(
            batch, path, table.schema, table.keys, table.order_by, table.partition_by, table.nullable, stored,
        )

    def _into_copies(self, name: str, batch: DataFrame) -> list[merge.LoadResult | Exception]:
        table = TABLES[name]
        return merge.insert_ignore_copies(
            batch, [self.path(name), self.path(name, fallback=True)], table.schema, table.keys, table.order_by,
            table.partition_by, table.nullable,
        )

    def load_copies(self, name: str, batch: DataFrame) -> merge.LoadResult:
        """Load into the table, and into its fallback copy if there is one; the first error is raised."""
        if self.fallback is None:
            return self.load(name, batch)
        if not TABLES[name].update_columns:
            results = self._into_copies(name, batch)
            for result in results:
                if isinstance(result, Exception):
                    raise result
            return results[0]
        with staged(batch, name) as batch:
            result = self.load(name, batch, stored=True)
            self.load(name, batch, fallback=True, stored=True)
        return result

    def load_both(self, name: str, batch: DataFrame) -> tuple[str | None, str | None]:
        """Load into the table and its fallback copy; for each of them null, or why it failed.

        The batch is computed once and read twice. Errors of Spark and of the file system count
        as a sink's failure; any other error is a fault of the program and is raised.
        """
        def cause(error: Exception) -> str:
            return f"{type(error).__name__}: {error}"

        if self.fallback is not None and not TABLES[name].update_columns:
            first, second = self._into_copies(name, batch)
            return tuple(cause(x) if isinstance(x, Exception) else None for x in (first, second))
        outcome: list[str | None] = []
        with staged(batch, name) as batch:
            for fallback in (False, True):
                if fallback and self.fallback is None:
                    outcome.append("no fallback copy")
                    continue
                try:
                    self.load(name, batch, fallback, stored=True)
                    outcome.append(None)
                except merge.SINK_ERRORS as error:
                    outcome.append(cause(error))
        return outcome[0], outcome[1]

    def differing(self, name: str) -> DataFrame:
        """Folders of a table whose rows differ between its two copies."""
        names = folder_names(TABLES[name].partition_by)
        return merge.differing(self.scan(name), self.scan(name, fallback=True), names)

    def repair(self, name: str, fallback: bool) -> merge.LoadResult:
        """Bring one copy up to the other: load what that one has in the folders where they differ.

        Fingerprints of the folders are compared, one row for each; only rows of folders that differ
        are read whole and loaded, as by any load.
        """
        table = TABLES[name]
        sound = self.scan(name, not fallback)
        with staged(self.differing(name), "differing") as folders:
            rows = merge.narrowed_rows(sound, folders, folders.columns).select(*table.schema.names)
            with staged(rows, name) as rows:
                return self.load(name, rows, fallback, stored=True)

    def save_watermark(self, job: str, rows: DataFrame, column: str, now) -> None:
        """Advance a job's watermark to the newest ``column`` in ``rows``; nothing written, no change."""
        newest = rows.agg(F.max(column).alias("last_processed_ts")).where(
            F.col("last_processed_ts").isNotNull()
        )
        self.load(
            "watermarks",
            newest.select(
                F.lit(job).alias("job_name"),
                F.col("last_processed_ts").cast("timestamp_ntz").alias("last_processed_ts"),
                F.lit(now).cast("timestamp_ntz").alias("updated_at"),
            ),
        )
