"""Hourly jobs: bronze to silver, silver to forecasts, forecasts to daily summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import rollups
from tidemark.operators.cleaning import clean_silver, split_valid, to_silver, violation_rejects
from tidemark.operators.merge import LoadResult
from tidemark.operators.parsers import accepted, rejected, tag_forecasts
from tidemark.plans.lake import Lake
from tidemark.session import stage, staged
from tidemark.sources import slices


def split_silver(tagged: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """(rows for the silver table, all rejects) of tagged forecasts.

    Rejects are records that could not be read and rows that break a constraint of the table;
    every tagged row is on one of the two sides.
    """
    valid, invalid = split_valid(to_silver(clean_silver(accepted(tagged), batch_id)))
    return valid, rejected(tagged).unionByName(violation_rejects(invalid))


def build_silver(lake: Lake, bronze: DataFrame, batch_id: str) -> tuple[LoadResult, DataFrame]:
    """Parse, clean and load bronze rows; also return the rejects.

    The tagged rows are written once: accepted and rejected rows both come from that table, which
    stays in the work folder for as long as the rejects are read.
    """
    valid, rejects = split_silver(stage(tag_forecasts(bronze), "tagged"), batch_id)
    return lake.load_copies("silver", valid), rejects


def build_forecasts(
    lake: Lake, target: dt.datetime, now: dt.datetime, start: dt.datetime | None = None
) -> dict[str, LoadResult]:
    """Daily and five-day forecasts of all snapshots after the watermark.

    A first run takes the whole silver table up to ``target``, or what follows ``start``. The
    increment is computed once.
    """
    job = "gold_daily_forecast"
    last = slices.last_processed(lake.read("watermarks"), job)
    silver = rollups.with_snapshot(
        lake.read_complete(
            "silver",
            ("ingest_date", "ingest_hour"),
            lambda table: slices.hourly_increment(table, last, target, start),
        )
    )
    generated = F.lit(now).cast("timestamp_ntz")
    with staged(silver, "increment") as silver:
        results = {
            "gold_daily_forecast": lake.load_copies(
                "gold_daily_forecast", rollups.daily_forecast(silver, generated)
            ),
            "gold_five_day_forecast": lake.load_copies(
                "gold_five_day_forecast", rollups.five_day_forecast(silver, generated_at=generated)
            ),
        }
        lake.save_watermark(job, silver, "snapshot_ts", now)
    return results


def build_daily(
    lake: Lake, target: dt.date, now: dt.datetime, start: dt.date | None = None
) -> LoadResult:
    """Daily summaries of the days after the watermark up to ``target``; a first run takes all
    days, or those from ``start`` on."""
    job = "gold_daily"
    last = slices.last_processed(lake.read("watermarks"), job)
    hourly = lake.read_complete(
        "gold_daily_forecast",
        "forecast_date_utc",
        lambda table: slices.daily_increment(table, "forecast_date_utc", last, target, start),
    )
    with staged(rollups.daily_summary(hourly, F.lit(now).cast("timestamp_ntz")), "daily") as summary:
        result = lake.load_copies("gold_daily", summary)
        lake.save_watermark(job, summary, "day", now)
    return result
