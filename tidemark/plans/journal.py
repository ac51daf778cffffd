"""Processing state of one level as an append-only log over stored rows.

A run logs its events as it goes and folds them into the stored rows once, at its end. Each
stored row holds the number of the last event folded; events up to that number count no more, so a
run that stops between the two steps of a compaction leaves nothing to be counted twice.
Runs of one level must not overlap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import merge, state as st
from tidemark.plans.lake import Lake
from tidemark.schemas import STATE, STATE_LOG, STATE_STORED
from tidemark.session import remove_folder, staged

FOLDER = ("processing_level",)


class Journal:
    def __init__(self, lake: Lake, level: str):
        self.spark, self.level = lake.spark, level
        self.rows, self.log = lake.path("processing_state"), lake.path("state_events")
        own = F.col("processing_level") == level
        self.stored = merge.read_table(self.spark, self.rows, STATE_STORED).where(own)
        logged = merge.read_table(self.spark, self.log, STATE_LOG).where(own)
        numbers = self.stored.agg(F.max("last_event").alias("n"), F.lit(0).alias("log")).union(
            logged.agg(F.max("seq"), F.lit(1))
        )
        last = {row.log: row.n for row in numbers.collect()}
        self.folded = -1 if last[0] is None else last[0]
        self.next = max(self.folded, -1 if last[1] is None else last[1]) + 1

    def _logged(self) -> DataFrame:
        logged = merge.read_table(self.spark, self.log, STATE_LOG)
        return logged.where((F.col("processing_level") == self.level) & (F.col("seq") > self.folded))

    def state(self) -> DataFrame:
        """State rows after all events logged so far."""
        return st.apply_state(self.stored.select(*STATE.names), self._logged(), F.lit(None).cast("timestamp_ntz"))

    def _numbered(self, now: dt.datetime, *steps: DataFrame) -> DataFrame:
        stamp = F.lit(now).cast("timestamp_ntz")
        events = st.in_order(*[step.withColumn("recorded_at", stamp) for step in steps], first=self.next)
        self.next += len(steps)
        return events

    def record(self, now: dt.datetime, *steps: DataFrame) -> None:
        """Append the events of consecutive steps to the log."""
        merge.append(self._numbered(now, *steps), self.log, FOLDER)

    def compact(self, now: dt.datetime, *steps: DataFrame) -> None:
        """Fold the log and the events of the last steps into the stored rows, then drop the log."""
        events = self._logged()
        if steps:
            events = events.unionByName(self._numbered(now, *steps))
        state = st.apply_state(self.stored.select(*STATE.names), events, F.lit(now).cast("timestamp_ntz"))
        with staged(state.withColumn("last_event", F.lit(self.next - 1).cast("bigint")), "state") as state:
            merge.replace_partitions(state, self.rows, FOLDER)
        remove_folder(self.spark, f"{self.log}/processing_level={self.level}")
