"""Column order, missing columns and null markers before a load; folders of stored tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Month:
    """A folder per month (or year) of a date column. Rows are sorted by the date inside the folder's files."""

    column: str
    grain: str = "month"

    @property
    def name(self) -> str:
        return f"{self.column}_{self.grain}"


def folder_names(partition_by: Sequence[str | Month]) -> list[str]:
    """Columns that name the folders."""
    return [part.name if isinstance(part, Month) else part for part in partition_by]


def folder_sources(partition_by: Sequence[str | Month]) -> list[str]:
    """Columns of the table that its folders follow from."""
    return [part.column if isinstance(part, Month) else part for part in partition_by]


def derived_folders(partition_by: Sequence[str | Month]) -> list[str]:
    """Folder columns that are no columns of the table."""
    return [part.name for part in partition_by if isinstance(part, Month)]


def with_folders(df: DataFrame, partition_by: Sequence[str | Month]) -> DataFrame:
    """``df`` and the folder columns that follow from others."""
    return df.withColumns(
        {part.name: F.trunc(part.column, part.grain) for part in partition_by if isinstance(part, Month)}
    )


def within_months(
    table: DataFrame, column: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """``table`` without the folders of months (years) outside [first, last], where it has folders by ``column``.

    Only folders are pruned; the caller's own condition on the date stays what it is.
    """
    for grain, start in (("month", {"day": 1}), ("year", {"month": 1, "day": 1})):
        folder = Month(column, grain).name
        if folder in table.columns:
            if first is not None:
                table = table.where(F.col(folder) >= F.lit(first.replace(**start)))
            if last is not None:
                table = table.where(F.col(folder) <= F.lit(last.replace(**start)))
    return table


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; columns ``df`` lacks are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def blank_nat(df: DataFrame) -> DataFrame:
    """Null instead of the text ``NaT`` in string columns."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("NaT")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
