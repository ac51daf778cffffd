"""Profiles of tables from sketches per day that can be merged over any range of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Size of the quantile sketch: ranks are off by less than two hundredths (99 % of the time).
RANKS = 200
#: Binary logarithm of the registers of the distinct sketch: a standard error of 1.6 %.
REGISTERS = 12
RANK_ERROR, DISTINCT_ERROR = 0.02, 0.05


def day_sketches(rows: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """Per day and column: rows, nulls, extremes, and sketches of the quantiles and the distinct values.

    One aggregate over the rows, whose tasks send a row per day; a day's sketches are a few kilobytes a column. Days
    that come later add rows, and no day has to be read again. NaN counts as null.
    """
    values = rows.select(day, *[F.nanvl(F.col(name).cast("double"), F.lit(None)).alias(name) for name in columns])
    sketches = [
        F.struct(
            F.lit(name).alias("column_name"), F.count("*").alias("rows"), F.count_if(F.col(name).isNull()).alias("nulls"),
            F.min(name).alias("minimum"), F.max(name).alias("maximum"),
            F.kll_sketch_agg_double(name, F.lit(RANKS)).alias("ranks"),
            F.hll_sketch_agg(F.xxhash64(name), REGISTERS).alias("distinct"),
        ).alias(name)
        for name in columns
    ]
    return values.groupBy(day).agg(*sketches).select(F.col(day).alias("day"), F.inline(F.array(*columns)))


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profile per column of all days of ``sketches``; quantiles and distinct values within the sketches' error.

    The hash of null is one distinct value where there are nulls; it is taken off.
    """
    merged = sketches.groupBy("column_name").agg(
        F.count("*").alias("days"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"),
        F.kll_merge_agg_double("ranks").alias("ranks"), F.hll_union_agg("distinct").alias("distinct"),
    )
    some = F.col("rows") > F.col("nulls")
    return merged.select(
        "column_name", "days", "rows", "nulls", "minimum", "maximum",
        *[
            F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(f"p{round(100 * q)}")
            for q in quantiles
        ],
        (F.hll_sketch_estimate("distinct") - F.when(F.col("nulls") > 0, 1).otherwise(0)).alias("distinct_values"),
    )
