"""Cleaning and validation of parsed forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.clock import instant_to_utc, wall_clock
from tidemark.functions.numbers import range_or_fill, to_number
from tidemark.operators.layout import conform
from tidemark.schemas import SILVER

# Accepted range of each numeric column, both ends included.
RANGES = {
    "temp_max": (-80.0, 70.0),
    "temp_min": (-80.0, 70.0),
    "temp_avg": (-80.0, 70.0),
    "humidity": (0.0, 100.0),
    "wind_speed": (0.0, 200.0),
    "wind_deg": (0.0, 360.0),
    "clouds": (0.0, 100.0),
    "precip_prob": (0.0, 100.0),
    "precipitation": (0.0, 1000.0),
    "rain": (0.0, 1000.0),
    "snow": (0.0, 1000.0),
}

TEXTS = ("api_name", "place_name", "weather_main", "weather_description", "weather_icon")


def _number(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_number(column)
    return column.cast("double")


def sun_time(value: Column, day: Column) -> Column:
    """Sunrise or sunset: date-time text as UTC, or a time of day on ``day``."""
    text = F.trim(value)
    clock_12h = F.try_to_timestamp(F.concat(day, F.lit(" "), F.upper(text)), F.lit("yyyy-MM-dd hh:mm a"))
    return (
        F.when(F.substring(text, 5, 1) == "-", instant_to_utc(text))
        .when(F.upper(F.right(text, F.lit(1))) == "M", clock_12h.cast("timestamp_ntz"))
        .when(text.rlike(r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"), wall_clock(F.concat(day, F.lit(" "), text)))
    )


def clean_silver(parsed: DataFrame, batch_id: str, fill: float = 0.0) -> DataFrame:
    """Clean parsed rows in one projection, without a shuffle.

    Numbers outside their range, unreadable or missing become ``fill``; a missing hour becomes
    0; dates and sun times that cannot be read become null; rows that are entirely null go.
    """
    present = set(parsed.columns)
    rows = parsed.dropna("all")

    day = F.col("forecast_date_utc")
    if isinstance(rows.schema["forecast_date_utc"].dataType, T.StringType):
        day = F.to_date(wall_clock(day))
    else:
        day = F.to_date(day)

    columns: dict[str, Column] = {name: F.col(name) for name in rows.columns}
    for name, (low, high) in RANGES.items():
        if name in present:
            columns[name] = range_or_fill(_number(rows, name), low, high, fill)
    for name in TEXTS:
        if name in present:
            columns[name] = F.col(name).cast("string")
    for name in ("sunrise", "sunset"):
        if name in present and isinstance(rows.schema[name].dataType, T.StringType):
            columns[name] = sun_time(F.col(name), day)
    columns["forecast_date_utc"] = day
    columns["forecast_hour_utc"] = F.coalesce(
        _number(rows, "forecast_hour_utc").try_cast("int"), F.lit(0)
    )
    columns["batch_id"] = F.lit(batch_id)
    return rows.select(*[column.alias(name) for name, column in columns.items()])


def _between(name: str, low: int, high: int) -> Column:
    return F.col(name).isNull() | F.col(name).between(low, high)


def silver_violations() -> Column:
    """Names of the table constraints a silver row breaks."""
    required = ("api_name", "place_name", "ingest_date", "ingest_hour", "forecast_date_utc")
    checks = [(f"{name}_null", F.col(name).isNull()) for name in required]
    checks += [
        ("ingest_hour_range", ~_between("ingest_hour", 0, 23)),
        ("forecast_hour_range", ~_between("forecast_hour_utc", 0, 23)),
        ("precip_prob_range", ~_between("precip_prob", 0, 100)),
        ("humidity_range", ~_between("humidity", 0, 100)),
    ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in checks]))


def check_constraints(rows: DataFrame) -> DataFrame:
    """Rows with the array ``violations``; empty on valid rows."""
    return rows.withColumn("violations", silver_violations())


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``violations``)."""
    checked = check_constraints(rows)
    valid = checked.where(F.size("violations") == 0).drop("violations")
    return valid, checked.where(F.size("violations") > 0)


def violation_rejects(checked: DataFrame) -> DataFrame:
    """Rows with violations in the layout of rejected records: names as reason, the row as JSON."""
    row = F.struct(*[F.col(name) for name in checked.columns if name != "violations"])
    return checked.where(F.size("violations") > 0).select(
        F.col("api_name").alias("source"),
        "place_name", "ingest_date", "ingest_hour",
        F.array_join("violations", ",").alias("reason"),
        F.to_json(row).alias("detail"),
    )


def clean_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, after and removed."""
    counts = before.agg(F.count("*").alias("rows_before"), F.lit(0).alias("rows_after")).unionByName(
        after.agg(F.lit(0).alias("rows_before"), F.count("*").alias("rows_after"))
    )
    return counts.agg(
        F.sum("rows_before").alias("rows_before"),
        F.sum("rows_after").alias("rows_after"),
        (F.sum("rows_before") - F.sum("rows_after")).alias("removed"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and approximate quartiles of every column."""
    return df.summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` if it has every declared column with the declared type, else raise."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, "
        f"found {actual[f.name].simpleString() if f.name in actual else 'no column'}"
        for f in expected.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("Schema mismatch: " + "; ".join(wrong))
    return df


def to_silver(cleaned: DataFrame) -> DataFrame:
    """Cleaned rows in the silver column order."""
    return conform(cleaned, SILVER)
