"""Calendar and time-zone column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GRAINS = ("hour", "day", "week", "month", "season", "year")


def check_grain(grain: str) -> None:
    if grain not in GRAINS:
        raise ValueError(f"Unsupported grain: {grain}")


def season_start(day: Column) -> Column:
    """First day of the meteorological season: 1 March, June, September or December.

    Seasons are quarters moved back by one month.
    """
    return F.add_months(F.trunc(F.add_months(day, 1), "quarter"), -1)


def season_name(day: Column) -> Column:
    names = F.array(*[F.lit(name) for name in ("winter", "spring", "summer", "autumn")])
    return names[F.quarter(F.add_months(day, 1)) - 1]


def season_year(day: Column) -> Column:
    """December belongs to the winter of the next year."""
    return F.year(F.add_months(day, 1))


def season_months(start: Column) -> Column:
    """The three month starts of the season that begins on ``start``."""
    return F.sequence(start, F.add_months(start, 2), F.expr("interval 1 month"))


def grain_start(moment: Column, grain: str) -> Column:
    """Start of the hour (timestamp) or of the day, week, month, season or year (date)."""
    check_grain(grain)
    if grain == "hour":
        return F.date_trunc("hour", moment).cast("timestamp_ntz")
    if grain == "day":
        return F.to_date(moment)
    if grain == "season":
        return season_start(F.to_date(moment))
    return F.trunc(F.to_date(moment), grain)


def grain_step(start: Column, grain: str, steps: int = 1) -> Column:
    """``start`` moved by a number of whole grains."""
    check_grain(grain)
    if grain == "hour":
        return start + F.make_dt_interval(hours=F.lit(steps))
    if grain == "day":
        return F.date_add(start, steps)
    if grain == "week":
        return F.date_add(start, 7 * steps)
    months = {"month": 1, "season": 3, "year": 12}[grain]
    return F.add_months(start, months * steps)


def grain_interval(grain: str) -> str:
    """The step of a grain as an interval literal for ``sequence``."""
    check_grain(grain)
    return {
        "hour": "interval 1 hour",
        "day": "interval 1 day",
        "week": "interval 7 days",
        "month": "interval 1 month",
        "season": "interval 3 months",
        "year": "interval 12 months",
    }[grain]


def period_label(start: Column, grain: str) -> Column:
    """Readable period name: day_193_2026, week_28_2026, july_2026, winter_2027."""
    check_grain(grain)
    year = F.year(start)
    if grain == "day":
        return F.concat(F.lit("day_"), F.dayofyear(start), F.lit("_"), year)
    if grain == "week":
        return F.concat(F.lit("week_"), F.weekofyear(start), F.lit("_"), year)
    if grain == "month":
        return F.concat(F.lower(F.date_format(start, "MMMM")), F.lit("_"), year)
    if grain == "season":
        return F.concat(season_name(start), F.lit("_"), season_year(start))
    if grain == "year":
        return F.concat(F.lit("year_"), year)
    return F.lit(None).cast("string")


def partition_path(start: Column, grain: str) -> Column:
    """Folder text of a period: 2026/07/12, 2026/W28, 2026/07, 2027/winter_2027, 2026/2026."""
    check_grain(grain)
    if grain == "hour":
        return F.date_format(start, "yyyy/MM/dd/HH")
    if grain == "day":
        return F.date_format(start, "yyyy/MM/dd")
    if grain == "week":
        week = F.lpad(F.weekofyear(start).cast("string"), 2, "0")
        return F.concat(F.date_format(start, "yyyy"), F.lit("/W"), week)
    if grain == "month":
        return F.date_format(start, "yyyy/MM")
    if grain == "season":
        year = season_year(start).cast("string")
        return F.concat(year, F.lit("/"), season_name(start), F.lit("_"), year)
    return F.date_format(start, "yyyy/yyyy")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def iso_year(day: Column) -> Column:
    """Year of the Thursday in the same week."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def first_iso_week(year: Column) -> Column:
    """Monday of ISO week 1: the week that holds 4 January."""
    return F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")


def snapshot_ts(date: Column, hour: Column) -> Column:
    """Hour of a snapshot from its ingest date and hour."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


def wall_clock(text: Column) -> Column:
    """Date or date-time text to a timestamp without zone; null when it is neither."""
    return text.try_cast("timestamp_ntz")


def instant_to_utc(text: Column) -> Column:
    """Date-time text with an offset to UTC wall-clock time; text without an offset is UTC.

    Text that does not start with a year, such as a time of day, is null: a cast would read it
    as a time of today.
    """
    zoned = text.rlike(r"(?:[zZ]|[0-9:.]{4}[+-][0-9:]{2,6})$")
    return F.when(F.substring(text, 5, 1) != "-", None).when(
        zoned, instant_utc(text.try_cast("timestamp"))
    ).otherwise(wall_clock(text))


def zone_to_utc(local: Column, zone: Column) -> Column:
    """Wall-clock time in a named zone to UTC wall-clock time; null for an unknown zone.

    Reading the text of both as one timestamp is the conversion that does not raise on a zone
    this machine does not know.
    """
    return instant_utc(F.concat(iso_text(local), F.lit(" "), zone).try_cast("timestamp"))


def offset_to_utc(local: Column, seconds: Column) -> Column:
    """Wall-clock time at a fixed offset east of UTC to UTC wall-clock time."""
    return local - F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def iso_text(local: Column) -> Column:
    return F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")


def offset_text(seconds: Column) -> Column:
    """Offset east of UTC as +HH:MM."""
    size = F.abs(seconds).cast("int")
    return F.concat(
        F.when(seconds < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 3600).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad(F.floor(size % 3600 / 60).cast("string"), 2, "0"),
    )


def offset_seconds(local: Column, utc: Column) -> Column:
    """Seconds that ``local`` is ahead of ``utc``."""
    return F.timestamp_diff("SECOND", utc, local)


def utc_instant(utc: Column) -> Column:
    """UTC wall-clock time to the TIMESTAMP of that instant, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")


def instant_utc(instant: Column) -> Column:
    """TIMESTAMP to UTC wall-clock time."""
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))
