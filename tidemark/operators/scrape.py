"""Tables from stored web pages.

Pages come as a table (url, html); a layout names, for each field, the path of elements that
leads to its text. All work is done with built-in expressions on whole pages.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import (
    after_opening, before_closing, capitalise, element_content, element_text, first_digits,
    split_date, visible_html,
)
from tidemark.operators.cleaning import assert_schema
from tidemark.schemas import SCRAPED_IN, SCRAPED_OUT

# A step is (tag,) or (tag, attribute, value).
Path = tuple[tuple[str, ...], ...]

# Where each site shows its fields.
LAYOUTS: dict[str, dict[str, Path]] = {
    "meteoblue": {
        "city": (("a", "class", "home"), ("span", "itemprop", "name")),
        "curr_time": (("div", "class", "current-description"),),
        "temperature": (("div", "class", "h1 current-temp"),),
    },
    "sinoptik": {
        "city": (("h1", "class", "currentCity"),),
        "curr_day": (("span", "class", "wfNonCurrentDate"),),
        "curr_time": (("span", "class", "time"),),
        "temperature": (("span", "class", "wfCurrentTemp"),),
        "weather": (("div", "class", "wfCurrentWindContainer"),),
        "wind_m_s": (("span", "class", "wfCurrentWind"),),
    },
    "accuweather": {
        "city": (("h1", "class", "header-loc"),),
        "curr_day": (("div", "class", "content-module subnav-pagination"),),
        "curr_time": (("p", "class", "sub"),),
        "temperature": (("div", "class", "display-temp"),),
        "weather": (("div", "class", "phrase"),),
        "wind_km_h": (("div", "class", "detail-item spaced-content"),),
    },
}

# Change of a field's text before it enters the table.
SHAPES: dict[str, dict[str, Callable[[Column], Column]]] = {
    "meteoblue": {"temperature": first_digits},
    "sinoptik": {
        "city": capitalise, "curr_day": capitalise, "temperature": first_digits, "wind_m_s": first_digits,
    },
    "accuweather": {
        "city": capitalise, "curr_day": capitalise, "temperature": first_digits, "wind_km_h": first_digits,
    },
}


def extract_fields(
    pages: DataFrame,
    layout: Mapping[str, Path],
    shapes: Mapping[str, Callable[[Column], Column]] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per page with the layout's fields; a field the page lacks is null."""
    shapes = shapes or {}
    rows = pages.select(*keep, visible_html(F.col("html")).alias("_html"))
    inner = {name: "_html" for name in layout}
    # Each part of a step is a column of its own and so is computed once.
    for depth in range(max(len(path) for path in layout.values())):
        steps = {name: path[depth] for name, path in layout.items() if depth < len(path)}
        rows = rows.withColumns(
            {f"_rest_{name}": after_opening(F.col(inner[name]), *step) for name, step in steps.items()}
        )
        rows = rows.withColumns(
            {
                f"_head_{name}": before_closing(F.col(f"_rest_{name}"), step[0])
                for name, step in steps.items()
            }
        )
        rows = rows.withColumns(
            {
                f"_inner_{name}": element_content(F.col(f"_rest_{name}"), F.col(f"_head_{name}"), step[0])
                for name, step in steps.items()
            }
        )
        inner.update({name: f"_inner_{name}" for name in steps})
    texts = rows.withColumns({name: element_text(F.col(inner[name])) for name in layout})
    return texts.select(
        *keep, *[shapes.get(name, lambda value: value)(F.col(name)).alias(name) for name in layout]
    )


def scrape_site(pages: DataFrame, site: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw observation table of a site, in its declared input columns."""
    return extract_fields(pages, LAYOUTS[site], SHAPES[site], keep)


def _accuweather(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_date", split_date(F.col("curr_day"))).withColumns(
        {
            "weekday": F.col("_date.weekday"),
            "curr_day": F.col("_date.day"),
            "curr_month": F.col("_date.month"),
            "city": F.split("city", ",")[0],
            "temperature": F.col("temperature").try_cast("bigint"),
            # Kilometres per hour to whole metres per second.
            "wind_m_s": F.floor(F.col("wind_km_h").try_cast("bigint") * F.lit(0.2777)),
        }
    )


def _meteoblue(rows: DataFrame) -> DataFrame:
    return rows.withColumn("temperature", F.col("temperature").try_cast("bigint"))


def _sinoptik(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_date", split_date(F.col("curr_day"))).withColumns(
        {
            "curr_day": F.col("_date.day"),
            "curr_month": F.col("_date.month"),
            "temperature": F.col("temperature").try_cast("bigint"),
            "wind_m_s": F.col("wind_m_s").try_cast("bigint"),
        }
    )


TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "accuweather": _accuweather,
    "meteoblue": _meteoblue,
    "sinoptik": _sinoptik,
}


def transform_site(rows: DataFrame, site: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed observation table of a site. Input and output are checked against their declared schemas."""
    assert_schema(rows, SCRAPED_IN[site])
    result = TRANSFORMS[site](rows).select(*keep, *SCRAPED_OUT[site].names)
    return assert_schema(result, SCRAPED_OUT[site])


def split_readable(rows: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with every declared field, rows where a field is missing or could not be read)."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields])
    )
    # A filter stops at a generator; below it, it would repeat the whole extraction.
    checked = rows.select("*", F.inline(F.array(F.struct(missing.alias("missing_fields")))))
    readable = F.size("missing_fields") == 0
    return checked.where(readable).drop("missing_fields"), checked.where(~readable)
