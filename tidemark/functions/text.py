"""Text column expressions for names and scraped pages."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def strip(text: Column) -> Column:
    """Remove white space of any kind, no-break space too, at both ends."""
    return F.regexp_replace(text, r"^[\s ]+|[\s ]+$", "")


def first_digits(text: Column) -> Column:
    """The first run of digits, without a sign; null when there is none."""
    return F.nullif(F.regexp_extract(text, "[0-9]+", 0), F.lit(""))


def capitalise(text: Column) -> Column:
    """First character upper case, all others lower case."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def canonical_source(source: Column) -> Column:
    """Provider name without blanks around it and without the ``_api`` ending."""
    return F.regexp_replace(F.trim(source), "_api$", "")


def split_date(text: Column) -> Column:
    """Struct (weekday, day, month) from ``weekday day month`` or ``day month``.

    Parts are separated by blanks, commas or semicolons. Any other number of parts gives nulls.
    """
    parts = F.split(text, r"[,\s;]+")
    count = F.size(parts)
    day = F.when(count == 3, parts[1]).when(count == 2, parts[0])
    return F.struct(
        F.when(count == 3, parts[0]).alias("weekday"),
        day.try_cast("bigint").alias("day"),
        F.when(count == 3, parts[2]).when(count == 2, parts[1]).alias("month"),
    )


# Opening and closing marks of what a reader does not see.
_HIDDEN = (("<!--", "-->"), (r"<script\b", r"</script\s*>"), (r"<style\b", r"</style\s*>"))
# Two code points that are no characters: no page holds them.
_MUTE = "\ufdd0\ufdd1"


def visible_html(html: Column) -> Column:
    """The page without comments, scripts and styles; what is opened and never closed stays.

    Openings behind the last closing of their kind are muted first, so that the one pass that removes
    the others never runs to the end of the page in vain: the cost is linear in the page.
    """
    page = html
    for opening, closing in _HIDDEN:
        closed = F.regexp_extract(page, rf"(?is)^(.*{closing})", 1)
        rest = F.substr(page, F.char_length(closed) + 1)
        page = F.concat(closed, F.regexp_replace(rest, rf"(?i)<(?={opening[1:]})", f"<{_MUTE}"))
    seen = F.regexp_replace(page, "(?is)" + "|".join(f"{o}.*?{c}" for o, c in _HIDDEN), "")
    return F.replace(seen, F.lit(_MUTE), F.lit(""))


def _attribute(name: str, value: str) -> str:
    quoted = re.escape(value)
    if name == "class" and " " not in value:
        # One of several classes of the element.
        return rf"""(?:"(?:[^"]*\s)?{quoted}(?:\s[^"]*)?"|'(?:[^']*\s)?{quoted}(?:\s[^']*)?')"""
    return rf"""(?:"{quoted}"|'{quoted}')"""


def after_opening(html: Column, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """The page after the first ``<tag attribute="value">``; null when it has no such element."""
    opening = rf"<{tag}(?=[\s>])[^>]*>"
    if attribute is not None:
        opening = rf"<{tag}\s(?:[^>]*?\s)?{attribute}\s*=\s*{_attribute(attribute, value)}[^>]*>"
    return F.nullif(F.regexp_extract(html, rf"(?is){opening}(.*)", 1), F.lit(""))


def before_closing(rest: Column, tag: str) -> Column:
    """``rest`` up to the first closing tag."""
    return F.substring_index(rest, f"</{tag}>", 1)


def element_content(rest: Column, head: Column, tag: str) -> Column:
    """Content of the element that was opened before ``rest``, nested same-name elements included.

    ``head`` comes from ``before_closing`` and is the content unless a tag of the name occurs in
    it. Then ``rest`` is cut at every such tag. A fold over the pieces holds three numbers: the
    depth, the number of pieces seen, and the piece that closes the element; the pieces before
    that one are joined once. The cost is linear in the page.
    """
    pieces = F.split(rest, rf"(?is)(?=</?{tag}[\s>])")
    closing, opening = f"</{tag}", f"<{tag}"

    def step(seen: Column, piece: Column) -> Column:
        start = F.lower(F.left(piece, F.lit(len(closing))))
        change = F.when(start == closing, -1).when(F.startswith(start, F.lit(opening)), 1).otherwise(0)
        depth = seen.depth + change
        closes = seen.end.isNull() & (depth < 0)
        return F.struct(
            depth.alias("depth"), (seen.count + 1).alias("count"),
            F.when(closes, seen.count).otherwise(seen.end).alias("end"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("count"), F.lit(None).cast("int").alias("end"))
    cut = F.when(head.rlike(rf"(?i)</?{tag}[\s>]"), pieces)
    folded = F.aggregate(cut, start, step, lambda seen: F.coalesce(seen.end, seen.count))
    return F.coalesce(F.array_join(F.slice(cut, 1, folded), ""), head)


# The character references that occur in the pages' texts.
ENTITIES = {
    "&nbsp;": "\u00a0",
    "&deg;": "\u00b0",
    "&quot;": '"',
    "&apos;": "'",
    "&#39;": "'",
    "&lt;": "<",
    "&gt;": ">",
    "&amp;": "&",
}


def element_text(inner: Column) -> Column:
    """Text of an element: tags removed, common character references resolved, ends trimmed."""
    text = F.regexp_replace(inner, "<[^>]*>", "")
    resolved = text
    for reference, character in ENTITIES.items():
        resolved = F.replace(resolved, F.lit(reference), F.lit(character))
    return strip(F.when(text.contains("&"), resolved).otherwise(text))
