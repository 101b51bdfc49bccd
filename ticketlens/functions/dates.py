"""Date expressions that return null instead of failing on bad text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, first that parses wins
ISO_LAYOUT = "^\\d{4}-\\d{2}-\\d{2}([T ].*)?$"
OTHER_LAYOUTS = ("d/M/yyyy", "d/MMM/yy")


def text_day(c: Column) -> Column:
    """Calendar day written in a timestamp text; the zone offset is ignored on purpose."""
    return F.substring(c, 1, 10).try_cast("date")


def date_or_null(c: Column) -> Column:
    """Day of a date-like text in any accepted layout, else null."""
    text = c.cast("string")
    iso = F.when(text.rlike(ISO_LAYOUT), text_day(text))
    others = [F.when(text.contains("/"), F.try_to_timestamp(text, F.lit(p)).cast("date")) for p in OTHER_LAYOUTS]
    return F.coalesce(iso, *others)


def day_of(c: Column, kind: str) -> Column:
    """Day of a column by its type name: text is parsed, dates and times are cast."""
    return date_or_null(c) if kind == "string" else c.cast("date")
