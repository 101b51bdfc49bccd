"""Text and tag expressions. Every function maps Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "#"


def blank_as_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def literal_split(c: Column, sep: str) -> Column:
    """Split on the literal separator, not on a pattern."""
    return F.split(c, "\\Q" + sep + "\\E")


def tags(c: Column, sep: str = SEPARATOR) -> Column:
    """Trimmed, non-blank tokens; empty array for null."""
    parts = literal_split(F.coalesce(c.cast("string"), F.lit("")), sep)
    return F.filter(F.transform(parts, lambda t: F.trim(t)), lambda t: t != "")


def tag_count(c: Column, sep: str = SEPARATOR) -> Column:
    return F.size(tags(c, sep))


def slug(c: Column) -> Column:
    """Letters, digits, '-' and '_' stay, others become '_'; outer '_' cut; lower case."""
    safe = F.regexp_replace(c, "[^\\p{L}\\p{N}_-]", "_")
    return F.lower(F.regexp_replace(safe, "^_+|_+$", ""))


def plain_text(c: Column) -> Column:
    """Commas become blanks, double quotes go."""
    return F.translate(c, ',"', " ")


def sorted_joined(items: Column, sep: str = SEPARATOR) -> Column:
    """Sorted, joined array; null for an empty one."""
    return F.when(F.size(items) > 0, F.array_join(F.sort_array(items), sep))


def sorted_words(c: Column, sep: str = SEPARATOR) -> Column:
    """Words split on blanks, sorted, joined; null stays null."""
    words = F.filter(F.split(c, "\\s+"), lambda w: w != "")
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).otherwise(
        F.array_join(F.sort_array(words), sep)
    )
