"""Field normalisers by rule name: Column to Column, for ticket fields and for change values.

A user rule is added to RULES; `member` tells which struct member a raw ticket
field must have for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketlens.functions.text import plain_text, sorted_joined, sorted_words

SECONDS_PER_DAY = 86_400


def _members(c: Column, member: str) -> Column:
    return sorted_joined(F.transform(c, lambda x: x[member]))


def days(seconds: Column, per_day: int = SECONDS_PER_DAY) -> Column:
    """Seconds to days, 0 for an absent or blank value."""
    return F.coalesce(seconds.try_cast("double") / F.lit(per_day), F.lit(0.0))


RULES: dict[str, Callable[[Column], Column]] = {
    "": lambda c: c,
    "text": plain_text,
    "name": lambda c: c["name"],
    "value": lambda c: c["value"],
    "key": lambda c: c["key"],
    "display_name": lambda c: plain_text(c["displayName"]),
    "email": lambda c: F.lower(c["emailAddress"]),
    "names": lambda c: _members(c, "name"),
    "values": lambda c: _members(c, "value"),
    "strings": sorted_joined,
    "words": sorted_words,
    "float": lambda c: c.try_cast("double"),
    "int": lambda c: c.try_cast("int"),
    "days": days,
    "spent_days": lambda c: days(c["timeSpentSeconds"]),
    "remaining_days": lambda c: days(c["remainingEstimateSeconds"]),
}

# type of the raw ticket field each rule reads
RAW_TYPES = {
    "name": "struct<name:string>",
    "value": "struct<value:string>",
    "key": "struct<key:string>",
    "names": "array<struct<name:string>>",
    "values": "array<struct<value:string>>",
    "strings": "array<string>",
    "days": "bigint",
    "display_name": "struct<displayName:string,emailAddress:string>",
    "remaining_days": "struct<timeSpentSeconds:bigint,remainingEstimateSeconds:bigint>",
}


#: The rules that turn seconds into days.
DAY_RULES: dict[str, Callable[[Column], Column]] = {
    "days": lambda c: c, "spent_days": lambda c: c["timeSpentSeconds"], "remaining_days": lambda c: c["remainingEstimateSeconds"],
}


def apply_rule(rule: str | None, c: Column, seconds_per_day: int = SECONDS_PER_DAY) -> Column:
    """The value by a rule; days have `seconds_per_day` (a working day may have fewer than 24 hours)."""
    if rule in DAY_RULES:
        return days(DAY_RULES[rule](c), seconds_per_day)
    return RULES[rule or ""](c)
