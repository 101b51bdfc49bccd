"""Snapshots of ticket states: per day, within a period, or as of target dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.dates import text_day
from ticketlens.skew import q


def _day(df: DataFrame, column: str = "valid_from") -> Column:
    return text_day(q(column)) if dict(df.dtypes)[column] == "string" else q(column).cast("date")


def _newest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest state per key set, as a pre-aggregated maximum; times in text are compared as points in time."""
    rest = [c for c in df.columns if c not in (*keys, "valid_from")]
    text = dict(df.dtypes)["valid_from"] == "string"
    moment = [F.try_to_timestamp(F.col("valid_from")).alias("moment")] if text else []
    best = df.groupBy(*keys).agg(F.max(F.struct(*moment, "valid_from", *[q(c) for c in rest])).alias("best"))
    return best.select(*keys, "best.valid_from", *[F.col("best")[c].alias(c) for c in rest])


def daily_last(states: DataFrame) -> DataFrame:
    """The last state per key and calendar day."""
    return _newest(states.withColumn("extract_date", _day(states)), ["key", "extract_date"])


def between_days(df: DataFrame, start: str | None = None, end: str | None = None, column: str = "extract_date") -> DataFrame:
    """Rows of the inclusive period; an open end does not bound."""
    if start:
        df = df.filter(q(column) >= F.lit(start).cast("date"))
    if end:
        df = df.filter(q(column) <= F.lit(end).cast("date"))
    return df


def asof(states: DataFrame, targets: Sequence[str], keep_target: bool = False) -> DataFrame:
    """Per key and target date the last state of the latest day on or before it; no state, no row.

    Each state falls to the first target it can serve; a later target without a
    state of its own takes the nearest earlier one. So a state is aggregated
    once, however many targets there are, and a key keeps one row per target.
    """
    days = sorted(set(targets))
    serves = F
    for i, d in enumerate(days):
        serves = serves.when(F.col("extract_date") <= F.lit(d).cast("date"), F.lit(i))
    dated = states.withColumn("extract_date", _day(states)).filter(F.col("extract_date") <= F.lit(days[-1]).cast("date"))
    best = _newest(dated.withColumn("slot", serves), ["key", "slot"])
    rest = [c for c in best.columns if c not in ("key", "slot")]
    slots = best.groupBy("key").agg(F.collect_list(F.struct("slot", *[q(c) for c in rest])).alias("slots"))
    wanted = F.array(
        *[F.struct(F.lit(t).cast("date").alias("target_date"), F.lit(days.index(t)).alias("slot")) for t in targets]
    )
    asked = slots.withColumn("wanted", F.explode(wanted))
    usable = F.filter("slots", lambda s: s["slot"] <= F.col("wanted.slot"))
    found = asked.select("key", "wanted.target_date", F.array_max(usable).alias("found")).filter(F.col("found").isNotNull())
    kept = ["target_date"] if keep_target else []
    return found.select("key", *kept, *[F.col("found")[c].alias(c) for c in rest])


def lead_columns(df: DataFrame, first: Sequence[str] = ("extract_date", "key")) -> DataFrame:
    """Leading columns first, the others as they are."""
    return df.select(*[q(c) for c in first], *[q(c) for c in df.columns if c not in first])
