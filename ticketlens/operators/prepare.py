"""From a snapshot panel to a labelled training table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.dates import day_of
from ticketlens.functions.labels import cap_label, to_quarters
from ticketlens.functions.text import literal_split
from ticketlens.skew import HOT_ROWS, lookup_join, q

# a calendar up to this size is a constant in the plan, a larger one is joined
CALENDAR_CONSTANT = 1_000


@dataclass(frozen=True)
class PrepareConfig:
    # Statuses and level of finished tickets, first snapshot day, limits
    finished_statuses: tuple[str, ...] = (
        "Accepted", "Completed", "Development Completed", "Done", "E2E Validated for Community",
    )
    level: str = "ART Epic"
    since: str = "2022-01-01"
    max_null_share: float = 0.95
    quarter_days: int = 90
    top_class: int = 8
    roadmap_separators: tuple[str, ...] = (",", "#")
    version_separators: tuple[str, ...] = ("#",)


# Release tokens that never count
IGNORED_TOKEN = "to_plan"
IGNORED_PART = "hit-pi"


def release_tokens(c: Column, separators: Sequence[str]) -> Column:
    """Trimmed tokens between any of the separators; null stays null."""
    text = c.cast("string")
    for s in separators[:-1]:
        text = F.replace(text, F.lit(s), F.lit(separators[-1]))
    return F.transform(literal_split(text, separators[-1]), lambda t: F.trim(t))


def _counts(token: Column) -> Column:
    return (token != IGNORED_TOKEN) & ~token.contains(IGNORED_PART)


def one_per_release(releases: DataFrame) -> DataFrame:
    """release and dev_cutoff; of a release listed more than once the latest day counts."""
    return releases.filter("release IS NOT NULL").groupBy("release").agg(F.max("dev_cutoff").alias("dev_cutoff"))


def calendar(releases: DataFrame) -> dict | DataFrame:
    """A small calendar as a dict, to become a constant in the plan; a larger one stays a table. Both give the same days."""
    rows = one_per_release(releases).limit(CALENDAR_CONSTANT + 1).collect()
    return {r.release: r.dev_cutoff for r in rows} if len(rows) <= CALENDAR_CONSTANT else releases


def release_date(
    df: DataFrame, column: str, releases: dict | DataFrame, separators: Sequence[str], how: str, into: str
) -> DataFrame:
    """Adds the first (`how` = min) or last (max) cut-off day of the releases named in a text."""
    if isinstance(releases, dict):
        if not releases:
            return df.withColumn(into, F.lit(None).cast("date"))
        days = F.create_map(*[F.lit(x) for pair in releases.items() for x in pair])
        known = F.filter(release_tokens(q(column), separators), _counts)
        dates = F.transform(known, lambda t: F.try_element_at(days, t))
        return df.withColumn(into, (F.array_min if how == "min" else F.array_max)(dates).cast("date"))
    # a table: look up the distinct texts, then join them back
    texts = df.select(q(column).alias("release_text")).filter("release_text IS NOT NULL").distinct()
    named = texts.withColumn("release", F.explode(F.array_distinct(release_tokens(F.col("release_text"), separators))))
    pick = F.min if how == "min" else F.max
    found = (
        lookup_join(named.filter(_counts(F.col("release"))), one_per_release(releases), ["release"], "inner")
        .groupBy("release_text").agg(pick("dev_cutoff").cast("date").alias(into))
    )
    return lookup_join(df.withColumn("release_text", q(column)), found, ["release_text"]).drop("release_text")


def unknown_releases(df: DataFrame, columns: dict[str, Sequence[str]], releases: DataFrame) -> DataFrame:
    """Tokens without a usable release, with their number of uses."""
    per_column = [F.explode(F.concat(*[
        F.coalesce(release_tokens(q(c), seps), F.array().cast("array<string>")) for c, seps in columns.items()
    ])).alias("token")]
    tokens = df.select(*per_column).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    unlisted = tokens.join(releases.select(F.col("release").alias("token")), "token", "left_anti")
    ignored = tokens.filter(~_counts(F.col("token")))
    return unlisted.unionByName(ignored).distinct()


def with_lead_days(df: DataFrame) -> DataFrame:
    return df.withColumn("existing_lead_time", F.datediff("fix_version_date", "dev_roadmap_date"))


def parse_day(df: DataFrame, column: str = "extract_date") -> DataFrame:
    """The column as a day; unreadable text becomes null."""
    return df.withColumn(column, day_of(q(column), dict(df.dtypes)[column]))


def since(df: DataFrame, day: str, column: str = "extract_date") -> DataFrame:
    return df.filter(q(column) >= F.lit(day).cast("date"))


def finished(df: DataFrame, statuses: Sequence[str], level: str) -> DataFrame:
    """Snapshots of finished tickets with a known, non-negative lead time."""
    return df.filter(
        (F.col("existing_lead_time") >= 0) & F.col("epic_status").isin(*statuses) & (F.col("epic_level") == level)
    )


def latest_per_key(df: DataFrame, key: str = "key", order: str = "extract_date", tie: str | None = None) -> DataFrame:
    """The row with the latest order value per key; on ties the one with the smallest `tie` number."""
    rank = [q(order).alias("rank_order")] + ([(-q(tie)).alias("rank_tie")] if tie else [])
    rest = [c for c in df.columns if c != key]
    best = df.filter(q(order).isNotNull()).groupBy(key).agg(F.max(F.struct(*rank, *[q(c) for c in rest])).alias("best"))
    return best.select(*[q(key) if c == key else F.col("best")[c].alias(c) for c in df.columns])


def label_back(panel: DataFrame, labels: DataFrame, key: str = "key", how: str = "inner", limit: int = HOT_ROWS) -> DataFrame:
    """Every snapshot with the final lead time of its key; `labels` has one row per key."""
    return lookup_join(panel, labels, [key], how, limit)


def keep_finished_keys(panel: DataFrame, finished_keys: DataFrame, key: str = "key", limit: int = HOT_ROWS) -> DataFrame:
    return lookup_join(panel, finished_keys.select(key).distinct(), [key], "left_semi", limit)


def null_shares(df: DataFrame) -> dict[str, float]:
    row = df.agg(*[F.avg(q(c).isNull().cast("int")).alias(c) for c in df.columns]).first()
    return {c: (row[c] or 0.0) for c in df.columns}


def sparse_columns(measured_on: DataFrame, limit: float) -> list[str]:
    return [c for c, share in null_shares(measured_on).items() if share > limit]


def drop_sparse(df: DataFrame, measured_on: DataFrame, limit: float = 0.95) -> DataFrame:
    """Drops the columns whose null share in `measured_on` is above the limit."""
    return df.drop(*sparse_columns(measured_on, limit))


def dedup_except(df: DataFrame, ignored: Sequence[str], order: str) -> DataFrame:
    """One row per distinct values of all other columns: the first in `order`, a unique row number.

    A pre-aggregated minimum, so a large group of copies shrinks before the
    shuffle; with numeric and date columns aside it stays a hash aggregate.
    """
    aside = [c for c in dict.fromkeys([order, *ignored]) if c in df.columns]
    rest = [c for c in df.columns if c not in aside]
    first = df.groupBy(*[q(c).alias(c) for c in rest]).agg(
        *[F.min(q(c)).alias(c) if c == order else F.min_by(q(c), q(order)).alias(c) for c in aside]
    )
    return first.select(*[q(c) for c in df.columns])


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def dated(panel: DataFrame, releases: DataFrame, config: PrepareConfig = PrepareConfig()) -> DataFrame:
    """The panel from the first day on, with release dates and lead days."""
    rows = since(parse_day(panel), config.since)
    days = calendar(releases)
    rows = release_date(rows, "epic_dev_roadmap", days, config.roadmap_separators, "min", "dev_roadmap_date")
    rows = release_date(rows, "epic_fix_version", days, config.version_separators, "max", "fix_version_date")
    return with_lead_days(rows)


def training_table(
    panel: DataFrame, releases: DataFrame, order: str | None = None, config: PrepareConfig = PrepareConfig(),
    limit: int = HOT_ROWS,
) -> DataFrame:
    """Labelled snapshots: final lead time of each finished ticket, in quarters, on all its snapshots.

    `order` is a row number of the panel for ties and copies; without it the
    earliest snapshot of equal ones stays.
    """
    rows = dated(panel, releases, config)
    done = latest_per_key(finished(rows, config.finished_statuses, config.level).select(
        "key", "extract_date", "existing_lead_time", *([order] if order else [])), tie=order)
    labels = done.select("key", F.col("existing_lead_time").alias("needed_lead_time")).filter("needed_lead_time > 0")
    labelled = label_back(rows, labels, limit=limit)
    in_quarters = labelled.withColumns(
        {c: to_quarters(q(c), config.quarter_days) for c in ("needed_lead_time", "existing_lead_time")}
    )
    unique = dedup_except(in_quarters, ["extract_date"], order or "extract_date")
    capped = unique.withColumn("needed_lead_time", cap_label(F.col("needed_lead_time"), config.top_class))
    return drop_sparse(capped, rows, config.max_null_share)
