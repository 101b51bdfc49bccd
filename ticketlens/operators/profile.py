"""Column profiling: dates, multi-label columns, cardinality and the encoding that fits each column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.functions.dates import date_or_null
from ticketlens.functions.text import SEPARATOR, tags
from ticketlens.skew import q

# Thresholds of the classification
LOW_CARDINALITY = 50
HIGH_CARDINALITY = 200
TAG_VOCABULARY = 100
RARE_COUNT = 10
RARE_SHARE = 0.3
LONG_TEXT = 30
DATE_SHARE = 0.8

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def as_text(df: DataFrame, column: str) -> Column:
    """Category value as text; booleans are written True and False."""
    c = q(column)
    return F.initcap(c.cast("string")) if dict(df.dtypes)[column] == "boolean" else c.cast("string")


def sample_rows(df: DataFrame, share: float, key: Column, seed: int = 42) -> DataFrame:
    """About the share of the rows, chosen by a digest of their key: the same rows however the table is partitioned."""
    digest = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)
    return df.filter(F.conv(digest, 16, 10).cast("long") / F.lit(2.0**32) < share)


def sample_values(df: DataFrame, columns: Sequence[str], n: int, key: Column | None = None, seed: int = 42) -> DataFrame:
    """(column, value): exactly n values of each text column that are not null, or all if there are fewer.

    Those whose digest of row key, column and seed is smallest, so the choice does
    not depend on partitions; without a key the row itself is the key. A task keeps
    n rows per column before the shuffle, and rows that are alike count each.
    """
    own = F.xxhash64(*[q(c) for c in df.columns]) if key is None else key
    cells = F.array(*[F.struct(F.lit(c).alias("column"), as_text(df, c).alias("value")) for c in columns])
    long = df.select(own.cast("string").alias("key"), F.inline(cells)).filter("value IS NOT NULL")
    digest = F.md5(F.concat(F.coalesce("key", F.lit("")), F.lit(":"), F.col("column"), F.lit(f":{seed}")))
    order = Window.partitionBy("column").orderBy("digest", "value")
    placed = long.select("column", "value", digest.alias("digest")).withColumn("place", F.row_number().over(order))
    return placed.filter(F.col("place") <= n).select("column", "value")


def detect_dates(
    df: DataFrame, threshold: float = DATE_SHARE, sample: float | None = None, sample_size: int | None = None, key: Column | None = None
) -> list[str]:
    """Text columns whose values are dates in at least the given share of rows, in one pass.

    Of all rows, of a share of them (`sample`), or of exactly `sample_size` values of each column.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return []
    if sample_size is not None:
        dated = date_or_null(F.col("value")).isNotNull().cast("int")
        shares = {r["column"]: r["share"] for r in sample_values(df, texts, sample_size, key).groupBy("column").agg(F.avg(dated).alias("share")).collect()}
        return [c for c in texts if c in shares and shares[c] >= threshold]
    rows = df.select(*[q(c) for c in texts])
    rows = sample_rows(rows, sample, F.xxhash64(*[q(c) for c in texts])) if sample else rows
    share = rows.agg(
        *[F.avg(F.when(q(c).isNotNull(), date_or_null(q(c)).isNotNull().cast("int"))).alias(c) for c in texts]
    ).first()
    return [c for c in texts if share[c] is not None and share[c] >= threshold]


def detect_types(df: DataFrame, threshold: float = DATE_SHARE) -> tuple[list[str], list[str], list[str]]:
    """(categorical, date, numeric) columns; date types are dates, numeric columns come in name order."""
    texts = detect_dates(df, threshold)
    dates = [c for c, t in df.dtypes if c in texts or t in ("date", "timestamp", "timestamp_ntz")]
    numbers = sorted(c for c, t in df.dtypes if t.startswith(NUMBERS))
    categories = [c for c, t in df.dtypes if t in ("string", "boolean") and c not in dates]
    return categories, dates, numbers


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one pre-aggregated shuffle; nulls do not count."""
    texts = df.select(*[as_text(df, c).alias(c) for c in columns])
    long = texts.unpivot([], [q(c) for c in columns], "column", "value") if len(columns) > 1 else texts.select(
        F.lit(columns[0]).alias("column"), q(columns[0]).alias("value"))
    return long.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def tag_counts(values: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """(column, tag, n) from value counts; a value counts all its uses."""
    exploded = values.select("column", "n", F.explode(tags(F.col("value"), sep)).alias("tag"))
    return exploded.groupBy("column", "tag").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, value: str, k: int) -> DataFrame:
    """The k most frequent values per column, smallest value first on ties, with `place`.

    Spark keeps only k rows per column and task before the shuffle.
    """
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col(value))
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def tag_stats(values: DataFrame, rare: int = RARE_COUNT, sep: str = SEPARATOR) -> DataFrame:
    """Tag vocabulary size and share of rare tags per column."""
    return tag_counts(values, sep).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_tags"), F.avg((F.col("n") < rare).cast("double")).alias("rare_share")
    )


def column_stats(values: DataFrame, sep: str = SEPARATOR) -> DataFrame:
    """Distinct values, multi-label share and mean length per column, from value counts."""
    uses = F.sum("n")
    return values.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"),
        (F.sum(F.when(F.col("value").contains(sep), F.col("n")).otherwise(0)) / uses).alias("multi_share"),
        (F.sum(F.col("n") * F.length("value")) / uses).alias("mean_length"),
    )


def profile(df: DataFrame, columns: Sequence[str], rare: int = RARE_COUNT, sep: str = SEPARATOR) -> DataFrame:
    """One row of exact statistics per column."""
    values = value_counts(df, columns)
    stats = column_stats(values, sep)
    labelled = stats.filter("multi_share > 0.5").select("column")
    multi = tag_stats(values.join(labelled, "column", "left_semi"), rare, sep)
    return stats.join(multi, "column", "left")


def strategy(
    low: int = LOW_CARDINALITY, high: int = HIGH_CARDINALITY, vocabulary: int = TAG_VOCABULARY, rare_share: float = RARE_SHARE
) -> Column:
    """Encoding of a profiled column."""
    few_rare = F.coalesce(F.col("rare_share"), F.lit(0.0)) < rare_share
    return (
        F.when((F.col("multi_share") > 0.5) & (F.coalesce("n_tags", F.lit(0)) <= vocabulary), "tag_binarize")
        .when((F.col("multi_share") > 0.5) & few_rare, "tag_top_k")
        .when(F.col("multi_share") > 0.5, "tag_count")
        .when(F.col("n_unique") <= low, "one_hot")
        .when(F.col("n_unique") <= high, "top_k")
        .when(F.col("mean_length") > LONG_TEXT, "text")
        .otherwise("frequency")
    )


def classify(profiled: DataFrame, **thresholds) -> DataFrame:
    """Profile rows with the encoding that fits each column (multi-label ones are counted besides)."""
    return profiled.withColumn("strategy", strategy(**thresholds))


@dataclass
class ColumnGroups:
    """Columns by encoding, in table order."""

    numeric: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)
    one_hot: list[str] = field(default_factory=list)
    top_k: list[str] = field(default_factory=list)
    frequency: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    tag_count: list[str] = field(default_factory=list)
    tag_binarize: list[str] = field(default_factory=list)
    tag_top_k: list[str] = field(default_factory=list)


def group_columns(df: DataFrame, rare: int = RARE_COUNT, sep: str = SEPARATOR) -> ColumnGroups:
    """Types and encodings of all columns.

    A first pass without a shuffle finds the dates and the columns that are far above the high
    threshold (four times, by a 5 % sketch); only the others need exact counts.
    """
    texts = [c for c, t in df.dtypes if t in ("string", "boolean")]
    measures = []
    for i, c in enumerate(texts):
        v = as_text(df, c)
        dated = F.avg(F.when(v.isNotNull(), date_or_null(v).isNotNull().cast("int"))) if dict(df.dtypes)[c] == "string" else F.lit(None).cast("double")
        measures += [
            F.approx_count_distinct(v).alias(f"d{i}"), F.avg(v.contains(sep).cast("double")).alias(f"m{i}"),
            F.avg(F.length(v)).alias(f"l{i}"), dated.alias(f"t{i}"),
        ]
    seen = df.agg(*measures).first() if texts else None
    found = [c for i, c in enumerate(texts) if seen[f"t{i}"] is not None and seen[f"t{i}"] >= DATE_SHARE]
    dates = [c for c, t in df.dtypes if c in found or t in ("date", "timestamp", "timestamp_ntz")]
    groups = ColumnGroups(numeric=sorted(c for c, t in df.dtypes if t.startswith(NUMBERS)), dates=dates)
    categories = [c for c in texts if c not in dates]
    chosen: dict[str, str] = {}
    exact = []
    for i, c in [(i, c) for i, c in enumerate(texts) if c in categories]:
        if seen[f"d{i}"] > 4 * HIGH_CARDINALITY and seen[f"m{i}"] <= 0.5:
            chosen[c] = "text" if seen[f"l{i}"] > LONG_TEXT else "frequency"
        elif seen[f"d{i}"] == 0:
            chosen[c] = "one_hot"
        else:
            exact.append(c)
    if exact:
        chosen.update({r["column"]: r["strategy"] for r in classify(profile(df, exact, rare, sep)).collect()})
    for c in categories:
        getattr(groups, chosen[c]).append(c)
        if chosen[c] in ("tag_binarize", "tag_top_k"):
            groups.tag_count.append(c)
    return groups
