"""Building blocks that stay balanced when one group holds a large share of all rows.

Groups are measured with a pre-aggregated count first. Only groups above the
limit leave the plain Spark plan; results are the same either way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketlens.session import materialize

HOT_ROWS = 1_000_000
MAX_BROADCAST_ROWS = 100_000


def q(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class Hot:
    """Groups above the limit, largest first, as a broadcast table of at most MAX_BROADCAST_ROWS rows.

    `all_hot` says that there are more such groups than the table holds; those
    left out are no larger than rows / MAX_BROADCAST_ROWS. `largest` is the row
    count of the largest group, `largest_unlisted` that of the largest left out.
    """

    table: DataFrame
    rows: int
    all_hot: bool
    largest: int = 0
    largest_unlisted: int = 0


def hot_table(spark: SparkSession, schema: StructType | str, keys: Sequence[tuple], sizes: Sequence[int]) -> Hot:
    """Hot groups that the caller has already counted."""
    ranked = sorted(zip(sizes, range(len(keys))), key=lambda x: (-x[0], x[1]))
    table = spark.createDataFrame([keys[k] for _, k in ranked[:MAX_BROADCAST_ROWS]], schema)
    unlisted = ranked[MAX_BROADCAST_ROWS][0] if len(keys) > MAX_BROADCAST_ROWS else 0
    return Hot(F.broadcast(table), sum(sizes), len(keys) > MAX_BROADCAST_ROWS, max(sizes), unlisted)


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> Hot | None:
    """Groups with more than `limit` rows, or None if there are none. At most rows / limit groups can qualify."""
    counts = (
        df.groupBy(*[q(k).alias(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("hot_n"))
        .filter(F.col("hot_n") > limit)
    )
    found = counts.orderBy(F.col("hot_n").desc()).limit(MAX_BROADCAST_ROWS + 1).collect()
    if not found:
        return None
    all_hot = len(found) > MAX_BROADCAST_ROWS
    listed = df.sparkSession.createDataFrame(found[:MAX_BROADCAST_ROWS], counts.schema).drop("hot_n")
    rows = df.count() if all_hot else sum(r["hot_n"] for r in found)
    return Hot(F.broadcast(listed), rows, all_hot, found[0]["hot_n"], found[-1]["hot_n"] if all_hot else 0)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group, 0 for an empty table."""
    counts = df.groupBy(*[q(k).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on the key columns."""
    condition = F.lit(True)
    for k in keys:
        name = "`" + k.replace("`", "``") + "`"
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def split_hot(df: DataFrame, keys: Sequence[str], hot: Hot) -> tuple[DataFrame, DataFrame]:
    """(rows of hot groups, all other rows); with too many hot groups to list, every row counts as hot."""
    if hot.all_hot:
        return df, df.limit(0)
    condition = same_keys(df, hot.table, keys)
    return df.join(hot.table, condition, "left_semi"), df.join(hot.table, condition, "left_anti")


def row_salt(df: DataFrame, salts: int) -> Column:
    """Repeatable salt; equal rows in different input splits get different salts."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[q(c) for c in df.columns]), F.lit(salts)).cast("int")


def lookup_join(
    big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", limit: int = HOT_ROWS, hot: Hot | None | bool = True
) -> DataFrame:
    """Equi-join to a table with at most one row per key, balanced when a key is hot in `big`.

    Rows of a hot key are spread over as many tasks as keep each below `limit`
    rows, and its single lookup row is copied to each; rows with a null key match
    nothing and are spread too. Other keys join as usual (Spark broadcasts `lookup`
    by its measured size); with more hot keys than can be listed, the others are
    spread as the largest of them asks for. `how` is inner, left, left_semi or left_anti. `hot` are
    the hot groups if the caller has counted them, None if there are none.
    """
    on = list(on)
    if hot is True:
        hot = hot_groups(big, on, limit)
    if not hot:
        return big.join(lookup, on, how)
    salts = max(2, math.ceil(hot.largest / limit))
    listed = hot.table.withColumn("hot_key", F.lit(True))
    others = max(1, math.ceil(hot.largest_unlisted / limit))
    spread = F.when(F.col("hot_key") | ~_not_null(on), row_salt(big, salts)).otherwise(row_salt(big, others))
    salted = big.join(listed, on, "left").withColumn("salt", spread).drop("hot_key")
    every = F.when(F.col("hot_key"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.sequence(F.lit(0), F.lit(others - 1)))
    copies = lookup.join(listed, on, "left").withColumn("salt", F.explode(every)).drop("hot_key")
    return salted.join(copies, [*on, "salt"], how).drop("salt")


def _not_null(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & q(c).isNotNull()
    return condition


def range_chunks(df: DataFrame, order: Sequence[Column], total: int, chunk_rows: int) -> DataFrame:
    """Cut the rows into ordered ranges of about `chunk_rows`; adds `chunk`, rising along `order`.

    Spark samples the order columns for the range bounds, so even one huge group
    is cut evenly. Written once, because a second sampling could cut elsewhere.
    """
    parts = max(2, math.ceil(total / chunk_rows))
    return materialize(df.repartitionByRange(parts, *order).withColumn("chunk", F.spark_partition_id()))


def last_before(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], values: Sequence[str], limit: int | None = HOT_ROWS
) -> DataFrame:
    """Adds `prev_<value>`: the nearest earlier non-null of each value within the group.

    Within the group `order` must be total. Groups above `limit` are cut into
    ordered chunks: each chunk is filled on its own and what is still open is
    taken from a table with one row per chunk. None says that the caller has
    already measured that there is no such group.
    """
    def fill(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        earlier = Window.partitionBy(*[q(k) for k in keys]).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.select(
            "*", *[F.last(q(v), ignorenulls=True).over(earlier).alias(f"prev_{v}") for v in values]
        )

    hot = None if limit is None else hot_groups(df, group, limit)
    if hot is None:
        return fill(df, group)
    hot_rows, cold_rows = split_hot(df, group, hot)
    chunks = range_chunks(hot_rows, [*[q(k) for k in group], *order], hot.rows, limit)
    keys = [*group, "chunk"]
    position = F.row_number().over(Window.partitionBy(*[q(k) for k in keys]).orderBy(*order))
    local = fill(chunks, keys)
    ends = chunks.withColumn("position", position).groupBy(*[q(k).alias(k) for k in keys]).agg(
        *[F.expr(f"max_by(`{v}`, position) FILTER (WHERE `{v}` IS NOT NULL)").alias(v) for v in values]
    )
    earlier = Window.partitionBy(*[q(k) for k in group]).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *[q(k) for k in keys], *[F.last(q(v), ignorenulls=True).over(earlier).alias(f"carry_{v}") for v in values]
    )
    filled = local.join(carried, keys, "left")
    hot_filled = filled.select(
        *[q(c) for c in df.columns],
        *[F.coalesce(q(f"prev_{v}"), q(f"carry_{v}")).alias(f"prev_{v}") for v in values],
    )
    return fill(cold_rows, group).unionByName(hot_filled)


def spread_rank(
    df: DataFrame, group: str, digest: Column, tie: str, rows: int | None = None, per_bucket: int = 100_000
) -> DataFrame:
    """Adds `rank`, the 1-based position of each row in its group by a hex digest, then `tie`, and `group_rows`.

    Rows are bucketed by the first digest digits, which are uniform, so no task
    sees a whole group; the offset of a bucket is the count of all smaller ones.
    """
    rows = df.count() if rows is None else rows
    digits = min(6, max(1, math.ceil(math.log(max(rows / per_bucket, 1), 16))))
    hashed = df.withColumn("digest", digest).withColumn("bucket", F.substring("digest", 1, digits))
    sizes = hashed.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("size"))
    smaller = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        group, "bucket", F.coalesce(F.sum("size").over(smaller), F.lit(0)).alias("offset"),
        F.sum("size").over(Window.partitionBy(group)).alias("group_rows"),
    )
    inside = Window.partitionBy(group, "bucket").orderBy("digest", q(tie))
    placed = hashed.withColumn("place", F.row_number().over(inside))
    # null-safe on the group so that unlabelled rows keep a rank too
    joined = placed.join(
        offsets.withColumnRenamed(group, "offset_group").withColumnRenamed("bucket", "offset_bucket"),
        (F.col("bucket") == F.col("offset_bucket")) & q(group).eqNullSafe(F.col("offset_group")),
    )
    return joined.select(
        *[q(c) for c in df.columns], (F.col("offset") + F.col("place")).cast("long").alias("rank"), F.col("group_rows")
    )
