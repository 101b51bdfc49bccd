"""From raw documents to shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; all but the last return the columns of their input. `run` writes what a
stage returns as Parquet and gives it, read again, to the next.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketlens.llm import cube, decontam, neardup, quality, sharding
from ticketlens.llm.storage import small, stored
from ticketlens.skew import HOT_ROWS

KEY = "__row_key"
#: Near-duplicates share this percentage of their 5-word shingles; the 85 of op2 is the contract of that query only.
NEAR_PERCENT = 80


def _id_and_text() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """The rows whose key is not in `gone` (one column row_key)."""
    dropped = stored(gone.select(F.col("row_key").alias(KEY)).distinct())
    return docs.withColumn(KEY, key).join(small(dropped), KEY, "left_anti").select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; the others go on without their lines above the limit."""
    removed = quality.removed_lines(docs)
    key = quality.row_key(F.col("doc_id"), F.col("source"), F.coalesce("text", F.lit("")))
    kept = _without(docs, quality.verdicts(docs, removed=removed).filter(~F.col("kept")), key)
    return quality.cleaned(kept, removed=removed)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: that of the smallest id, and of its rows the one with the smallest key.

    Groups without any id keep one row too. Rows without id and words are in no group.
    """
    found = stored(neardup.near_duplicates(docs, percent=NEAR_PERCENT).select("row_key", "group_id", "kept"))
    grouped = found.filter(F.col("group_id").isNotNull())
    stays = stored(
        grouped.filter("kept").groupBy("group_id").agg(F.min("row_key").alias("row_key"), F.count(F.lit(1)).alias("n"))
    )
    left = _without(docs, grouped.select("row_key").join(stays, "row_key", "left_anti"), _id_and_text())
    repeated = stays.filter(F.col("n") > 1).select(F.col("row_key").alias(KEY))
    if repeated.isEmpty():
        return left
    # equal rows have one key: of those a single row is left
    keyed = left.withColumn(KEY, _id_and_text())
    once = keyed.join(repeated, KEY, "left_semi").dropDuplicates([KEY])
    return keyed.join(repeated, KEY, "left_anti").unionByName(once).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontam.decontaminate(docs, benchmark).filter("contaminated"), _id_and_text())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: not at all, once or twice.

    Equal rows of a source are drawn one by one; how many of them are taken once
    more than the others is what their draws add up to.
    """
    key = [KEY, "__source"]
    drawn = cube.mix(docs).groupBy(F.col("row_key").alias(KEY), F.col("source").alias("__from")).agg(
        F.min("times").alias("__times"), (F.sum("times") - F.count(F.lit(1)) * F.min("times")).alias("__more")
    )
    taken = stored(drawn)
    keyed = docs.withColumns({KEY: _id_and_text(), "__source": F.col("source")})
    same = (F.col(KEY) == F.col("__key")) & F.col("__source").eqNullSafe(F.col("__from"))
    joined = keyed.join(small(taken.withColumnRenamed(KEY, "__key")), same).drop("__key", "__from")
    if not taken.filter("__more > 0").isEmpty():
        uneven = _numbered(joined.filter("__more > 0"), key)
        even = joined.filter("__more = 0").withColumn("__place", F.lit(1).cast("long"))
        joined = even.unionByName(uneven).withColumn("__times", F.col("__times") + (F.col("__place") <= F.col("__more")).cast("long"))
    copies = joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__times").cast("int"))))
    return copies.select(*docs.columns)


def _numbered(rows: DataFrame, key: list[str]) -> DataFrame:
    """Adds `__place`, counting the rows of each key from 1. Keys are cut into ranges, so one may hold any share of the rows."""
    parts = max(2, math.ceil(rows.count() / HOT_ROWS))
    ranged = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *[F.col(k) for k in key], "__row")
    chunks = stored(ranged.withColumn("__chunk", F.spark_partition_id()))
    of = {k: f"{k}_of" for k in [*key, "__chunk"]}
    sizes = chunks.groupBy(*of).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(n) for k, n in of.items()], F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(*of).orderBy("__row"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in of.items()]
    placed = chunks.withColumn("__inside", inside).join(offsets, reduce(and_, same))
    return placed.select(*rows.columns, (F.col("__inside") + F.col("__before")).alias("__place"))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row of the mix."""
    return sharding.shard(docs, shards=16)


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("sharding", assign_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Connected components, balanced sampling and label propagation have no counterpart in SQL.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
