"""Work units per status group, splits, folds, weights and classification metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.text import slug
from ticketlens.skew import q, spread_rank


def plan_units(
    df: DataFrame, status: str = "epic_status", groups: Mapping[str, Sequence[str]] | None = None, ungrouped: str = "skip",
    include: Sequence[str] = (), exclude: Sequence[str] = (),
) -> DataFrame:
    """(type, name, slug, statuses) of the units whose statuses occur in the data.

    With groups: one unit per group, and with `ungrouped` = perstatus one per
    status that no group names. Without: one unit per status of the allow list,
    or else outside the deny list. A status may belong to several groups.
    """
    seen = df.select(q(status).cast("string").alias("status")).filter("status IS NOT NULL").distinct()
    alone = [F.lit("status").alias("type"), F.col("status").alias("name"), F.lit(None).cast("int").alias("ord"), F.col("status")]
    if groups:
        owners = F.filter(F.array(*[
            F.when(F.col("status").isin(*members), F.struct(F.lit("group").alias("type"), F.lit(g).alias("name"), F.lit(i).alias("ord")))
            for i, (g, members) in enumerate(groups.items())
        ]), lambda x: x.isNotNull())
        placed = seen.withColumn("owners", owners)
        units = placed.select(F.explode("owners").alias("owner"), "status").select("owner.type", "owner.name", "owner.ord", "status")
        if ungrouped == "perstatus":
            units = units.unionByName(placed.filter(F.size("owners") == 0).select(*alone))
    elif include:
        units = seen.filter(F.col("status").isin(*include)).select(*alone)
    else:
        units = (seen.filter(~F.col("status").isin(*exclude)) if exclude else seen).select(*alone)
    gathered = units.groupBy("type", "name", "ord").agg(F.sort_array(F.collect_set("status")).alias("statuses"))
    return gathered.select("type", "name", slug(F.col("name")).alias("slug"), "statuses", "ord").orderBy(F.col("ord").asc_nulls_last(), "name").drop("ord")


def segment(df: DataFrame, statuses: Sequence[str] | None, status: str = "epic_status") -> DataFrame:
    """Rows of the given statuses, or all."""
    return df if statuses is None else df.filter(q(status).isin(*statuses))


def build_xy(df: DataFrame, target: str, drop: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Features and target without identifiers and leaks; `keep` columns stay beside them."""
    gone = {c for c in drop if c not in keep and c != target}
    return df.select(*[q(c) for c in df.columns if c not in gone])


def class_counts(df: DataFrame, y: str) -> DataFrame:
    return df.filter(q(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("n"))


def skip_guards(df: DataFrame, unit: str, y: str) -> DataFrame:
    """Rows, classes and whether the unit is skipped, per unit."""
    per_class = df.groupBy(unit, y).agg(F.count(F.lit(1)).alias("n"))
    counts = per_class.groupBy(unit).agg(F.sum("n").alias("n_rows"), F.count(q(y)).alias("n_classes"))
    return counts.withColumn("skipped", F.col("n_classes") < 2)


def fold_count(counts: Sequence[int], wanted: int) -> int:
    """Between 2 and the wanted number, at most the size of the smallest class."""
    return max(2, min(wanted, min(counts))) if counts else 2


def safe_folds(df: DataFrame, y: str, wanted: int) -> DataFrame:
    """The usable fold number as a one-row table."""
    smallest = class_counts(df, y).agg(F.min("n").alias("smallest"))
    return smallest.select(F.greatest(F.lit(2), F.least(F.lit(wanted), F.coalesce("smallest", F.lit(2)))).cast("int").alias("folds"))


def shuffle_digest(key: str, seed: int) -> Column:
    """Repeatable shuffle order of a row."""
    return F.md5(F.concat(q(key).cast("string"), F.lit(f":{seed}")))


def stratified_split(df: DataFrame, y: str, key: str, test_share: float = 0.2, seed: int = 42, rows: int | None = None) -> DataFrame:
    """Adds `is_test`: the share of every class, rounded half up, in shuffled order."""
    ranked = spread_rank(df, y, shuffle_digest(key, seed), key, rows)
    held = F.floor(F.col("group_rows") * F.lit(test_share) + F.lit(0.5))
    return ranked.select(*[q(c) for c in df.columns], (F.col("rank") <= held).alias("is_test"))


def stratified_folds(df: DataFrame, y: str, key: str, folds: int, seed: int = 42, rows: int | None = None) -> DataFrame:
    """Adds `fold`, 0 to folds - 1, dealt out in shuffled order within each class."""
    ranked = spread_rank(df, y, shuffle_digest(key, seed), key, rows)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop("rank", "group_rows")


def class_weights(counts: Mapping[str, int]) -> dict[str, float]:
    """Balanced weights: rows over classes times class rows."""
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def class_weight(df: DataFrame, y: str) -> DataFrame:
    """Adds the balanced weight of each row's class. The weights of the classes are constants in the plan."""
    weights = class_weights({r[y]: r["n"] for r in class_counts(df, y).collect()})
    chosen = F
    for label, weight in weights.items():
        chosen = chosen.when(q(y) == F.lit(label), F.lit(weight))
    return df.withColumn("class_weight", chosen)


@dataclass
class Metrics:
    accuracy: float
    f1_weighted: float
    n: int


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    return df.groupBy(q(y).alias("y"), q(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, y: str, pred: str) -> DataFrame:
    cells = confusion(df, y, pred)
    right = F.sum(F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0))
    return cells.agg((right / F.sum("n")).alias("accuracy"))


def f1_weighted(df: DataFrame, y: str, pred: str) -> DataFrame:
    """F1 per class, averaged by the number of true rows; 0 for a class never met."""
    cells = confusion(df, y, pred)
    hit = F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0)
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("truth"), F.lit(0).cast("long").alias("guess"), hit.cast("long").alias("hit")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("truth"), F.col("n").alias("guess"), F.lit(0).cast("long").alias("hit")),
    )))
    per_class = sides.groupBy("label").agg(F.sum("truth").alias("truth"), F.sum("guess").alias("guess"), F.sum("hit").alias("hit"))
    f1 = F.lit(2.0) * F.col("hit") / (F.col("truth") + F.col("guess"))
    return per_class.agg((F.sum(f1 * F.col("truth")) / F.sum("truth")).alias("f1_weighted"))


def metrics(df: DataFrame, y: str, pred: str) -> Metrics:
    """Both scores from one confusion count."""
    cells = confusion(df, y, pred).collect()
    n = sum(r["n"] for r in cells)
    truth: dict = {}
    guess: dict = {}
    hit: dict = {}
    for r in cells:
        truth[r["y"]] = truth.get(r["y"], 0) + r["n"]
        guess[r["pred"]] = guess.get(r["pred"], 0) + r["n"]
        if r["y"] == r["pred"]:
            hit[r["y"]] = r["n"]
    if not n:
        return Metrics(0.0, 0.0, 0)
    f1 = sum(t * 2 * hit.get(c, 0) / (t + guess.get(c, 0)) for c, t in truth.items()) / n
    return Metrics(sum(hit.values()) / n, f1, n)
