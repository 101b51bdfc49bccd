"""Feature selection from per-class statistics.

One aggregation over the feature arrays gives count, mean, variance, minimum,
maximum and non-zero count per class and feature. Everything that follows works
on one row per feature, so it does not grow with the data.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass
from operator import add

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.operators.neighbours import binned_information, neighbour_information, value_table
from ticketlens.operators.quantiles import bin_edges, number
from ticketlens.session import materialize
from ticketlens.skew import q

BINS = 10
# classes of a target that may reach the driver, one row of statistics each
MOST_CLASSES = 1_000


@dataclass
class FeatureStats:
    """Statistics of one feature over all rows and per class (in class order)."""

    name: str
    n: int
    present: int
    mean: float
    variance: float
    low: float
    high: float
    class_n: list[int]
    class_mean: list[float]
    class_variance: list[float]
    class_present: list[int]

    @property
    def varies(self) -> bool:
        return self.high > self.low and self.variance > 0

    @property
    def is_flag(self) -> bool:
        """Only zeros and ones."""
        return self.low >= 0 and self.high <= 1 and math.isclose(self.mean * self.n, self.present, abs_tol=1e-6)


def with_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide numeric columns as one `features` array."""
    return df.select(*[q(c) for c in keep], F.array(*[q(c).cast("double") for c in columns]).alias("features"))


def feature_stats(df: DataFrame, names: Sequence[str], y: str | None = None) -> list[FeatureStats]:
    """Statistics of the `features` array, split by class `y` if given; nulls in y form no class.

    A target with more than MOST_CLASSES values is an error; cut a numeric one into classes first (`target_classes`).
    """
    measure = Summarizer.metrics("count", "mean", "variance", "numNonZeros", "min", "max")
    label = q(y).cast("string") if y else F.lit("")
    rows = (
        df.select(label.alias("label"), array_to_vector("features").alias("v")).filter("label IS NOT NULL")
        .groupBy("label").agg(measure.summary(F.col("v")).alias("s"))
        .select("label", F.col("s.count").alias("n"), *[
            vector_to_array(F.col(f"s.{m}")).alias(m) for m in ("mean", "variance", "numNonZeros", "min", "max")])
        .limit(MOST_CLASSES + 1).collect()
    )
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"the target has more than {MOST_CLASSES} values; a numeric one needs classes")
    rows = sorted(rows, key=lambda r: r["label"])
    return [
        combined(
            name, [r["n"] for r in rows], [r["mean"][i] for r in rows], [r["variance"][i] for r in rows],
            [int(r["numNonZeros"][i]) for r in rows], min((r["min"][i] for r in rows), default=0.0), max((r["max"][i] for r in rows), default=0.0))
        for i, name in enumerate(names)
    ]


def combined(
    name: str, class_n: list[int], means: list[float], variances: list[float], present: list[int], low: float, high: float
) -> FeatureStats:
    """Statistics over all rows from those of the classes."""
    total = sum(class_n)
    if not total:
        return FeatureStats(name, 0, 0, 0.0, 0.0, 0.0, 0.0, [], [], [], [])
    mean = sum(n * m for n, m in zip(class_n, means)) / total
    square = sum((n - 1) * v + n * (m - mean) ** 2 for n, m, v in zip(class_n, means, variances))
    return FeatureStats(name, total, sum(present), mean, square / total, low, high, class_n, means, variances, present)


def sparse_stats(df: DataFrame, names: Sequence[str], y: str | None = None) -> list[FeatureStats]:
    """Statistics of sparse rows (`entries`: j and x), split by class `y` if given; features without an entry are 0.

    Only the entries are combined, so memory and shuffle follow the values that are
    not 0, whatever the number of features.
    """
    label = q(y).cast("string") if y else F.lit("")
    rows = df.select(label.alias("label"), "entries").filter("label IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MOST_CLASSES + 1).collect()}
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"the target has more than {MOST_CLASSES} values; a numeric one needs classes")
    x = F.col("x")
    # outer: for an inner one Spark asks first whether a row has entries, and builds them twice for that
    cells = rows.select("label", F.inline_outer("entries")).filter("j IS NOT NULL").groupBy("j", "label").agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("variance"), F.count(F.when(x != 0, True)).alias("present"),
        F.min(x).alias("low"), F.max(x).alias("high"))
    found = {(r["j"], r["label"]): r for r in cells.collect()}  # features x classes
    labels = sorted(sizes)
    return [of_entries(name, [sizes[c] for c in labels], [found.get((j, c)) for c in labels]) for j, name in enumerate(names)]


def of_entries(name: str, sizes: list[int], cells: Sequence) -> FeatureStats:
    """Statistics of a feature from those of its entries per class (n, mean, variance, present, low, high; None without any)."""
    means, variances, present, lows, highs = [], [], [], [], []
    for size, r in zip(sizes, cells, strict=True):
        zeros = size - (r["n"] if r else 0)
        mean = r["mean"] * r["n"] / size if r else 0.0
        around = r["n"] * (r["variance"] + (r["mean"] - mean) ** 2) + zeros * mean**2 if r else 0.0
        means.append(mean)
        variances.append(around / (size - 1) if size > 1 else 0.0)
        present.append(r["present"] if r else 0)
        lows += ([r["low"]] if r else []) + ([0.0] if zeros else [])
        highs += ([r["high"]] if r else []) + ([0.0] if zeros else [])
    return combined(name, sizes, means, variances, present, min(lows, default=0.0), max(highs, default=0.0))


def sparse_information(df: DataFrame, stats: Sequence[FeatureStats], y: str, bins: int | None = None) -> dict[str, float]:
    """Mutual information of each varying feature of sparse rows and the class: by nearest neighbours, or over equal-frequency bins.

    For a flag the class statistics already hold the table of values and counts.
    """
    out = {s.name: 0.0 for s in stats}
    asked = [(j, s) for j, s in enumerate(stats) if s.varies]
    if not asked:
        return out
    spark = df.sparkSession
    flags = [(j, s) for j, s in asked if s.is_flag]
    rest = [j for j, s in asked if not s.is_flag]
    rows = df.select(q(y).cast("string").alias("label"), "entries").filter("label IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(sizes)
    counted = [
        (j, c, float(v), n) for j, s in flags for c, size, p in zip(labels, s.class_n, s.class_present, strict=True) for v, n in ((1, p), (0, size - p)) if n
    ]
    table = spark.createDataFrame(counted, "i int, label string, x double, n long")
    if rest:
        wanted = F.col("j").isin(rest) if len(rest) < len(stats) else F.lit(True)
        there = rows.select("label", F.inline("entries")).filter(wanted).groupBy(F.col("j").alias("i"), "label", "x").agg(F.count(F.lit(1)).alias("n"))
        there = materialize(there)
        full = spark.createDataFrame([(j, c, sizes[c]) for j in rest for c in labels], "i int, label string, size long")
        zeros = full.join(there.groupBy("i", "label").agg(F.sum("n").alias("n")), ["i", "label"], "left").select(
            "i", "label", F.lit(0.0).alias("x"), (F.col("size") - F.coalesce("n", F.lit(0))).alias("n"))
        table = table.unionByName(there).unionByName(zeros)
    found = neighbour_information(table) if bins is None else binned_information(table, bins, [j for j, _ in flags])
    return out | {s.name: found.get(j, 0.0) for j, s in asked}


def target_classes(df: DataFrame, y: str, into: str, bins: int = BINS) -> DataFrame:
    """Adds the equal-frequency class of a numeric target, as text; no value has no class."""
    value = number(q(y))
    edges = bin_edges(df, {"y": value}, [b / bins for b in range(1, bins)])["y"]
    place = functools.reduce(add, [(value > e).cast("int") for e in edges], F.lit(0))
    return df.withColumn(into, place.cast("string"))


def varying(stats: Sequence[FeatureStats], threshold: float = 0.0) -> list[str]:
    """Names of the features whose (population) variance is above the threshold."""
    return [s.name for s in stats if s.varies and s.variance > threshold]


def f_score(s: FeatureStats) -> float:
    """One-way F of the feature against the class; 0 where it is not a finite number."""
    k = len(s.class_n)
    between = sum(n * (m - s.mean) ** 2 for n, m in zip(s.class_n, s.class_mean))
    within = sum((n - 1) * v for n, v in zip(s.class_n, s.class_variance))
    if k < 2 or s.n <= k or within <= 0 or not s.varies:
        return 0.0
    return (between / (k - 1)) / (within / (s.n - k))


def information(table: Sequence[Sequence[int]]) -> float:
    """Mutual information (nats) of a contingency table: one list of class counts per bin."""
    total = sum(map(sum, table))
    if not total:
        return 0.0
    by_class = [sum(column) for column in zip(*table)]
    out = 0.0
    for row in table:
        size = sum(row)
        out += sum(n / total * math.log(n * total / (size * c)) for n, c in zip(row, by_class) if n)
    return max(0.0, out)


def mutual_info(df: DataFrame, stats: Sequence[FeatureStats], y: str, bins: int | None = BINS) -> dict[str, float]:
    """Mutual information of each varying feature and the class over equal-frequency bins, or by nearest neighbours (no bins).

    For a 0/1 feature the class statistics already hold the table. The others
    are cut at quantiles (see `bin_edges`) and counted in one pre-aggregated pass.
    """
    out: dict[str, float] = {}
    rest = []
    if bins is None:
        found = neighbour_information(value_table(df, {i: F.col("features")[i] for i, s in enumerate(stats) if s.varies}, q(y)))
        return {s.name: found.get(i, 0.0) for i, s in enumerate(stats)}
    for i, s in enumerate(stats):
        if not s.varies:
            out[s.name] = 0.0
        elif s.is_flag:
            out[s.name] = information([s.class_present, [n - p for n, p in zip(s.class_n, s.class_present)]])
        else:
            rest.append((i, s.name))
    if not rest:
        return out
    labelled = df.filter(q(y).isNotNull())
    shares = [b / bins for b in range(1, bins)]
    edges = bin_edges(labelled, {f"f{i}": F.col("features")[i] for i, _ in rest}, shares)
    cells = F.array(*[
        F.struct(F.lit(i).alias("feature"), sum(((F.col("features")[i] > e).cast("int") for e in edges[f"f{i}"]), F.lit(0)).alias("bin"))
        for i, _ in rest
    ])
    counts = labelled.select(q(y).cast("string").alias("label"), F.inline(cells)).groupBy("feature", "bin", "label").agg(
        F.count(F.lit(1)).alias("n")).collect()
    labels = sorted({r["label"] for r in counts})
    tables: dict[int, dict[int, list[int]]] = {}
    for r in counts:
        tables.setdefault(r["feature"], {}).setdefault(r["bin"], [0] * len(labels))[labels.index(r["label"])] = r["n"]
    out.update({name: information(list(tables[i].values())) for i, name in rest})
    return out


def minmax(values: Sequence[float]) -> list[float]:
    """Scaled to [0, 1]; all 0 if the values do not differ or are not finite."""
    if not values:
        return []
    low, high = min(values), max(values)
    if not (math.isfinite(low) and math.isfinite(high)) or high <= low:
        return [0.0] * len(values)
    return [(v - low) / (high - low) for v in values]


def coverage(s: FeatureStats) -> float:
    """Share of rows where the feature is there and not 0."""
    return s.present / s.n if s.n else 0.0


@dataclass
class Scored:
    name: str
    f: float
    mi: float
    ref_signal: float
    combined: float


def joint_scores(
    train: Sequence[FeatureStats], mi: dict[str, float], ref: Sequence[FeatureStats] | None,
    w_f: float = 0.5, w_mi: float = 0.5, w_ref: float = 0.15, min_presence: float = 0.05,
) -> list[Scored]:
    """Blend of F and mutual information on the training rows with the coverage on the reference rows.

    Only features of both encodings are scored; without reference rows there is
    no signal and no presence limit.
    """
    if ref is not None:
        by_name = {s.name: s for s in ref}
        train = [s for s in train if s.name in by_name]
    f = [f_score(s) for s in train]
    info = [mi.get(s.name, 0.0) for s in train]
    signal = [w_f * a + w_mi * b for a, b in zip(minmax(f), minmax(info))]
    if ref and any(by_name[s.name].n for s in train):
        seen = [coverage(by_name[s.name]) for s in train]
        compatible = [c * by_name[s.name].varies for c, s in zip(minmax(seen), train)]
        allowed = [c >= min_presence for c in seen]
    else:
        compatible, allowed = [0.0] * len(train), [True] * len(train)
    return [
        Scored(s.name, fs, m, r, ((1 - w_ref) * t + w_ref * r) * ok)
        for s, fs, m, t, r, ok in zip(train, f, info, signal, compatible, allowed)
    ]


def joint_select(scores: Sequence[Scored], k: int, stats: Sequence[FeatureStats]) -> list[str]:
    """Names of the k best features in training order; without any, the one that varies most."""
    k = min(k, len(scores))
    if k <= 0:
        return [max(stats, key=lambda s: s.variance).name]
    # scores that differ by rounding alone are equal
    best = sorted(range(len(scores)), key=lambda i: (-round(scores[i].combined, 9), i))[:k]
    return [scores[i].name for i in sorted(best)]


def dual_select(
    train: Sequence[FeatureStats], mi: dict[str, float], new: Sequence[FeatureStats] | None, k: int = 97,
    min_variance: float = 0.001, min_share: float = 0.10,
) -> list[tuple[str, float]]:
    """Older variant: plain mean of both scores, zeroed where the new rows lack the feature; best first."""
    if new is not None:
        by_name = {s.name: s for s in new}
        train = [s for s in train if s.name in by_name]
    scores = [0.5 * a + 0.5 * b for a, b in zip(minmax([f_score(s) for s in train]), minmax([mi.get(s.name, 0.0) for s in train]))]
    if new is not None:
        def usable(s: FeatureStats) -> bool:
            sample = s.variance * s.n / (s.n - 1) if s.n > 1 else 0.0
            return sample > min_variance and s.present > int(s.n * min_share)

        scores = [v * usable(by_name[s.name]) for v, s in zip(scores, train)]
    ranked = sorted(range(len(train)), key=lambda i: (-scores[i], i))[:k]
    return [(train[i].name, scores[i]) for i in ranked]


def score_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Per-feature results as a table, one row per feature."""
    return spark.createDataFrame(list(rows), schema)
