"""Model operators: features, forest, calibration, cross-validation, saving."""

from __future__ import annotations

import functools
import json
import math
import random
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from operator import add, mul

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ticketlens.functions.labels import ordered_labels
from ticketlens.operators import select, units
from ticketlens.operators.encode import Preprocessor
from ticketlens.operators.folds import ALL_ROWS, ValueCounts, column_groups, encoders, feature_stats, feature_table, information, unread_texts
from ticketlens.operators.profile import ColumnGroups, group_columns
from ticketlens.operators.score import PREFIX, total
from ticketlens.operators.trees import saved_nodes, saved_with_min_split, with_min_split
from ticketlens.session import ensure_checkpoint_dir, materialize, remove_folder, scratch_folder, together
from ticketlens.skew import q

# distinct probabilities that one task of a calibration round takes
CELLS_AT_ONCE = 250_000
# Spark grows trees to this depth at most
DEEPEST = 30
# tree nodes that the driver holds at once where a forest is grown in groups
NODES_AT_ONCE = 1_000_000
# groups of trees that grow side by side
GROUPS_AT_ONCE = 4


@dataclass(frozen=True)
class ForestParams:
    """Forest settings. Nodes with fewer than `min_samples_split` rows are made leaves once the trees are grown."""

    # Default forest
    n_estimators: int = 300
    max_depth: int = 30
    min_samples_split: int = 8
    min_samples_leaf: int = 2
    max_features: str = "sqrt"
    random_state: int = 42
    bootstrap: bool = True

    def settings(self) -> dict:
        if self.max_depth > DEEPEST:
            raise ValueError(f"trees grow to depth {DEEPEST} at most, not {self.max_depth}")
        return {
            "numTrees": self.n_estimators, "maxDepth": self.max_depth, "minInstancesPerNode": self.min_samples_leaf,
            "featureSubsetStrategy": self.max_features, "seed": self.random_state, "cacheNodeIds": self.max_depth > 10,
            "bootstrap": self.bootstrap,
        }


@dataclass(frozen=True)
class FeatureParams:
    # Number of features and selection weights
    k_features: int = 140
    w_f: float = 0.5
    w_mi: float = 0.5
    w_ref: float = 0.15
    min_presence: float = 0.05
    # mutual information by nearest neighbours (None), or over so many equal-frequency bins
    bins: int | None = None
    # TF-IDF columns for so many terms of each long text; 0 leaves long texts out
    text_terms: int = 0


@dataclass
class FeaturePlan:
    """A fitted encoder and the features chosen from it, in training order."""

    encoder: Preprocessor
    names: list[str]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The features as the model sees them, one column each."""
        rows = self.encoder.vectors(df, keep, self.names)
        return rows.select(*[q(c) for c in keep], *[F.col("features")[i].alias(n) for i, n in enumerate(self.names)])

    def vectors(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        rows = self.encoder.vectors(df, keep, self.names)
        return rows.withColumn("features", array_to_vector("features"))


def fit_features(
    df: DataFrame, y: str, key: str, ref: DataFrame | None = None, params: FeatureParams = FeatureParams(), numeric_target: bool = False
) -> tuple[FeaturePlan, DataFrame]:
    """Profile, encode, drop constants, select; also the encoded training rows (key, y, features).

    The reference rows get an encoder of their own over the same column groups
    and within the training vocabularies, so only features that exist in both can
    be chosen. A numeric target is scored by equal-frequency classes. Both inputs
    are held while they are profiled and encoded, and let go of in the end.
    """
    held = [t.persist(StorageLevel.MEMORY_AND_DISK) for t in (df, ref) if t is not None]
    try:
        return _fit_features(df, y, key, ref, params, numeric_target)
    finally:
        for t in held:
            t.unpersist()


def _fit_features(
    df: DataFrame, y: str, key: str, ref: DataFrame | None, params: FeatureParams, numeric_target: bool
) -> tuple[FeaturePlan, DataFrame]:
    inputs = df.drop(key, y)
    groups = group_columns(inputs)
    encoder = Preprocessor.fit(inputs, groups, text_terms=params.text_terms)
    classes = "target class" if numeric_target else y
    labelled = select.target_classes(df, y, classes) if numeric_target else df
    kept = list(dict.fromkeys([key, y, classes]))
    # held as two flat arrays, which take less than half of the room of an array of structs
    flat = [F.col("entries")[c].alias(c) for c in ("j", "x")]
    held = encoder.sparse(labelled, kept).select(*[q(c).alias(f"kept {i}") for i, c in enumerate(kept)], *flat).persist(StorageLevel.MEMORY_AND_DISK)
    rows = held.select(*[q(f"kept {i}").alias(c) for i, c in enumerate(kept)], F.arrays_zip("j", "x").alias("entries"))
    try:
        return FeaturePlan(encoder, chosen := _choose(encoder, rows, classes, ref, groups, params)), _chosen_vectors(rows, key, y, encoder.names(), chosen)
    finally:
        held.unpersist()


def _choose(
    encoder: Preprocessor, rows: DataFrame, y: str, ref: DataFrame | None, groups: ColumnGroups, params: FeatureParams
) -> list[str]:
    """The features chosen from the encoded rows (with sparse entries)."""
    stats = select.sparse_stats(rows, encoder.names(), y)
    mi = select.sparse_information(rows, stats, y, params.bins)
    if ref is None:
        ref_stats = stats
    else:
        ref_inputs = with_absent(ref, encoder.state.kinds)
        ref_encoder = Preprocessor.fit(ref_inputs, groups, within=encoder.state, text_terms=params.text_terms)
        ref_stats = select.sparse_stats(ref_encoder.sparse(ref_inputs), ref_encoder.names())
    return Scores.of(stats, mi, ref_stats, params).names(params.k_features)


def with_absent(ref: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """The reference rows with the columns that they lack, as nulls."""
    absent = {c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in ref.columns}
    return ref.withColumns(absent) if absent else ref


@dataclass
class Scores:
    """Scores of the features that vary; a number of features cuts their ranking."""

    scored: list[select.Scored]
    candidates: list[select.FeatureStats]

    @classmethod
    def of(cls, stats: list, mi: dict[str, float], ref_stats: list, params: FeatureParams) -> Scores:
        kept = set(select.varying(stats))
        candidates = [s for s in stats if s.name in kept]
        if not candidates:
            raise ValueError("no feature varies in the training rows")
        return cls(select.joint_scores(candidates, mi, ref_stats, params.w_f, params.w_mi, params.w_ref, params.min_presence), candidates)

    def names(self, k: int) -> list[str]:
        return select.joint_select(self.scored, k, self.candidates)


def _chosen_vectors(rows: DataFrame, key: str, y: str, names: Sequence[str], chosen: Sequence[str]) -> DataFrame:
    """key, y and the chosen features as a vector, held until the caller lets go of them."""
    place = {n: j for j, n in enumerate(names)}
    # a cell each, not a lambda over them: that would build the map anew for every cell
    there = F.map_from_entries("entries")
    cells = F.array(*[F.coalesce(F.try_element_at(there, F.lit(place[n])), F.lit(0.0)) for n in chosen])
    vectors = rows.select(q(key).alias("key"), q(y).alias("y"), array_to_vector(cells).alias("features")).persist(StorageLevel.MEMORY_AND_DISK)
    vectors.count()
    return vectors


def fold_scores(
    rows: DataFrame, y: str, key: str, folds: int, ref: DataFrame | None = None, params: FeatureParams = FeatureParams()
) -> list[tuple[Preprocessor, Scores]]:
    """Encoder and scores of each fold's training side, from one count of the rows (with `fold`) and one of the reference rows.

    The number of jobs does not depend on the number of folds.
    """
    inputs = [c for c in rows.columns if c not in (key, y, "fold")]
    views = list(range(folds))
    unread = [] if params.text_terms else unread_texts(rows, inputs, q(y), F.col("fold"), views)
    inputs, every = [c for c in inputs if c not in unread], inputs
    counts = ValueCounts.count(rows, inputs, q(y), F.col("fold"))
    groups = column_groups(counts, views)
    for g in groups:
        g.text = [c for c in every if c in unread or c in g.text]
    fitted = encoders(counts, groups, views, text_terms=params.text_terms)
    table = feature_table(counts, fitted, views)
    stats = feature_stats(counts, table, fitted, views)
    mi = information(counts, table, stats, views, params.bins)
    ref_stats = stats
    if ref is not None:
        ref_counts = ValueCounts.count(with_absent(ref, counts.kinds).select(*[q(c) for c in inputs]), inputs)
        whole = [ALL_ROWS] * folds
        ref_fitted = encoders(ref_counts, groups, whole, within=[e.state for e in fitted], text_terms=params.text_terms)
        ref_stats = feature_stats(ref_counts, feature_table(ref_counts, ref_fitted, whole), ref_fitted, whole)
    return [(e, Scores.of(s, m, r, params)) for e, s, m, r in zip(fitted, stats, mi, ref_stats, strict=True)]


def _index(labels: Sequence[str]) -> Column:
    """Class index of y, with the class list as metadata so that every forest knows all classes."""
    code = F
    for i, label in enumerate(labels):
        code = code.when(F.col("y") == F.lit(label), F.lit(float(i)))
    return code.alias("label", metadata={"ml_attr": {"type": "nominal", "name": "label", "vals": list(labels)}})


def _grown(rows: DataFrame, labels: Sequence[str] | None, params: ForestParams, weights: dict[str, float] | None = None):
    """The forest before small nodes are cut back."""
    if params.max_depth > 10:
        ensure_checkpoint_dir(rows.sparkSession)
    if labels is None:
        rows = rows.select("features", F.col("y").cast("double").alias("label"))
        return RandomForestRegressor(**params.settings()).fit(rows)
    chosen = F.lit(1.0)
    if weights:
        chosen = F
        for label, w in weights.items():
            chosen = chosen.when(F.col("y") == F.lit(label), F.lit(w))
    rows = rows.select("features", _index(labels), chosen.alias("weight"))
    return RandomForestClassifier(weightCol="weight", **params.settings()).fit(rows)


def fit_forest(rows: DataFrame, labels: Sequence[str] | None, params: ForestParams, weights: dict[str, float] | None = None):
    """Classifier over `labels`, or regressor on a numeric y if there are none."""
    return with_min_split(_grown(rows, labels, params, weights), params.min_samples_split, rows.sparkSession)


@dataclass
class GroupedForest:
    """A classifier's trees in saved groups, with the trees and nodes of each; a group is read when its trees vote."""

    paths: list[str]
    trees: list[int]
    nodes: list[int]

    def parts(self) -> list[list[int]]:
        """Groups that are held at once."""
        out, held = [], 0
        for i, n in enumerate(self.nodes):
            if not out or held + n > NODES_AT_ONCE:
                out.append([])
                held = 0
            out[-1].append(i)
            held += n
        return out

    def probabilities(self, rows: DataFrame, into: str) -> DataFrame:
        """Adds the class probabilities as an array. Sums over the groups are written after each part, so no plan holds all trees."""
        spark, keep, so_far, written = rows.sparkSession, rows.columns, [], None
        for k, part in enumerate(parts := self.parts()):
            for i, forest in zip(part, together(*[functools.partial(RandomForestClassificationModel.load, self.paths[i]) for i in part]), strict=True):
                rows = forest_probabilities(forest, rows, f"votes {i}")
            votes = [F.transform(q(f"votes {i}"), functools.partial(mul, float(self.trees[i]))) for i in part]
            summed = functools.reduce(lambda a, b: F.zip_with(a, b, add), [*so_far, *votes])
            rows, so_far = rows.select(*[q(c) for c in keep], summed.alias("votes so far")), [q("votes so far")]
            if k + 1 < len(parts):
                rows.write.parquet(folder := scratch_folder(spark))
                if written:
                    remove_folder(spark, written)
                written, rows = folder, spark.read.parquet(folder)
        n = float(sum(self.trees))
        return rows.select(*[q(c) for c in keep], F.transform("votes so far", lambda v: v / n).alias(into))


def tree_groups(params: ForestParams, nodes: int) -> tuple[list[ForestParams], int]:
    """Settings of groups of trees, for trees of so many nodes, with a seed each; and how many of them may grow side by side."""
    each = max(1, NODES_AT_ONCE // GROUPS_AT_ONCE // nodes)
    rounds = -(-params.n_estimators // (each * GROUPS_AT_ONCE))
    number = min(params.n_estimators, rounds * GROUPS_AT_ONCE)
    sizes = [params.n_estimators // number + (i < params.n_estimators % number) for i in range(number)]
    seeds = random.Random(params.random_state)
    return [replace(params, n_estimators=n, random_state=seeds.getrandbits(31)) for n in sizes], max(1, min(GROUPS_AT_ONCE, NODES_AT_ONCE // (nodes * max(sizes))))


def fit_grouped_forest(rows: DataFrame, labels: Sequence[str], params: ForestParams, weights: dict[str, float] | None = None) -> GroupedForest:
    """The classifier of `fit_forest` for more and deeper trees than the driver holds: groups of trees grow side by side and are saved.

    Where trees of the most nodes that the rows allow would not fit, the first tree grows alone and its size tells that of the groups.
    """
    spark = rows.sparkSession

    def grown(group: ForestParams) -> tuple[str, int, int, int]:
        path = scratch_folder(spark)
        forest = _grown(rows, labels, group, weights)
        saved_with_min_split(forest, group.min_samples_split, path, spark)
        return path, group.n_estimators, saved_nodes(spark, path).count(), forest.totalNumNodes

    nodes, done, left = 2 * min(2 ** params.max_depth, max(1, rows.count() // params.min_samples_leaf)), [], params
    if params.n_estimators > 1 and nodes * params.n_estimators > NODES_AT_ONCE:
        done.append(grown(replace(params, n_estimators=1)))
        # other trees may be larger
        nodes, left = min(nodes, done[0][3] * 5 // 4), replace(params, n_estimators=params.n_estimators - 1)
    groups, most = tree_groups(left, nodes)
    done += together(*[functools.partial(grown, g) for g in groups], most=most)
    paths, trees, kept, _ = zip(*done, strict=True)
    return GroupedForest(list(paths), list(trees), list(kept))


def forest_probabilities(model, rows: DataFrame, into: str) -> DataFrame:
    """Adds the class probabilities of one forest as an array."""
    if isinstance(model, GroupedForest):
        return model.probabilities(rows, into)
    model = model.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol(into)
    return model.transform(rows).withColumn(into, vector_to_array(into))


@dataclass
class Sigmoid:
    """Calibrated probability 1 / (1 + exp(-(slope * p + offset)))."""

    slope: float = 0.0
    offset: float = 0.0

    def apply(self, p: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(p * F.lit(self.slope) + F.lit(self.offset))))


def fit_sigmoids(
    held: DataFrame, folds: Sequence[int], labels: Sequence[str], rounds: int = 30, tolerance: float = 1e-6
) -> dict[int, list[Sigmoid]]:
    """One sigmoid per fold and class on held-out probabilities (fold, y, p), with smoothed targets.

    Equal probabilities are counted once, so a round takes the distinct ones, not
    the rows. Newton steps; each round is one pre-aggregated pass for all folds and
    classes. The current values are one constant of folds x classes entries, so
    the code is the same in every round. A step that raises the loss is halved.
    """
    counts = {(r["fold"], r["y"]): r["n"] for r in held.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    code = F.array_position(F.array(*[F.lit(c) for c in labels]), F.col("y")) - 1
    long = held.withColumn("own", code).select("fold", "own", F.posexplode("p").alias("c", "p"))
    values = long.groupBy("fold", "c", (F.col("own") == F.col("c")).alias("hit"), "p").agg(F.count(F.lit(1)).cast("double").alias("w"))
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    few = values.coalesce(max(1, -(-values.count() // CELLS_AT_ONCE)))
    cells = [(f, c) for f in folds for c in range(len(labels))]
    high, low, at = {}, {}, {}
    for f, c in cells:
        size = sum(n for (fold, _), n in counts.items() if fold == f)
        positive = counts.get((f, labels[c]), 0)
        high[f, c], low[f, c] = (positive + 1) / (positive + 2), 1 / (size - positive + 2)
        at[f, c] = (0.0, math.log((positive + 1) / (size - positive + 1)))
    best: dict[tuple[int, int], tuple[float, tuple[float, float], tuple[float, float]]] = {}
    z = F.col("now")["slope"] * F.col("p") + F.col("now")["offset"]
    t = F.when(F.col("hit"), F.col("now")["high"]).otherwise(F.col("now")["low"])
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z")))
    # log(1 + exp(z)) without overflow
    loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("t") * F.col("z")
    weight = F.col("s") * (F.lit(1.0) - F.col("s"))
    sums = [F.sum(F.col("w") * x).alias(n) for n, x in (
        ("loss", loss), ("ga", (F.col("s") - F.col("t")) * F.col("p")), ("gb", F.col("s") - F.col("t")),
        ("haa", weight * F.col("p") * F.col("p")), ("hab", weight * F.col("p")), ("hbb", weight))]
    open_cells = set(cells)
    for _ in range(rounds):
        current = {f"{f} {c}": dict(zip(("slope", "offset", "high", "low"), (*at[f, c], high[f, c], low[f, c]), strict=True)) for f, c in sorted(open_cells)}
        now = F.try_element_at(F.from_json(F.lit(json.dumps(current)), "map<string,struct<slope:double,offset:double,high:double,low:double>>"), F.concat_ws(" ", "fold", "c"))
        rows = few.withColumn("now", now).filter("now IS NOT NULL").withColumn("z", z).withColumn("t", t).withColumn("s", s)
        for row in rows.groupBy("fold", "c").agg(*sums).collect():
            cell = (row["fold"], row["c"])
            if cell in best and row["loss"] > best[cell][0] + 1e-12 * abs(best[cell][0]):
                value, start, step = best[cell]
                step = (step[0] / 2, step[1] / 2)
            else:
                value, start = row["loss"], at[cell]
                haa, hab, hbb, ga, gb = row["haa"] + 1e-9, row["hab"], row["hbb"] + 1e-9, row["ga"], row["gb"]
                det = haa * hbb - hab * hab
                step = (-(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det) if det > 0 else (-ga / haa, -gb / hbb)
            best[cell] = (value, start, step)
            at[cell] = (start[0] + step[0], start[1] + step[1])
            if max(map(abs, step)) < tolerance * (1 + max(map(abs, start))):
                open_cells.discard(cell)
        if not open_cells:
            break
    values.unpersist()
    # a value counts only once its loss was measured
    return {f: [Sigmoid(*best[f, c][1]) for c in range(len(labels))] for f in folds}


@dataclass
class CalibratedForest:
    """Forests of all folds with their sigmoids; probabilities are averaged."""

    labels: list[str]
    forests: list
    sigmoids: list[list[Sigmoid]]

    def probabilities(self, rows: DataFrame, into: str = "probabilities") -> DataFrame:
        """Adds the mean calibrated class probabilities as an array in label order."""
        k = len(self.labels)
        keep = rows.columns
        for i, forest in enumerate(self.forests):
            rows = forest_probabilities(forest, rows, f"raw {i}")
        calibrated = {}
        for i, sigmoids in enumerate(self.sigmoids):
            raw = q(f"raw {i}")
            if k == 2:
                second = sigmoids[1].apply(raw[1])
                calibrated[f"cal {i}"] = F.array(F.lit(1.0) - second, second)
            else:
                calibrated[f"cal {i}"] = F.array(*[s.apply(raw[c]) for c, s in enumerate(sigmoids)])
        rows = rows.withColumns(calibrated)
        sums = {f"sum {i}": total([q(f"cal {i}")[c] for c in range(k)]) for i in range(len(self.forests))}
        rows = rows.withColumns(sums)
        n = len(self.forests)

        def mean(c: int) -> Column:
            return total([F.when(q(f"sum {i}") > 0, q(f"cal {i}")[c] / q(f"sum {i}")).otherwise(1.0 / k) for i in range(n)]) / n

        return rows.select(*[q(c) for c in keep], F.array(*[mean(c) for c in range(k)]).alias(into))


def calibrate(rows: DataFrame, params: ForestParams = ForestParams(), cv: int = 5) -> CalibratedForest:
    """Per fold a class-balanced forest on the other folds, calibrated on the held-out one. Forests grow side by side."""
    seed = params.random_state
    counts = {r["y"]: r["n"] for r in units.class_counts(rows, "y").collect()}
    labels = ordered_labels(sorted(counts))
    folds = list(range(units.fold_count(list(counts.values()), cv)))
    rows = units.stratified_folds(rows.filter("y IS NOT NULL"), "y", "key", len(folds), seed, sum(counts.values()))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    sizes: dict[int, dict[str, int]] = {f: {} for f in folds}
    for r in rows.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect():
        for f in folds:
            if f != r["fold"]:
                sizes[f][r["y"]] = sizes[f].get(r["y"], 0) + r["n"]
    def fitted(f: int) -> Callable[[], object]:
        return lambda: fit_forest(rows.filter(F.col("fold") != f), labels, params, units.class_weights(sizes[f]))

    forests, held = together(*[fitted(f) for f in folds]), None
    for f, forest in zip(folds, forests, strict=True):
        part = forest_probabilities(forest, rows.filter(F.col("fold") == f), "p").select("fold", "y", "p")
        held = part if held is None else held.unionByName(part)
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    sigmoids = fit_sigmoids(held, folds, labels)
    held.unpersist()
    rows.unpersist()
    return CalibratedForest(labels, forests, [sigmoids[f] for f in folds])


@dataclass
class TicketModel:
    """A fitted model: features, calibrated forest (or regression forest) and its settings."""

    plan: FeaturePlan
    classifier: CalibratedForest | None
    regressor: RandomForestRegressionModel | None
    features: FeatureParams
    forest: ForestParams
    classes: list[str] = field(default_factory=list)

    @classmethod
    def fit(
        cls, df: DataFrame, y: str, key: str, ref: DataFrame | None = None, features: FeatureParams = FeatureParams(),
        forest: ForestParams = ForestParams(), model_type: str = "classification", cv: int = 5, plan: FeaturePlan | None = None,
    ) -> TicketModel:
        """Fits on all columns but `key` and `y`. `key` tells rows apart; `ref` defaults to the training rows.

        With a `plan` the features are given, and only the forests are fitted.
        """
        if plan is None:
            plan, rows = fit_features(df, y, key, ref, features, numeric_target=model_type == "regression")
        else:
            rows = plan.vectors(df, [key, y]).select(q(key).alias("key"), q(y).alias("y"), "features").persist(StorageLevel.MEMORY_AND_DISK)
        if model_type == "regression":
            model = cls(plan, None, fit_forest(rows, None, forest), features, forest)
        else:
            classifier = calibrate(rows, forest, cv)
            model = cls(plan, classifier, None, features, forest, classifier.labels)
        rows.unpersist()
        return model

    @property
    def expected_features(self) -> list[str]:
        return self.plan.names

    def transform_features(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self.plan.transform(df, keep)

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns with predicted_lead_time and, for classes, Proba_Max and one proba_<class> each."""
        rows = self.plan.vectors(df, keep)
        if self.regressor is not None:
            scored = self.regressor.copy().setPredictionCol("predicted_lead_time").transform(rows)
            return scored.select(*[q(c) for c in keep], "predicted_lead_time")
        p = F.col("probabilities")
        scored = self.classifier.probabilities(rows)
        top = F.array_max(p)
        label = F.element_at(F.array(*[F.lit(c) for c in self.classes]), F.array_position(p, top).cast("int"))
        return scored.select(
            *[q(c) for c in keep], label.alias("predicted_lead_time"), top.alias("Proba_Max"),
            *[p[i].alias(PREFIX + c) for i, c in enumerate(self.classes)],
        )

    def save(self, path: str, spark: SparkSession, keep: int = 1) -> None:
        """Encoder tables and forests (in Spark's own format) as a new version in `path`.

        A version counts once its settings are in the list of versions, which one
        write adds, so a save that fails leaves the model as it was. Of older
        versions the last `keep` stay for those who still read them.
        """
        known = model_versions(spark, path)
        version = f"versions/{uuid.uuid4().hex}"
        self.plan.encoder.save(f"{path}/{version}", spark)
        forests = self.classifier.forests if self.classifier else [self.regressor]
        for i, forest in enumerate(forests):
            forest.write().save(f"{path}/{version}/forest_{i}")
        meta = {
            "names": self.plan.names, "classes": self.classes, "forests": len(forests),
            "sigmoids": [[asdict(s) for s in fold] for fold in self.classifier.sigmoids] if self.classifier else [],
            "features": asdict(self.features), "forest": asdict(self.forest),
            "model_type": "classification" if self.classifier else "regression",
        }
        number = 1 + max((r["number"] for r in known), default=0)
        spark.createDataFrame([(number, version, json.dumps(meta))], VERSION).coalesce(1).write.mode("append").json(f"{path}/meta")
        for gone in known[: -keep if keep else None][-1:]:
            remove_folder(spark, f"{path}/{gone['version']}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TicketModel:
        """The newest committed version."""
        known = model_versions(spark, path)
        if not known:
            raise FileNotFoundError(f"no saved model in {path}")
        meta, path = json.loads(known[-1]["meta"]), f"{path}/{known[-1]['version']}"
        plan = FeaturePlan(Preprocessor.load(spark, path), meta["names"])
        kind = RandomForestClassificationModel if meta["model_type"] == "classification" else RandomForestRegressionModel
        forests = [kind.load(f"{path}/forest_{i}") for i in range(meta["forests"])]
        settings = (FeatureParams(**meta["features"]), ForestParams(**meta["forest"]))
        if meta["model_type"] == "regression":
            return cls(plan, None, forests[0], *settings)
        sigmoids = [[Sigmoid(**s) for s in fold] for fold in meta["sigmoids"]]
        return cls(plan, CalibratedForest(meta["classes"], forests, sigmoids), None, *settings, meta["classes"])


VERSION = "number long, version string, meta string"


def model_versions(spark: SparkSession, path: str) -> list[Row]:
    """Committed versions of a saved model, oldest first; none if nothing was saved."""
    try:
        rows = spark.read.schema(VERSION).json(f"{path}/meta").collect()  # one row per save
    except AnalysisException:
        return []
    return sorted(rows, key=lambda r: (r["number"], r["version"]))


def _folded(df: DataFrame, y: str, key: str, folds: int, seed: int) -> tuple[DataFrame, int]:
    counts = [r["n"] for r in units.class_counts(df, y).collect()]
    used = units.fold_count(counts, folds)
    return units.stratified_folds(df, y, key, used, seed, sum(counts)).persist(StorageLevel.MEMORY_AND_DISK), used


def _each_fold(
    rows: DataFrame, used: int, y: str, key: str, use: Callable[[int, TicketModel], object], ref: DataFrame | None = None,
    features: FeatureParams = FeatureParams(), model_type: str = "classification", **fit,
) -> list:
    """What `use` makes of each fold's model, of its training side. The features of all folds come from one count (of a
    numeric target: fold by fold); the models are fitted side by side."""
    if model_type == "regression":
        plans = [None] * used
    else:
        plans = [FeaturePlan(e, s.names(features.k_features)) for e, s in fold_scores(rows, y, key, used, ref, features)]

    def fitted(f: int) -> Callable[[], object]:
        side = rows.filter(F.col("fold") != f).drop("fold")
        return lambda: use(f, TicketModel.fit(side, y, key, ref=ref, features=features, model_type=model_type, plan=plans[f], **fit))

    return together(*[fitted(f) for f in range(used)])


def cross_predict(df: DataFrame, y: str, key: str, folds: int = 10, seed: int = 42, **fit) -> DataFrame:
    """Out-of-fold prediction of every row (key, y, fold, pred), written once; encoders, features and forests are each fold's own."""
    rows, used = _folded(df, y, key, folds, seed)

    def predicted(f: int, model: TicketModel) -> DataFrame:
        part = model.transform(rows.filter(F.col("fold") == f), [key, y, "fold"])
        return part.select(q(key), q(y), "fold", F.col("predicted_lead_time").alias("pred"))

    out = materialize(functools.reduce(DataFrame.unionByName, _each_fold(rows, used, y, key, predicted, **fit)))
    rows.unpersist()
    return out


def cross_validate(df: DataFrame, y: str, key: str, folds: int = 5, seed: int = 42, train_scores: bool = True, **fit) -> list[dict]:
    """Accuracy and weighted F1 per fold, on held-out and (optionally) training rows."""
    rows, used = _folded(df, y, key, folds, seed)

    def measured(f: int, model: TicketModel) -> dict:
        scores = {"fold": f}
        for side, part in (("test", rows.filter(F.col("fold") == f)), ("train", rows.filter(F.col("fold") != f))):
            if side == "train" and not train_scores:
                continue
            m = units.metrics(model.transform(part, [y]), y, "predicted_lead_time")
            scores |= {f"{side}_accuracy": m.accuracy, f"{side}_f1_weighted": m.f1_weighted}
        return scores

    out = _each_fold(rows, used, y, key, measured, **fit)
    rows.unpersist()
    return out


@dataclass
class SharedFolds:
    """Folded rows whose encodings and scores all trials of a search share.

    Per fold the rows, held-out ones included, are encoded once, with the features
    of the largest number that is asked for; a trial takes those within its own number.
    """

    rows: DataFrame
    folds: int
    scores: list[Scores]
    names: list[list[str]]
    encoded: list[DataFrame]

    @classmethod
    def prepare(
        cls, df: DataFrame, y: str, key: str, folds: int, seed: int, most: int, ref: DataFrame | None = None, features: FeatureParams = FeatureParams()
    ) -> SharedFolds:
        rows, used = _folded(df, y, key, folds, seed)
        found = fold_scores(rows, y, key, used, ref, features)
        names = [s.names(most) for _, s in found]
        encoded = [
            e.vectors(rows, [key, y, "fold"], n).select(q(key).alias("key"), q(y).alias("y"), "fold", F.col("features").alias("wide")).persist(StorageLevel.MEMORY_AND_DISK)
            for (e, _), n in zip(found, names, strict=True)
        ]
        return cls(rows, used, [s for _, s in found], names, encoded)

    def vectors(self, fold: int, k: int) -> DataFrame:
        """key, y, fold and the vector of the k features of a fold."""
        places = [self.names[fold].index(n) for n in self.scores[fold].names(k)]
        cells = F.array(*[F.col("wide")[i] for i in places])
        return self.encoded[fold].select("key", "y", "fold", array_to_vector(cells).alias("features"))

    def trial(self, k: int, forest: ForestParams, cv: int = 5) -> list[units.Metrics]:
        """Scores on each fold's held-out rows. The folds are fitted side by side."""
        def scored(f: int) -> units.Metrics:
            rows = self.vectors(f, k)
            fitted = calibrate(rows.filter(F.col("fold") != f).drop("fold"), forest, cv)
            p = F.col("probabilities")
            top = F.element_at(F.array(*[F.lit(c) for c in fitted.labels]), F.array_position(p, F.array_max(p)).cast("int"))
            guessed = fitted.probabilities(rows.filter(F.col("fold") == f)).select("y", top.alias("pred"))
            return units.metrics(guessed, "y", "pred")

        return together(*[functools.partial(scored, f) for f in range(self.folds)])

    def release(self) -> None:
        for held in (self.rows, *self.encoded):
            held.unpersist()
