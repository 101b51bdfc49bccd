"""Registered queries over models. Small settings keep them quick; rows and columns are whole. random_forest has the
default settings: 300 trees of depth 30 over up to 140 features.

Forests have no SQL twin, so these queries return what must hold of every row (probabilities sum to one, the label is
the most probable class, a saved model predicts the same) beside what SQL can count: rows, folds, splits, classes.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ticketlens.checks.selection import F_TABLE, MI_TABLE, REF_TABLE, SCALED, neighbours_sql
from ticketlens.fixtures import fixture, held_fixture, with_views
from ticketlens.operators import model, select, trees
from ticketlens.operators.model import FeatureParams, ForestParams, TicketModel
from ticketlens.plans import jobs
from ticketlens.session import scratch_folder

QUERIES = {}
ORACLE = {}

FOREST = ForestParams(n_estimators=5, max_depth=4)
FEATURES = FeatureParams(k_features=12)
# columns of every kind: numbers, dates, one-hot, top-k, frequency, long text, tags of both kinds
INPUTS = [
    "key", "y", "n_price", "n_qty", "n_const", "c_onehot", "c_topk", "c_high", "c_text", "c_date", "t_bin", "t_topk", "extract_date",
]
FIT = {"features": FEATURES, "forest": FOREST, "cv": 2}


class Once:
    """The items of one query, joined once, however often the query reads them."""

    def __init__(self, spark, sf, *columns):
        self.rows = held_fixture(spark, sf, "fx_items", columns)

    def items(self):
        return self.rows.select(*INPUTS)

    def live(self):
        """Items that are not accepted yet serve as reference rows."""
        return self.rows.filter("epic_status <> 'Accepted'").select(*INPUTS)


def _vectors(spark, sf, features=FEATURES):
    read = Once(spark, sf)
    plan, rows = model.fit_features(read.items(), "y", "key", read.live(), features)
    return plan, rows


def _transform_features(spark, sf):
    rows = fixture(spark, sf, "fx_items").select("key", "y", "n_qty", "n_const", "c_onehot", "extract_date")
    plan, _ = model.fit_features(rows, "y", "key", None, FeatureParams(k_features=99, min_presence=0.0))
    out = plan.transform(rows, ["key"])
    return out.select("key", *[F.round(f"`{c}`", 6).alias(c) for c in out.columns if c != "key"])


MODE = "(SELECT c_onehot FROM fx_items WHERE c_onehot IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, c_onehot LIMIT 1)"
QUERIES["transform_features"] = _transform_features
ORACLE["transform_features"] = with_views(
    "SELECT key, round((n_qty - avg(n_qty) OVER ()) / stddev_pop(n_qty) OVER (), 6) AS num__n_qty, " + ", ".join(
        f"CAST(CASE WHEN coalesce(c_onehot, {MODE}) = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS \"onehot__c_onehot_{v}\""
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
    + ", CAST(year(extract_date) AS DOUBLE) AS date__extract_date_year, CAST(month(extract_date) AS DOUBLE) AS date__extract_date_month FROM fx_items", "fx_items")


def _laws(p) -> list:
    """What holds of an array of class probabilities."""
    total = F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    return [
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"), F.forall(p, lambda x: (x >= 0) & (x <= 1)).alias("in_range"),
        F.size(p).alias("n_classes"),
    ]


LAWS_SQL = "TRUE AS sums_to_one, TRUE AS in_range, CAST((SELECT count(DISTINCT y) FROM fx_items) AS INTEGER) AS n_classes"
LIVE_SQL = "FROM fx_items WHERE epic_status <> 'Accepted'"


def _sql(select_text: str) -> str:
    return with_views(select_text, "fx_items")


def _random_forest(spark, sf):
    """The whole default forest, in groups of trees."""
    _, rows = _vectors(spark, sf, FeatureParams())
    labels = sorted(r["y"] for r in rows.select("y").distinct().collect())
    forest = model.fit_grouped_forest(rows, labels, ForestParams())
    return model.forest_probabilities(forest, rows, "p").select("key", "y", *_laws(F.col("p")))


FLAGS = {"urgent": "CASE WHEN c_onehot = '1-URGENT' THEN 1 ELSE 0 END", "promo": "CASE WHEN t_bin LIKE '%PROMO%' THEN 1 ELSE 0 END",
         "priced": "CASE WHEN n_price > 250000 THEN 1 ELSE 0 END", "large": "CASE WHEN t_bin LIKE '%LARGE%' THEN 1 ELSE 0 END"}


def _forest_nodes(spark, sf):
    """Class probabilities by walking the node table of one tree, whose nodes with less than half of the rows are not split."""
    flags = fixture(spark, sf, "fx_items").selectExpr("key", "y", f"array({', '.join(f'CAST({x} AS DOUBLE)' for x in FLAGS.values())}) AS cells").cache()
    labels = sorted(r["y"] for r in flags.select("y").distinct().collect())
    params = ForestParams(n_estimators=1, max_depth=2, min_samples_split=(flags.count() + 1) // 2, min_samples_leaf=1, max_features="all", bootstrap=False)
    forest = model.fit_forest(flags.select("y", array_to_vector("cells").alias("features")), labels, params)
    folder = scratch_folder(spark)
    forest.write().save(folder)
    nodes = trees.node_table(trees.saved_nodes(spark, folder))
    walked = trees.walked_probabilities(flags.select("key", F.col("cells").alias("features")), nodes, 2)
    return walked.select("key", F.posexplode("p").alias("c", "p")).select("key", F.get(F.array(*[F.lit(c) for c in labels]), F.col("c")).alias("y"), F.round("p", 6).alias("p"))


def _impure(level: str, source: str, by: str) -> str:
    """best_<level>: the flag whose two sides are least impure, per group of `by`."""
    return f"""
side_{level} AS (SELECT {by}, flag, v, sum(n) AS n, sum(n) - sum(n * n) / sum(n) AS impure FROM (
  SELECT {by}, flag, v, y, CAST(count(*) AS DOUBLE) AS n FROM {source} GROUP BY {by}, flag, v, y) GROUP BY {by}, flag, v),
best_{level} AS (SELECT {by}, flag FROM (
  SELECT {by}, flag, row_number() OVER (PARTITION BY {by} ORDER BY impure, flag) AS place FROM (
    SELECT {by}, flag, sum(impure) AS impure FROM side_{level} GROUP BY {by}, flag HAVING count(*) = 2)) WHERE place = 1)"""


def _shares(name: str, source: str, by: str) -> str:
    """<name>: class shares per group of `by`; <name>_top: rows and the likeliest class."""
    return f"""
{name} AS (SELECT {by}, y, n / sum(n) OVER (PARTITION BY {by}) AS p, sum(n) OVER (PARTITION BY {by}) AS size FROM (SELECT {by}, y, count(*) AS n FROM {source} GROUP BY {by}, y)),
{name}_top AS (SELECT {by}, size, y AS top FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY p DESC, y) AS place FROM {name}) WHERE place = 1)"""


FOREST_SQL = "long AS (" + " UNION ALL ".join(f"SELECT key, y, 0 AS root, {i} AS flag, {x} AS v FROM fx_items" for i, x in enumerate(FLAGS.values())) + "),"
FOREST_SQL += _impure("a", "long", "root") + ",\nfirst AS (SELECT l.key, l.y, l.v AS node FROM long l JOIN best_a b ON l.flag = b.flag),"
FOREST_SQL += "\nbelow AS (SELECT l.key, l.y, f.node, l.flag, l.v FROM long l JOIN first f ON l.key = f.key),"
FOREST_SQL += _impure("b", "below", "node") + ",\nleaves AS (SELECT l.key, l.y, l.node, l.v AS leaf FROM below l JOIN best_b b ON l.node = b.node AND l.flag = b.flag),"
FOREST_SQL += _shares("root_shares", "(SELECT *, 0 AS root FROM first)", "root") + "," + _shares("node_shares", "first", "node") + ","
FOREST_SQL += _shares("leaf_shares", "leaves", "node, leaf") + """,
-- leaves beside each other with one likeliest class are one leaf
merged AS (SELECT n.node, n.size, n.top, count(DISTINCT l.top) < 2 AS is_leaf FROM node_shares_top n LEFT JOIN leaf_shares_top l ON n.node = l.node GROUP BY n.node, n.size, n.top),
whole AS (SELECT bool_and(is_leaf) AND count(DISTINCT top) = 1 AS is_leaf FROM merged),
reached AS (
  SELECT f.key, f.node, l.leaf, w.is_leaf AS at_root, m.is_leaf OR m.size < (SELECT (count(*) + 1) // 2 FROM fx_items) AS at_node
  FROM first f JOIN merged m ON f.node = m.node CROSS JOIN whole w LEFT JOIN leaves l ON l.key = f.key),
labels AS (SELECT DISTINCT y FROM fx_items)
SELECT r.key, c.y, round(coalesce(CASE WHEN at_root THEN a.p WHEN at_node THEN b.p ELSE d.p END, 0), 6) AS p
FROM reached r CROSS JOIN labels c LEFT JOIN root_shares a ON a.y = c.y LEFT JOIN node_shares b ON b.node = r.node AND b.y = c.y
LEFT JOIN leaf_shares d ON d.node = r.node AND d.leaf = r.leaf AND d.y = c.y"""


def _regression(spark, sf):
    """Means of targets stay within the targets."""
    rows = Once(spark, sf, *INPUTS).items().withColumn("y", F.regexp_replace("y", "\\+", "").cast("double"))
    fitted = TicketModel.fit(rows, "y", "key", features=FEATURES, forest=FOREST, model_type="regression")
    low, high = rows.agg(F.min("y"), F.max("y")).first()
    return fitted.transform(rows, ["key", "y"]).select("key", "y", F.col("predicted_lead_time").between(low, high).alias("within"))


def _calibrate(spark, sf):
    _, rows = _vectors(spark, sf)
    fitted = model.calibrate(rows, FOREST, 2)
    return fitted.probabilities(rows).select("key", "y", *_laws(F.col("probabilities")))


def _fit(read):
    return TicketModel.fit(read.items(), "y", "key", read.live(), **FIT)


def _model_fit(spark, sf):
    """A model over all column kinds: as many features as asked for, each once, in training order, of the encoder's."""
    fitted = _fit(Once(spark, sf))
    chosen, known = fitted.expected_features, fitted.plan.encoder.names()
    places = [known.index(n) for n in chosen if n in known]
    row = (len(chosen), len(set(chosen)), places == sorted(places) and len(places) == len(chosen), len(fitted.classes))
    return spark.createDataFrame([row], "n_features int, n_names int, in_order boolean, n_classes int")


# encoded features of the small model: numbers scaled, flags and date parts as they are, in training order
SMALL = ["n_price", "n_qty", "n_const", "c_onehot", "extract_date"]
FILLED = "coalesce(n_price, (SELECT median(n_price) FROM fx_items))"
ENCODED = {
    "num__n_const": "CAST(0 AS DOUBLE)",
    "num__n_price": f"({FILLED} - avg({FILLED}) OVER ()) / stddev_pop({FILLED}) OVER ()",
    "num__n_qty": "(n_qty - avg(n_qty) OVER ()) / stddev_pop(n_qty) OVER ()",
    **{
        f"onehot__c_onehot_{v}": f"CASE WHEN coalesce(c_onehot, {MODE}) = '{v}' THEN 1.0 ELSE 0.0 END"
        for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    },
    "date__extract_date_year": "CAST(year(extract_date) AS DOUBLE)", "date__extract_date_month": "CAST(month(extract_date) AS DOUBLE)",
}


def _model_features(spark, sf):
    """The features that a model over a few columns chooses, with their place."""
    rows = fixture(spark, sf, "fx_items").select("key", "y", *SMALL)
    fitted = TicketModel.fit(rows, "y", "key", features=FeatureParams(k_features=4, bins=10), forest=FOREST, cv=2)
    return select.score_table(spark, list(enumerate(fitted.expected_features)), "place int, feature string")


def _model_features_sql() -> str:
    wide = "enc AS (SELECT y, " + ", ".join(f'{x} AS "{n}"' for n, x in ENCODED.items()) + " FROM fx_items)"
    long = "long AS (" + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {i} AS ord, y, \"{n}\" AS x FROM enc" for i, n in enumerate(ENCODED)) + ")"
    scaled = SCALED.replace("JOIN ref_table", "JOIN ref_rows")
    # without reference rows the training rows are their own reference; constants are never scored
    ref = REF_TABLE.replace("ref_table", "ref_rows").split(" WHERE ")[0] + " GROUP BY 1)"
    varied = "long0 AS (SELECT *, max(x) OVER (PARTITION BY feature) > min(x) OVER (PARTITION BY feature) AS varied FROM long_all), long AS (SELECT * FROM long0 WHERE varied)"
    return (
        with_views("", "fx_items").rstrip() + ",\n" + wide + ",\n" + long.replace("long AS", "long_all AS", 1) + ",\n" + varied
        + F_TABLE + MI_TABLE + ref + scaled + """,
best AS (SELECT feature, ord, row_number() OVER (ORDER BY
  CASE WHEN cov >= 0.05 THEN 0.85 * (0.5 * fn + 0.5 * mn) + 0.15 * (CASE WHEN varies THEN cn ELSE 0 END) ELSE 0 END DESC, ord) AS place FROM scaled)
SELECT CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS place, feature FROM best WHERE place <= 4""")


def _predicted(rows):
    """key and what holds of a prediction: its label is the most probable class."""
    labels = [c for c in rows.columns if c.startswith("proba_")]
    p = F.array(*[F.col(f"`{c}`") for c in labels])
    top = F.element_at(F.array(*[F.lit(c.removeprefix("proba_")) for c in labels]), F.array_position(p, F.array_max(p)).cast("int"))
    return rows.select(
        "key", (F.col("predicted_lead_time") == top).alias("label_is_top"), (F.col("Proba_Max") == F.array_max(p)).alias("max_is_top"), *_laws(p)
    )


PREDICTED_SQL = f"SELECT key, TRUE AS label_is_top, TRUE AS max_is_top, {LAWS_SQL} {LIVE_SQL}"


def _predict(spark, sf):
    read = Once(spark, sf)
    return _predicted(_fit(read).transform(read.live(), ["key"]))


def _model_io(spark, sf):
    """A saved and loaded model predicts what it did before."""
    folder, read = scratch_folder(spark), Once(spark, sf)
    fitted = _fit(read)
    fitted.save(folder, spark)
    before = fitted.transform(read.live(), ["key"])
    after = TicketModel.load(spark, folder).transform(read.live(), ["key"])
    names = [c for c in before.columns if c.startswith("proba_")]
    both = before.join(after.select("key", *[F.col(f"`{c}`").alias(f"again {c}") for c in names], F.col("predicted_lead_time").alias("again")), "key")
    same = F.col("predicted_lead_time") == F.col("again")
    for c in names:
        same = same & (F.abs(F.col(f"`{c}`") - F.col(f"`again {c}`")) < 1e-12)
    return both.select("key", same.alias("same"))


def _cross_predict(spark, sf):
    read = Once(spark, sf)
    rows = model.cross_predict(read.items(), "y", "key", 2, ref=read.live(), **FIT)
    known = [r["y"] for r in read.items().select("y").distinct().collect()]
    return rows.select("key", "y", "fold", F.col("pred").isin(known).alias("known_class"))


def _cross_validate(spark, sf):
    """Scores of each fold are shares, and better than none on the rows that were trained on."""
    read = Once(spark, sf)
    rows = model.cross_validate(read.items(), "y", "key", 2, ref=read.live(), **FIT)
    shares = [all(0 <= r[c] <= 1 for c in r if c != "fold") and r["train_accuracy"] > 0 for r in rows]
    return spark.createDataFrame([(r["fold"], ok) for r, ok in zip(rows, shares)], "fold int, are_shares boolean")


def _fold_scores(spark, sf):
    """F and neighbour information of every feature on the training side of each fold, all from one count of the values."""
    rows = Once(spark, sf, "key", "y", *SMALL).rows
    folded, used = model._folded(rows, "y", "key", 2, 42)
    found = [(f, s.name, round(s.f, 4), round(s.mi, 6)) for f, (_, scores) in enumerate(model.fold_scores(folded, "y", "key", used)) for s in scores.scored]
    return select.score_table(spark, found, "fold int, feature string, f double, mi double")


def _fold_ranking(spark, sf):
    """The ranking that the trials of a search cut: place of each feature per fold, by F and binned information."""
    rows = Once(spark, sf, "key", "y", *SMALL).rows
    shared = model.SharedFolds.prepare(rows, "y", "key", 2, 42, 6, features=FeatureParams(bins=10))
    found = [(f, k, n) for f in range(shared.folds) for k in (2, 6) for n in shared.scores[f].names(k)]
    shared.release()
    return select.score_table(spark, found, "fold int, k_features int, feature string")


FOLD = "CAST((row_number() OVER (PARTITION BY y ORDER BY md5(CAST(key AS VARCHAR) || ':42'), key) - 1) % 2 AS INTEGER)"
# training sides: rows of the other fold, each side with its own median, mode, mean and deviation
SIDES = f"""folds AS (SELECT key, y, n_price, n_qty, c_onehot, extract_date, {FOLD} AS fold FROM fx_items),
sides AS (SELECT f.*, CAST(v.range AS INTEGER) AS side FROM folds f JOIN range(2) v ON f.fold <> v.range),
modes AS (SELECT side, c_onehot AS mode FROM (SELECT side, c_onehot, row_number() OVER (PARTITION BY side ORDER BY count(*) DESC, c_onehot) AS place
          FROM sides WHERE c_onehot IS NOT NULL GROUP BY 1, 2) WHERE place = 1),
filled AS (SELECT s.side, y, coalesce(n_price, median(n_price) OVER (PARTITION BY s.side)) AS price, n_qty, coalesce(c_onehot, mode) AS kind, extract_date
           FROM sides s JOIN modes m ON s.side = m.side),
long AS (""" + " UNION ALL ".join(f"SELECT side, '{name}' AS feature, {i} AS ord, y, {x} AS x FROM filled" for i, (name, x) in enumerate({
    "num__n_price": "(price - avg(price) OVER (PARTITION BY side)) / stddev_pop(price) OVER (PARTITION BY side)",
    "num__n_qty": "(n_qty - avg(n_qty) OVER (PARTITION BY side)) / stddev_pop(n_qty) OVER (PARTITION BY side)",
    **{f"onehot__c_onehot_{v}": f"CASE WHEN kind = '{v}' THEN 1.0 ELSE 0.0 END" for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")},
    "date__extract_date_year": "CAST(year(extract_date) AS DOUBLE)", "date__extract_date_month": "CAST(month(extract_date) AS DOUBLE)",
}.items())) + """),
per_class AS (SELECT side, feature, ord, y, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM long GROUP BY 1, 2, 3, 4),
overall AS (SELECT side, feature, count(*) AS n, avg(x) AS m FROM long GROUP BY 1, 2),
f_table AS (SELECT c.side, c.feature, c.ord, (sum(c.n * (c.m - o.m) * (c.m - o.m)) / (count(*) - 1)) / (sum((c.n - 1) * coalesce(c.v, 0)) / (any_value(o.n) - count(*))) AS f
            FROM per_class c JOIN overall o ON o.side = c.side AND o.feature = c.feature GROUP BY 1, 2, 3)"""
BINNED = """,
edges AS (SELECT side, feature, list_distinct(quantile_disc(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e, count(DISTINCT x) AS d FROM long GROUP BY 1, 2),
cells AS (SELECT l.side, l.feature, l.y, CASE WHEN d <= 2 THEN x ELSE len(list_filter(e, lambda t: l.x > t)) END AS bin, count(*) AS n
          FROM long l JOIN edges ON edges.side = l.side AND edges.feature = l.feature GROUP BY ALL),
sums AS (SELECT *, sum(n) OVER (PARTITION BY side, feature) AS total, sum(n) OVER (PARTITION BY side, feature, bin) AS of_bin,
                sum(n) OVER (PARTITION BY side, feature, y) AS of_y FROM cells),
bin_table AS (SELECT side, feature, greatest(0, sum(n / total * ln(n * total / (of_bin * of_y)))) AS mi FROM sums GROUP BY 1, 2),
cover AS (SELECT side, feature, avg(CASE WHEN x <> 0 THEN 1.0 ELSE 0.0 END) AS cov FROM long GROUP BY 1, 2),
scaled AS (SELECT f.side, f.feature, f.ord, (f - min(f) OVER w) / (max(f) OVER w - min(f) OVER w) AS fn, (mi - min(mi) OVER w) / (max(mi) OVER w - min(mi) OVER w) AS mn,
                  (cov - min(cov) OVER w) / (max(cov) OVER w - min(cov) OVER w) AS cn, cov
           FROM f_table f JOIN bin_table b ON b.side = f.side AND b.feature = f.feature JOIN cover c ON c.side = f.side AND c.feature = f.feature
           WINDOW w AS (PARTITION BY f.side)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY round(CASE WHEN cov >= 0.05 THEN 0.85 * (0.5 * fn + 0.5 * mn) + 0.15 * cn ELSE 0 END, 9) DESC, ord) AS place FROM scaled)"""


def _text_terms(spark, sf):
    """TF-IDF columns of a long text among the features that a model chooses; of each row those that are not 0."""
    rows = Once(spark, sf, "key", "y", "n_qty", "c_text").rows
    plan, held = model.fit_features(rows, "y", "key", None, FeatureParams(k_features=99, min_presence=0.0, text_terms=12, bins=10))
    held.unpersist()
    names = [n for n in plan.names if n.startswith("text__")]
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.round(f"`{n}`", 6).alias("x")) for n in names])
    return plan.transform(rows, ["key"]).select("key", F.inline(cells)).filter("x <> 0")


def _config(spark):
    folder = scratch_folder(spark)
    return jobs.JobConfig(
        model_dir=f"{folder}/models", results_dir=f"{folder}/results", metrics_dir=f"{folder}/metrics", ledger_path=f"{folder}/ledger",
        target="y", id_column="key", row_key=("key",), drop=("key",), cv_folds=2, calibration_folds=2,
        features=FEATURES, forest=FOREST, groups={"Finished": ["Accepted"], "Rest": ["Open", "Planned"]})


UNIT_SQL = "CASE WHEN epic_status = 'Accepted' THEN 'Finished' ELSE 'Rest' END"


def _train_units(spark, sf):
    """Both units with their folds and the sizes of the split."""
    read = Once(spark, sf)
    rows = jobs.train(spark, read.rows, read.rows, _config(spark))
    shares = [F.col(c).between(0, 1) for c in ("acc_oof", "f1w_oof", "acc_test", "f1w_test")]
    return rows.select("unit_name", "cv_folds", "n_train", "n_test", (shares[0] & shares[1] & shares[2] & shares[3]).alias("are_shares"))


def _predict_units(spark, sf):
    config = _config(spark)
    rows = Once(spark, sf).rows
    for unit in jobs.planned(rows, config):
        part = jobs._unit_rows(rows, unit, config)
        TicketModel.fit(part, "y", jobs.ROW_KEY, **FIT).save(jobs.model_path(unit, config), spark)
    out = jobs.predict(spark, rows, config, ["n_price", "c_onehot"], "2024-07-01 10:00:00")
    filled = F.round("data_quality", 6).alias("data_quality")
    return out.select("epic_key", "model_name", "last_prediction_at", filled, F.col("trust_score_v2").between(0, 1).alias("trusted"))


def _search(spark, sf):
    """The best trial is the best, and was drawn from the space."""
    space = jobs.SearchSpace(k_features=(6, 12), n_estimators=(2, 4), max_depth=(3, 5))
    read = Once(spark, sf)
    trials = jobs.search(read.items(), "y", "key", space, 2, 42, 2, ref=read.live(), cv=2)
    best = jobs.best_trial(trials).first()
    top = trials.agg(F.max("f1w").alias("top"), F.count(F.lit(1)).alias("n_trials"))
    return top.select("n_trials", (F.col("top") == best["f1w"]).alias("is_best"), F.lit(best["k_features"] in (6, 12)).alias("in_space"))


QUERIES["forest_nodes"] = _forest_nodes
ORACLE["forest_nodes"] = with_views("", "fx_items").rstrip() + ",\n" + FOREST_SQL
QUERIES["random_forest"] = _random_forest
ORACLE["random_forest"] = _sql(f"SELECT key, y, {LAWS_SQL} FROM fx_items")
QUERIES["random_forest_regression"] = _regression
ORACLE["random_forest_regression"] = _sql("SELECT key, CAST(replace(y, '+', '') AS DOUBLE) AS y, TRUE AS within FROM fx_items")
QUERIES["calibrate"] = _calibrate
ORACLE["calibrate"] = ORACLE["random_forest"]
QUERIES["model_fit"] = _model_fit
ORACLE["model_fit"] = _sql("SELECT 12 AS n_features, 12 AS n_names, TRUE AS in_order, CAST(count(DISTINCT y) AS INTEGER) AS n_classes FROM fx_items")
QUERIES["model_features"] = _model_features
ORACLE["model_features"] = _model_features_sql()
QUERIES["predict"] = _predict
ORACLE["predict"] = _sql(PREDICTED_SQL)
QUERIES["model_io"] = _model_io
ORACLE["model_io"] = _sql(f"SELECT key, TRUE AS same {LIVE_SQL}")
QUERIES["cross_predict"] = _cross_predict
ORACLE["cross_predict"] = _sql("""
SELECT key, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(CAST(key AS VARCHAR) || ':42'), key) - 1) % 2 AS INTEGER) AS fold,
       TRUE AS known_class FROM fx_items""")
QUERIES["cross_validate"] = _cross_validate
ORACLE["cross_validate"] = "SELECT CAST(range AS INTEGER) AS fold, TRUE AS are_shares FROM range(2)"
QUERIES["model_text_terms"] = _text_terms
ORACLE["model_text_terms"] = with_views("", "fx_items").rstrip() + """,
words AS (SELECT key, unnest(string_split(lower(c_text), ' ')) AS term FROM fx_items),
seen AS (SELECT term, count(DISTINCT key) AS n FROM words WHERE term <> '' GROUP BY 1 ORDER BY n DESC, term LIMIT 12),
total AS (SELECT count(*) AS n FROM fx_items)
SELECT w.key, 'text__c_text_' || w.term AS feature, round(count(*) * ln((any_value(t.n) + 1.0) / (any_value(s.n) + 1.0)), 6) AS x
FROM words w JOIN seen s ON s.term = w.term CROSS JOIN total t WHERE s.n < t.n GROUP BY 1, 2"""
QUERIES["fold_scores"] = _fold_scores
ORACLE["fold_scores"] = with_views("", "fx_items").rstrip() + ",\n" + SIDES + neighbours_sql("side, feature") + """
SELECT f.side AS fold, f.feature, round(f, 4) AS f, round(mi, 6) AS mi FROM f_table f JOIN near_table n ON n.side = f.side AND n.feature = f.feature"""
QUERIES["fold_ranking"] = _fold_ranking
ORACLE["fold_ranking"] = with_views("", "fx_items").rstrip() + ",\n" + SIDES + BINNED + """
SELECT side AS fold, CAST(k AS INTEGER) AS k_features, feature FROM ranked JOIN (VALUES (2), (6)) v(k) ON place <= k"""
QUERIES["train_units"] = _train_units
ORACLE["train_units"] = with_views("", "fx_items").rstrip() + f""",
sizes AS (SELECT {UNIT_SQL} AS unit_name, y, count(*) AS n FROM fx_items GROUP BY 1, 2)
SELECT unit_name, 2 AS cv_folds, CAST(sum(n - floor(n * 0.2 + 0.5)) AS BIGINT) AS n_train, CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) AS n_test,
       TRUE AS are_shares FROM sizes GROUP BY 1"""
QUERIES["predict_units"] = _predict_units
ORACLE["predict_units"] = _sql(f"""
SELECT key AS epic_key, 'group_' || lower({UNIT_SQL}) AS model_name, '2024-07-01 12:00:00' AS last_prediction_at,
       round(((n_price IS NOT NULL)::INT + (c_onehot IS NOT NULL)::INT) / 2.0, 6)::DOUBLE AS data_quality, TRUE AS trusted FROM fx_items""")
QUERIES["param_search"] = _search
ORACLE["param_search"] = "SELECT CAST(2 AS BIGINT) AS n_trials, TRUE AS is_best, TRUE AS in_space"
