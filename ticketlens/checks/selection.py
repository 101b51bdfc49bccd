"""Registered queries over feature scores, units, splits and metrics, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlens.fixtures import fixture, with_views
from ticketlens.functions.text import slug
from ticketlens.operators import select, units

QUERIES = {}
ORACLE = {}

# features of the fixture items: a number with gaps, a number, a constant, two flags
FEATURES = {
    "price": "coalesce(n_price, 0)", "qty": "n_qty", "const": "n_const",
    "urgent": "CASE WHEN c_onehot = '1-URGENT' THEN 1 ELSE 0 END", "promo": "CASE WHEN t_bin LIKE '%PROMO%' THEN 1 ELSE 0 END",
}
NAMES = list(FEATURES)
# the reference rows are the open items
REF = "epic_status = 'Open'"


def items(spark, sf):
    return fixture(spark, sf, "fx_items")


def featured(spark, sf, where="true"):
    wide = items(spark, sf).filter(where).selectExpr("key", "y", *[f"{e} AS {n}" for n, e in FEATURES.items()])
    return select.with_features(wide, NAMES, ["key", "y"])


def stats(spark, sf):
    return select.feature_stats(featured(spark, sf), NAMES, "y")


WIDE = "wide AS (SELECT key, y, epic_status, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in FEATURES.items()) + " FROM fx_items)"
ROWS = WIDE + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feature, {i} AS ord, key, y, epic_status, {n} AS x FROM wide" for i, n in enumerate(NAMES)) + ")"
F_TABLE = """,
per_class AS (SELECT feature, ord, y, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM long GROUP BY 1, 2, 3),
overall AS (SELECT feature, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY 1),
f_table AS (SELECT c.feature, c.ord, CASE WHEN any_value(o.v) > 0 THEN (sum(c.n * (c.m - o.m) * (c.m - o.m)) / (count(*) - 1)) / (sum((c.n - 1) * coalesce(c.v, 0)) / (any_value(o.n) - count(*))) ELSE 0 END AS f
            FROM per_class c JOIN overall o ON o.feature = c.feature GROUP BY 1, 2)"""
MI_TABLE = """,
edges AS (SELECT feature, list_distinct(quantile_disc(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e, count(DISTINCT x) AS d FROM long GROUP BY 1),
binned AS (SELECT l.feature, l.y, CASE WHEN d <= 2 THEN x ELSE len(list_filter(e, lambda t: l.x > t)) END AS bin FROM long l JOIN edges ON edges.feature = l.feature),
cells AS (SELECT feature, bin, y, count(*) AS n FROM binned GROUP BY 1, 2, 3),
cell_sums AS (SELECT *, sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY feature, bin) AS of_bin, sum(n) OVER (PARTITION BY feature, y) AS of_y FROM cells),
mi_table AS (SELECT feature, greatest(0, sum(n / total * ln(n * total / (of_bin * of_y)))) AS mi FROM cell_sums GROUP BY 1)"""
REF_TABLE = f""",
ref_table AS (SELECT feature, avg(CASE WHEN x <> 0 THEN 1.0 ELSE 0.0 END) AS cov, max(x) > min(x) AS varies, var_samp(x) AS v,
                     count(*) FILTER (WHERE x <> 0) AS present, count(*) AS n FROM long WHERE {REF} GROUP BY 1)"""


def sql(query: str, *tables: str) -> str:
    return with_views("", "fx_items").rstrip() + ",\n" + ROWS + "".join(tables) + "\n" + query


def _table(spark, rows, schema):
    return select.score_table(spark, rows, schema)


def _variance(spark, sf):
    seen = stats(spark, sf)
    kept = set(select.varying(seen))
    return _table(spark, [(s.name, round(s.variance, 4), s.name in kept) for s in seen], "feature string, variance double, kept boolean")


QUERIES["variance_filter"] = _variance
ORACLE["variance_filter"] = sql("SELECT feature, round(var_pop(x), 4) AS variance, var_pop(x) > 0 AS kept FROM long GROUP BY 1")
QUERIES["anova_f"] = lambda spark, sf: _table(spark, [(s.name, round(select.f_score(s), 6)) for s in stats(spark, sf)], "feature string, f double")
ORACLE["anova_f"] = sql("SELECT feature, round(f, 6) AS f FROM f_table", F_TABLE)


def _mutual_info(spark, sf):
    mi = select.mutual_info(featured(spark, sf), stats(spark, sf), "y")
    return _table(spark, [(n, round(mi[n], 6)) for n in NAMES], "feature string, mi double")


QUERIES["mutual_info"] = _mutual_info
ORACLE["mutual_info"] = sql("SELECT feature, round(mi, 6) AS mi FROM mi_table", MI_TABLE)


def digamma_sql(n: str) -> str:
    """Digamma of a whole number: series ten places on, and back."""
    m = f"(({n}) + 10.0)"
    back = " + ".join(f"1.0 / (({n}) + {j})" for j in range(10))
    return f"(ln{m} - 0.5 / {m} - 1.0 / (12 * pow({m}, 2)) + 1.0 / (120 * pow({m}, 4)) - 1.0 / (252 * pow({m}, 6)) - ({back}))"


def neighbours_sql(by: str, source: str = "long") -> str:
    """near_table: mutual information by three neighbours for each group of `by`, over window frames of the neighbour's distance."""
    gaps = ", ".join([f"x - lag(x, {k}) OVER w" for k in (1, 2, 3)] + [f"lead(x, {k}) OVER w - x" for k in (1, 2, 3)])
    reach = "r * (1 - 1e-9)"
    return f""",
points AS (SELECT * FROM (SELECT {by}, y, CAST(x AS DOUBLE) AS x, count(*) OVER (PARTITION BY {by}, y) AS size FROM {source}) WHERE size > 1),
radii AS (SELECT *, list_sort(list_filter([{gaps}], lambda d: d IS NOT NULL))[least(3, size - 1)] AS r FROM points WINDOW w AS (PARTITION BY {by}, y ORDER BY x)),
within AS (SELECT *, least(3, size - 1) AS k, count(*) OVER (PARTITION BY {by}, y, x) AS same_class, count(*) OVER (PARTITION BY {by}, x) AS same,
                  count(*) OVER (PARTITION BY {by} ORDER BY x RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING) AS inside FROM radii),
near_table AS (SELECT {by}, greatest(0, {digamma_sql("count(*)")} + avg({digamma_sql("CASE WHEN r = 0 THEN same_class ELSE k END")}
                 - {digamma_sql("size")} - {digamma_sql("CASE WHEN r = 0 THEN same ELSE inside END")})) AS mi FROM within GROUP BY ALL)"""


def _mutual_info_neighbours(spark, sf):
    mi = select.mutual_info(featured(spark, sf), stats(spark, sf), "y", bins=None)
    return _table(spark, [(n, round(mi[n], 6)) for n in NAMES], "feature string, mi double")


QUERIES["mutual_info_neighbours"] = _mutual_info_neighbours
ORACLE["mutual_info_neighbours"] = sql("SELECT feature, round(mi, 6) AS mi FROM near_table", neighbours_sql("feature"))


def _minmax(spark, sf):
    scaled = select.minmax([select.f_score(s) for s in stats(spark, sf)])
    return _table(spark, [(n, round(v, 6)) for n, v in zip(NAMES, scaled)], "feature string, scaled double")


QUERIES["minmax_safe"] = _minmax
ORACLE["minmax_safe"] = sql("SELECT feature, round((f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ()), 6) AS scaled FROM f_table", F_TABLE)


def _ref(spark, sf):
    return select.feature_stats(featured(spark, sf, REF), NAMES)


QUERIES["coverage"] = lambda spark, sf: _table(
    spark, [(s.name, round(select.coverage(s), 6), s.varies) for s in _ref(spark, sf)], "feature string, coverage double, varies boolean")
ORACLE["coverage"] = sql("SELECT feature, round(CAST(cov AS DOUBLE), 6) AS coverage, varies FROM ref_table", REF_TABLE)


def _joint(spark, sf):
    seen = stats(spark, sf)
    scores = select.joint_scores(seen, select.mutual_info(featured(spark, sf), seen, "y"), _ref(spark, sf))
    chosen = select.joint_select(scores, 3, seen)
    return _table(spark, [(s.name, round(s.combined, 6), s.name in chosen) for s in scores], "feature string, score double, chosen boolean")


SCALED = """,
scaled AS (SELECT f.feature, f.ord, (f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ()) AS fn, (mi - min(mi) OVER ()) / (max(mi) OVER () - min(mi) OVER ()) AS mn,
                  (cov - min(cov) OVER ()) / (max(cov) OVER () - min(cov) OVER ()) AS cn, cov, varies, v, present, n
           FROM f_table f JOIN mi_table m ON m.feature = f.feature JOIN ref_table r ON r.feature = f.feature)"""
QUERIES["joint_select"] = _joint
ORACLE["joint_select"] = sql("""
SELECT feature, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, ord) <= 3 AS chosen FROM (
  SELECT feature, ord, CASE WHEN cov >= 0.05 THEN 0.85 * (0.5 * fn + 0.5 * mn) + 0.15 * (CASE WHEN varies THEN cn ELSE 0 END) ELSE 0 END AS score FROM scaled) s""",
    F_TABLE, MI_TABLE, REF_TABLE, SCALED)


def _dual(spark, sf):
    seen = stats(spark, sf)
    ranked = select.dual_select(seen, select.mutual_info(featured(spark, sf), seen, "y"), _ref(spark, sf), 4)
    return _table(spark, [(i, n, round(v, 6)) for i, (n, v) in enumerate(ranked, 1)], "place int, feature string, score double")


QUERIES["dual_select"] = _dual
ORACLE["dual_select"] = sql("""
SELECT CAST(row_number() OVER (ORDER BY score DESC, ord) AS INTEGER) AS place, feature, round(score, 6) AS score FROM (
  SELECT feature, ord, CASE WHEN v > 0.001 AND present > floor(n * 0.10) THEN 0.5 * fn + 0.5 * mn ELSE 0 END AS score FROM scaled) s
ORDER BY score DESC, ord LIMIT 4""", F_TABLE, MI_TABLE, REF_TABLE, SCALED)

GROUPS = {"Finished": ["Accepted", "Done"], "early stage!": ["Open", "Missing"], "none": ["Nowhere"]}


def _units(spark, sf):
    planned = units.plan_units(items(spark, sf), groups=GROUPS, ungrouped="perstatus")
    return planned.withColumn("statuses", F.array_join("statuses", "#"))


UNIT = "CASE epic_status WHEN 'Accepted' THEN 'Finished' WHEN 'Open' THEN 'early stage!' ELSE epic_status END"
QUERIES["status_units"] = _units
ORACLE["status_units"] = with_views(f"""
SELECT CASE WHEN epic_status IN ('Accepted', 'Open') THEN 'group' ELSE 'status' END AS type, {UNIT} AS name,
       CASE epic_status WHEN 'Open' THEN 'early_stage' ELSE lower({UNIT}) END AS slug, epic_status AS statuses
FROM (SELECT DISTINCT epic_status FROM fx_items) s""", "fx_items")
QUERIES["slugify"] = lambda spark, sf: items(spark, sf).select("key", slug(F.concat(F.lit("#Été "), "c_text", F.lit("?!"))).alias("slug"))
ORACLE["slugify"] = with_views("SELECT key, 'été_' || replace(c_text, ' ', '_') AS slug FROM fx_items", "fx_items")
QUERIES["segment_filter"] = lambda spark, sf: units.segment(items(spark, sf), ["Open", "Planned"]).select("key", "epic_status")
ORACLE["segment_filter"] = with_views("SELECT key, epic_status FROM fx_items WHERE epic_status IN ('Open', 'Planned')", "fx_items")
QUERIES["build_xy"] = lambda spark, sf: units.build_xy(items(spark, sf), "y", ["key", "extract_date", "c_text", "c_date", "y", "n_price"], ["key"])
ORACLE["build_xy"] = with_views("SELECT * EXCLUDE (extract_date, c_text, c_date, n_price) FROM fx_items", "fx_items")
QUERIES["skip_guards"] = lambda spark, sf: units.skip_guards(items(spark, sf), "epic_status", "y")
ORACLE["skip_guards"] = with_views(
    "SELECT epic_status, count(*) AS n_rows, count(DISTINCT y) AS n_classes, count(DISTINCT y) < 2 AS skipped FROM fx_items GROUP BY 1", "fx_items")
QUERIES["safe_folds"] = lambda spark, sf: units.safe_folds(items(spark, sf), "y", 10)
ORACLE["safe_folds"] = with_views(
    "SELECT CAST(greatest(2, least(10, min(n))) AS INTEGER) AS folds FROM (SELECT count(*) AS n FROM fx_items GROUP BY y) c", "fx_items")
QUERIES["stratified_split"] = lambda spark, sf: units.stratified_split(items(spark, sf), "y", "key").select("key", "y", "is_test")
ORACLE["stratified_split"] = with_views("""
SELECT key, y, row_number() OVER (PARTITION BY y ORDER BY md5(concat(CAST(key AS VARCHAR), ':42')), key) <= floor(count(*) OVER (PARTITION BY y) * 0.2::DOUBLE + 0.5) AS is_test
FROM fx_items""", "fx_items")
QUERIES["stratified_folds"] = lambda spark, sf: units.stratified_folds(items(spark, sf), "y", "key", 5).select("key", "y", "fold")
ORACLE["stratified_folds"] = with_views("""
SELECT key, y, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(concat(CAST(key AS VARCHAR), ':42')), key) - 1) % 5 AS INTEGER) AS fold FROM fx_items""", "fx_items")
QUERIES["class_weight"] = lambda spark, sf: units.class_weight(items(spark, sf), "y").select("key", F.round("class_weight", 6).alias("class_weight"))
ORACLE["class_weight"] = with_views("""
SELECT key, round(count(*) OVER () / ((SELECT count(DISTINCT y) FROM fx_items) * count(*) OVER (PARTITION BY y))::DOUBLE, 6) AS class_weight FROM fx_items""", "fx_items")


def guesses(spark, sf):
    return fixture(spark, sf, "fx_scored_labels")


QUERIES["accuracy"] = lambda spark, sf: units.accuracy(guesses(spark, sf), "y", "pred").select(F.round("accuracy", 6).alias("accuracy"))
ORACLE["accuracy"] = with_views(
    "SELECT round(avg(CASE WHEN y = pred THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy FROM fx_scored_labels", "fx_scored_labels")
QUERIES["f1_weighted"] = lambda spark, sf: units.f1_weighted(guesses(spark, sf), "y", "pred").select(F.round("f1_weighted", 6).alias("f1_weighted"))
ORACLE["f1_weighted"] = with_views("""
SELECT round(sum(truth * f1) / sum(truth), 6) AS f1_weighted FROM (
  SELECT t.y, t.n AS truth, 2.0::DOUBLE * coalesce(h.n, 0) / (t.n + coalesce(g.n, 0)) AS f1
  FROM (SELECT y, count(*) AS n FROM fx_scored_labels GROUP BY 1) t
  LEFT JOIN (SELECT pred, count(*) AS n FROM fx_scored_labels GROUP BY 1) g ON g.pred = t.y
  LEFT JOIN (SELECT y, count(*) AS n FROM fx_scored_labels WHERE y = pred GROUP BY 1) h ON h.y = t.y) c""", "fx_scored_labels")
