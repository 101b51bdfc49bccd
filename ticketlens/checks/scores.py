"""Registered queries over predictions, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlens.fixtures import fixture, with_views
from ticketlens.functions.bins import cut
from ticketlens.operators import ledger, score, summaries

QUERIES = {}
ORACLE = {}

P = ["proba_1", "proba_2", "proba_3", "`proba_8+`"]
# the measures of the four fixture classes, at positions 1, 2, 3 and 8
MEASURES = """
m0 AS (SELECT *, greatest(proba_1, proba_2, proba_3, `proba_8+`) AS p1 FROM {source}),
m1 AS (SELECT *, CASE WHEN proba_1 = p1 THEN greatest(proba_2, proba_3, `proba_8+`)
                      WHEN proba_2 = p1 THEN greatest(proba_1, proba_3, `proba_8+`)
                      WHEN proba_3 = p1 THEN greatest(proba_1, proba_2, `proba_8+`)
                      ELSE greatest(proba_1, proba_2, proba_3) END AS p2,
              CASE WHEN proba_1 = p1 THEN 1 WHEN proba_2 = p1 THEN 2 WHEN proba_3 = p1 THEN 3 ELSE 8 END AS top_pos,
              proba_1 + 2 * proba_2 + 3 * proba_3 + 8 * `proba_8+` AS mu FROM m0),
m2 AS (SELECT *, p1 - p2 AS margin,
              1 - (proba_1 * abs(1 - top_pos) + proba_2 * abs(2 - top_pos) + proba_3 * abs(3 - top_pos) + `proba_8+` * abs(8 - top_pos)) / 7 AS proximity,
              CASE top_pos WHEN 1 THEN proba_1 + proba_2 WHEN 2 THEN proba_1 + proba_2 + proba_3
                      WHEN 3 THEN proba_2 + proba_3 + `proba_8+` ELSE proba_3 + `proba_8+` END AS near,
              1 - (proba_1 * (1 - mu) * (1 - mu) + proba_2 * (2 - mu) * (2 - mu) + proba_3 * (3 - mu) * (3 - mu) + `proba_8+` * (8 - mu) * (8 - mu)) / 12.25 AS dispersion,
              -(CASE WHEN proba_1 > 0 THEN proba_1 * log2(proba_1) ELSE 0 END + CASE WHEN proba_2 > 0 THEN proba_2 * log2(proba_2) ELSE 0 END
                + CASE WHEN proba_3 > 0 THEN proba_3 * log2(proba_3) ELSE 0 END + CASE WHEN `proba_8+` > 0 THEN `proba_8+` * log2(`proba_8+`) ELSE 0 END) AS bits FROM m1),
m3 AS (SELECT *, greatest(0, least(1, bits / 2)) AS entropy,
              0.30 * least(1, greatest(0, p1)) + 0.20 * least(1, greatest(0, margin)) + 0.20 * least(1, greatest(0, proximity))
              + 0.15 * least(1, greatest(0, near)) + 0.10 * least(1, greatest(0, dispersion)) + 0.05 * {quality} AS trust FROM m2),
m4 AS (SELECT *, CASE WHEN trust <= 0.5 THEN 'Low' WHEN trust <= 0.75 THEN 'Med' WHEN trust <= 0.9 THEN 'High' ELSE 'Very High' END AS band FROM m3)
"""


def measured(select: str, source: str = "fx_predictions", views: tuple[str, ...] = ("fx_predictions",), quality: str = "1.0", extra: str = "") -> str:
    base = with_views("", *views).rstrip()
    extra = extra + "," if extra else ""
    return (base + ",\n" + extra + MEASURES.format(source=source, quality=quality) + select).replace("`", '"')


def predictions(spark, sf):
    return fixture(spark, sf, "fx_predictions")


def scored(spark, sf):
    return score.score(predictions(spark, sf))


def rounded(*names):
    return [F.round(F.col(n), 6).alias(n) for n in names]


def _columns(build, *names):
    return lambda spark, sf: build(predictions(spark, sf)).select("epic_key", *rounded(*names))


def _measure_sql(**names):
    picked = ", ".join(f"round(CAST({v} AS DOUBLE), 6) AS {k}" for k, v in names.items())
    return measured(f"SELECT epic_key, {picked} FROM m4")


QUERIES["top2"] = _columns(score.top2, "Proba_Max", "top2_proba", "top2_margin")
ORACLE["top2"] = _measure_sql(Proba_Max="p1", top2_proba="p2", top2_margin="margin")
QUERIES["proximity_score"] = _columns(score.proximity, "proximity_score")
ORACLE["proximity_score"] = _measure_sql(proximity_score="proximity")
QUERIES["local_mass_pm1"] = _columns(score.local_mass, "local_mass_pm1")
ORACLE["local_mass_pm1"] = _measure_sql(local_mass_pm1="near")
QUERIES["dispersion_score"] = _columns(score.dispersion, "dispersion_score")
ORACLE["dispersion_score"] = _measure_sql(dispersion_score="dispersion")
QUERIES["entropy_norm"] = _columns(score.entropy_norm, "entropy_norm")
ORACLE["entropy_norm"] = _measure_sql(entropy_norm="entropy")

QUALITY = ["c_onehot", "n_price", "c_date", "t_bin"]


def _data_quality(spark, sf):
    items = fixture(spark, sf, "fx_items")
    return score.data_quality(items, QUALITY).select("key", *rounded("data_quality"))


QUERIES["data_quality"] = _data_quality
ORACLE["data_quality"] = with_views(
    "SELECT key, round((" + " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in QUALITY)
    + ") / 4.0, 6) AS data_quality FROM fx_items", "fx_items")


def _trust_score(spark, sf):
    """Trust with the data quality of the raw row, joined by key."""
    raw = fixture(spark, sf, "fx_items").select("key", *QUALITY)
    rows = predictions(spark, sf).join(raw, F.col("epic_key") == F.col("key")).drop("key")
    return score.score(rows, QUALITY).select("epic_key", *rounded("data_quality", "trust_score_v2"), "trust_band")


QUERIES["trust_score"] = _trust_score
ORACLE["trust_score"] = measured(
    "SELECT epic_key, round(CAST(quality AS DOUBLE), 6) AS data_quality, round(trust, 6) AS trust_score_v2, band AS trust_band FROM m4",
    source="raw", views=("fx_items", "fx_predictions"), quality="quality",
    extra="raw AS (SELECT p.*, (" + " + ".join(f"CASE WHEN i.{c} IS NULL THEN 0 ELSE 1 END" for c in QUALITY)
    + ") / 4.0 AS quality FROM fx_predictions p JOIN fx_items i ON i.key = p.epic_key)")

QUERIES["trust_band"] = lambda spark, sf: scored(spark, sf).select("epic_key", "trust_band")
ORACLE["trust_band"] = measured("SELECT epic_key, band AS trust_band FROM m4")


def _coerce(spark, sf):
    items = fixture(spark, sf, "fx_items").select("key", "c_date", F.col("n_qty").cast("string").alias("n_qty"))
    return score.coerce(items, ["c_date", "n_qty", "absent"])


QUERIES["coerce_numeric"] = _coerce
ORACLE["coerce_numeric"] = with_views(
    "SELECT key, TRY_CAST(c_date AS DOUBLE) AS c_date, TRY_CAST(CAST(n_qty AS VARCHAR) AS DOUBLE) AS n_qty FROM fx_items", "fx_items")


def _rank_rows(spark, sf):
    return score.rank_rows(scored(spark, sf)).select("epic_key", "predicted_lead_time", *rounded("trust_score_v2"))


QUERIES["rank_rows"] = _rank_rows
ORACLE["rank_rows"] = measured(
    "SELECT epic_key, predicted_lead_time, round(trust, 6) AS trust_score_v2 FROM m4 ORDER BY trust DESC, p1 DESC, margin DESC, epic_key")


def _bucketize(spark, sf):
    rows = fixture(spark, sf, "fx_items")
    label = cut(F.col("n_qty"), [1, 50, 100, 200], ["low", "mid", "high"])
    return rows.select("key", label.alias("bucket"))


QUERIES["bucketize"] = _bucketize
ORACLE["bucketize"] = with_views(
    """SELECT key, CASE WHEN n_qty >= 1 AND n_qty <= 50 THEN 'low' WHEN n_qty > 50 AND n_qty <= 100 THEN 'mid'
       WHEN n_qty > 100 AND n_qty <= 200 THEN 'high' END AS bucket FROM fx_items""", "fx_items")


def _stamp(spark, sf):
    rows = ledger.stamp(predictions(spark, sf), None, "2024-07-01 10:00:00")
    return rows.select("epic_key", "model_name", "last_prediction_at")


QUERIES["stamp"] = _stamp
ORACLE["stamp"] = with_views(
    "SELECT epic_key, 'default_model' AS model_name, '2024-07-01 12:00:00' AS last_prediction_at FROM fx_predictions", "fx_predictions")


def _merged(spark, sf):
    new = predictions(spark, sf).withColumn("model_name", F.lit("m1"))
    return ledger.upsert(fixture(spark, sf, "fx_ledger"), new)


MERGED_SQL = """
merged AS (SELECT epic_key, epic_status, predicted_lead_time, proba_1, proba_2, proba_3, `proba_8+`, 'm1' AS model_name FROM fx_predictions
           UNION ALL
           SELECT epic_key, epic_status, predicted_lead_time, proba_1, proba_2, proba_3, `proba_8+`, model_name FROM fx_ledger WHERE model_name <> 'm1')
"""
LEDGER_ROWS = ["epic_key", "epic_status", "predicted_lead_time", "model_name"]


def _upsert(spark, sf):
    return _merged(spark, sf).select(*LEDGER_ROWS, *rounded("proba_1", "proba_2", "proba_3"), F.round("`proba_8+`", 6).alias("proba_8"))


QUERIES["upsert_ledger"] = _upsert
ORACLE["upsert_ledger"] = (
    with_views("", "fx_ledger").rstrip() + ",\n" + MERGED_SQL +
    "SELECT epic_key, epic_status, predicted_lead_time, model_name, round(proba_1, 6) AS proba_1, round(proba_2, 6) AS proba_2, "
    "round(proba_3, 6) AS proba_3, round(`proba_8+`, 6) AS proba_8 FROM merged").replace("`", '"')


def _upsert_unique(spark, sf):
    """The path for a ledger known to be unique: an anti join instead of a shuffle of the ledger."""
    new = predictions(spark, sf).withColumn("model_name", F.lit("m1"))
    merged = ledger.upsert(fixture(spark, sf, "fx_ledger"), new, old_unique=True)
    return merged.select(*LEDGER_ROWS)


QUERIES["upsert_ledger_unique"] = _upsert_unique
ORACLE["upsert_ledger_unique"] = (
    with_views("", "fx_ledger").rstrip() + ",\n" + MERGED_SQL +
    "SELECT epic_key, epic_status, predicted_lead_time, model_name FROM merged").replace("`", '"')


def _rescore(spark, sf):
    return ledger.rescore(_merged(spark, sf)).select("epic_key", "model_name", *rounded("trust_score_v2"), "trust_band")


QUERIES["rescore_ledger"] = _rescore
ORACLE["rescore_ledger"] = measured(
    "SELECT epic_key, model_name, round(trust, 6) AS trust_score_v2, band AS trust_band FROM m4",
    source="merged", views=("fx_ledger",), extra=MERGED_SQL)


def _report(spark, sf):
    report = ledger.report_columns(ledger.stamp(scored(spark, sf), "m1", "2024-07-01 10:00:00"))
    names = report.columns
    doubles = {n for n, t in report.dtypes if t == "double"}
    return report.select(*[F.round(f"`{n}`", 6).alias(n) if n in doubles else F.col(f"`{n}`") for n in names])


QUERIES["project_report"] = _report
ORACLE["project_report"] = measured("""
SELECT epic_key, epic_status, 'm1' AS model_name, '2024-07-01 12:00:00' AS last_prediction_at, predicted_lead_time,
       round(trust, 6) AS trust_score_v2, band AS trust_band, round(p1, 6) AS `Proba_Max`, round(p2, 6) AS top2_proba, round(margin, 6) AS top2_margin,
       round(proba_1, 6) AS proba_1, round(proba_2, 6) AS proba_2, round(proba_3, 6) AS proba_3, round(`proba_8+`, 6) AS `proba_8+`,
       CAST(1.0 AS DOUBLE) AS data_quality, round(proximity, 6) AS proximity_score, round(near, 6) AS local_mass_pm1,
       round(dispersion, 6) AS dispersion_score, round(entropy, 6) AS entropy_norm FROM m4""")

QUERIES["class_histogram"] = lambda spark, sf: summaries.class_histogram(predictions(spark, sf))
ORACLE["class_histogram"] = with_views(
    "SELECT predicted_lead_time, count(*) AS n FROM fx_predictions GROUP BY 1 ORDER BY 1 NULLS LAST", "fx_predictions")


def _histogram_sql(value: str, edges, labels, name: str = "bucket") -> str:
    cases = [f"CASE WHEN v >= {edges[0]} AND v <= {edges[1]} THEN 0"]
    cases += [f"WHEN v > {edges[i]} AND v <= {edges[i + 1]} THEN {i}" for i in range(1, len(labels))]
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(labels))
    return measured(f"""
, cells AS (SELECT {' '.join(cases)} END AS cell FROM (SELECT {value} AS v FROM m4) y)
SELECT CAST(l.i AS INTEGER) AS ord, l.label AS {name}, count(c.cell) AS n
FROM (VALUES {rows}) AS l(i, label) LEFT JOIN cells c ON c.cell = l.i GROUP BY 1, 2 ORDER BY 1""")


QUERIES["trust_histogram"] = lambda spark, sf: summaries.trust_histogram(scored(spark, sf))
ORACLE["trust_histogram"] = _histogram_sql("trust", summaries.TRUST_EDGES, summaries.TRUST_LABELS)
QUERIES["margin_histogram"] = lambda spark, sf: summaries.margin_histogram(predictions(spark, sf))
ORACLE["margin_histogram"] = _histogram_sql("margin", summaries.MARGIN_EDGES, summaries.MARGIN_LABELS)
QUERIES["entropy_histogram"] = lambda spark, sf: summaries.entropy_histogram(predictions(spark, sf))
ORACLE["entropy_histogram"] = _histogram_sql(
    "least(bits, 2.0)", ["0.0", "2.0 / 6", "4.0 / 6", "6.0 / 6", "8.0 / 6", "10.0 / 6", "2.0"],
    ["0.00–0.33", "0.33–0.67", "0.67–1.00", "1.00–1.33", "1.33–1.67", "1.67–2.00"])


def status_trust(spark, sf):
    return summaries.status_trust(scored(spark, sf)).select("epic_status", *rounded("mean_trust"))


QUERIES["status_trust"] = status_trust
ORACLE["status_trust"] = measured("SELECT epic_status, round(avg(trust), 6) AS mean_trust FROM m4 GROUP BY 1 ORDER BY avg(trust) DESC")
QUERIES["band_counts"] = lambda spark, sf: summaries.band_counts(scored(spark, sf))
ORACLE["band_counts"] = _histogram_sql(
    "trust", [0, 0.5, 0.75, 0.9, 1.0], ["Low", "Med", "High", "Very High"], "trust_band")
