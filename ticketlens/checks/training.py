"""Registered queries over the snapshot panel and column profiles, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlens.fixtures import fixture, with_views
from ticketlens.functions.labels import cap_label, to_quarters
from ticketlens.operators import prepare, profile

QUERIES = {}
ORACLE = {}

CONFIG = prepare.PrepareConfig(since="1996-01-01")
STATUSES = "('" + "', '".join(CONFIG.finished_statuses) + "')"


def panel(spark, sf):
    return fixture(spark, sf, "fx_panel")


def releases(spark, sf):
    return fixture(spark, sf, "fx_release")


def dated(spark, sf):
    return prepare.dated(panel(spark, sf), releases(spark, sf), CONFIG)


def labels(spark, sf):
    done = prepare.finished(dated(spark, sf), CONFIG.finished_statuses, CONFIG.level)
    latest = prepare.latest_per_key(done, tie="row_ord")
    return latest.select("key", F.col("existing_lead_time").alias("needed_lead_time"))


# the roadmap names one release before the comma, the version list one before the first # and one after the last
DATED = """
dated0 AS (SELECT p.*, a.dev_cutoff AS dev_roadmap_date, greatest(b.dev_cutoff, c.dev_cutoff) AS fix_version_date
  FROM fx_panel p LEFT JOIN fx_release a ON a.release = split_part(p.epic_dev_roadmap, ',', 1)
  LEFT JOIN fx_release b ON b.release = split_part(p.epic_fix_version, '#', 1)
  LEFT JOIN fx_release c ON c.release = trim(split_part(p.epic_fix_version, '#', 3))),
all_dated AS (SELECT *, CAST(fix_version_date - dev_roadmap_date AS INTEGER) AS existing_lead_time FROM dated0),
dated AS (SELECT * FROM all_dated WHERE extract_date >= DATE '1996-01-01'),
done AS (SELECT * FROM dated WHERE existing_lead_time >= 0 AND epic_level = 'ART Epic' AND epic_status IN """ + STATUSES + """),
latest AS (SELECT * FROM done QUALIFY row_number() OVER (PARTITION BY key ORDER BY extract_date DESC, row_ord) = 1),
labelled AS (SELECT d.*, l.existing_lead_time AS needed_lead_time FROM dated d JOIN latest l ON l.key = d.key),
final0 AS (SELECT key, extract_date, row_ord, epic_status, epic_level, epic_dev_roadmap, epic_fix_version, epic_business_value, epic_priority, dev_roadmap_date, fix_version_date,
   CASE WHEN existing_lead_time > 0 THEN CAST(greatest(1, ceil(existing_lead_time / 90.0)) AS INTEGER) ELSE 0 END AS existing_lead_time,
   CAST(greatest(1, ceil(needed_lead_time / 90.0)) AS INTEGER) AS needed FROM labelled WHERE needed_lead_time > 0),
final1 AS (SELECT * FROM final0 QUALIFY row_number() OVER (PARTITION BY key, epic_status, epic_level, epic_dev_roadmap, epic_fix_version, epic_business_value, epic_priority,
   dev_roadmap_date, fix_version_date, existing_lead_time, needed ORDER BY row_ord) = 1),
final AS (SELECT * EXCLUDE (needed, epic_business_value), CASE WHEN needed >= 8 THEN '8+' ELSE CAST(needed AS VARCHAR) END AS needed_lead_time FROM final1)
"""


def sql(select: str, *extra: str) -> str:
    return with_views("", "fx_panel", "fx_release", *extra).rstrip() + ",\n" + DATED + select


DATES = ["key", "row_ord", "dev_roadmap_date", "fix_version_date"]
QUERIES["release_lookup"] = lambda spark, sf: dated(spark, sf).select(*DATES)
ORACLE["release_lookup"] = sql("SELECT key, row_ord, dev_roadmap_date, fix_version_date FROM dated")


def _copied_calendar(spark, sf):
    """A calendar that lists releases again with earlier days, as a constant and joined."""
    listed = releases(spark, sf)
    copies = listed.select("release", F.date_sub("dev_cutoff", 30).alias("dev_cutoff"))
    both = copies.unionByName(listed).unionByName(copies)
    out = None
    for way, days in (("constant", prepare.calendar(both)), ("joined", both)):
        rows = prepare.release_date(panel(spark, sf), "epic_dev_roadmap", days, CONFIG.roadmap_separators, "min", "dev_roadmap_date")
        rows = rows.select("key", "row_ord", F.lit(way).alias("way"), "dev_roadmap_date")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES["release_lookup_copies"] = _copied_calendar
ORACLE["release_lookup_copies"] = sql(
    "SELECT key, row_ord, way, dev_roadmap_date FROM dated0, (VALUES ('constant'), ('joined')) w(way)")


def _joined_calendar(spark, sf):
    """The same dates by the join used for a large calendar."""
    rows = prepare.since(panel(spark, sf), CONFIG.since)
    rows = prepare.release_date(rows, "epic_dev_roadmap", releases(spark, sf), CONFIG.roadmap_separators, "min", "dev_roadmap_date")
    rows = prepare.release_date(rows, "epic_fix_version", releases(spark, sf), CONFIG.version_separators, "max", "fix_version_date")
    return rows.select(*DATES)


QUERIES["release_lookup_joined"] = _joined_calendar
ORACLE["release_lookup_joined"] = ORACLE["release_lookup"]
QUERIES["bad_release_tokens"] = lambda spark, sf: prepare.unknown_releases(
    panel(spark, sf), {"epic_dev_roadmap": CONFIG.roadmap_separators, "epic_fix_version": CONFIG.version_separators}, releases(spark, sf))
ORACLE["bad_release_tokens"] = with_views("""
SELECT token, count(*) AS n FROM (
  SELECT unnest(list_transform(string_split(replace(epic_dev_roadmap, ',', '#'), '#'), lambda t: trim(t))) AS token FROM fx_panel WHERE epic_dev_roadmap IS NOT NULL
  UNION ALL SELECT unnest(list_transform(string_split(epic_fix_version, '#'), lambda t: trim(t))) FROM fx_panel WHERE epic_fix_version IS NOT NULL) t
WHERE token NOT IN (SELECT release FROM fx_release) OR token = 'to_plan' OR contains(token, 'hit-pi') GROUP BY 1""", "fx_panel", "fx_release")
QUERIES["lead_time_days"] = lambda spark, sf: dated(spark, sf).select("key", "row_ord", "existing_lead_time")
ORACLE["lead_time_days"] = sql("SELECT key, row_ord, existing_lead_time FROM dated")


def _parse_dates(spark, sf):
    rows = fixture(spark, sf, "fx_items").select("key", "c_date")
    return prepare.parse_day(rows, "c_date")


QUERIES["parse_dates"] = _parse_dates
ORACLE["parse_dates"] = with_views("SELECT key, TRY_CAST(c_date AS DATE) AS c_date FROM fx_items", "fx_items")
QUERIES["since_date"] = lambda spark, sf: prepare.since(panel(spark, sf), "1998-06-01").select("key", "extract_date", "row_ord")
ORACLE["since_date"] = with_views("SELECT key, extract_date, row_ord FROM fx_panel WHERE extract_date >= DATE '1998-06-01'", "fx_panel")
QUERIES["finished_filter"] = lambda spark, sf: prepare.finished(dated(spark, sf), CONFIG.finished_statuses, CONFIG.level).select(
    "key", "row_ord", "existing_lead_time")
ORACLE["finished_filter"] = sql("SELECT key, row_ord, existing_lead_time FROM done")
QUERIES["latest_per_key"] = lambda spark, sf: prepare.latest_per_key(panel(spark, sf), tie="row_ord")
ORACLE["latest_per_key"] = with_views(
    "SELECT * FROM fx_panel QUALIFY row_number() OVER (PARTITION BY key ORDER BY extract_date DESC, row_ord) = 1", "fx_panel")
QUERIES["label_back"] = lambda spark, sf: prepare.label_back(dated(spark, sf), labels(spark, sf)).select("key", "row_ord", "needed_lead_time")
ORACLE["label_back"] = sql("SELECT key, row_ord, needed_lead_time FROM labelled")
QUERIES["label_back_spread"] = lambda spark, sf: prepare.label_back(dated(spark, sf), labels(spark, sf), limit=5).select(
    "key", "row_ord", "needed_lead_time")
ORACLE["label_back_spread"] = ORACLE["label_back"]
QUERIES["keep_finished_keys"] = lambda spark, sf: prepare.keep_finished_keys(dated(spark, sf), labels(spark, sf)).select("key", "row_ord")
ORACLE["keep_finished_keys"] = sql("SELECT key, row_ord FROM labelled")
QUERIES["to_quarters"] = lambda spark, sf: dated(spark, sf).select("row_ord", to_quarters(F.col("existing_lead_time")).alias("quarters"))
ORACLE["to_quarters"] = sql(
    "SELECT row_ord, CASE WHEN existing_lead_time > 0 THEN CAST(greatest(1, ceil(existing_lead_time / 90.0)) AS INTEGER) ELSE 0 END AS quarters FROM dated")
QUERIES["cap_label"] = lambda spark, sf: dated(spark, sf).select(
    "row_ord", cap_label(to_quarters(F.col("existing_lead_time"))).alias("label"))
ORACLE["cap_label"] = sql("""SELECT row_ord, CASE WHEN quarters >= 8 THEN '8+' ELSE CAST(quarters AS VARCHAR) END AS label FROM (
  SELECT row_ord, CASE WHEN existing_lead_time > 0 THEN CAST(greatest(1, ceil(existing_lead_time / 90.0)) AS INTEGER) ELSE 0 END AS quarters FROM dated) x""")
QUERIES["drop_sparse"] = lambda spark, sf: prepare.drop_sparse(panel(spark, sf), panel(spark, sf), 0.95)
ORACLE["drop_sparse"] = with_views("SELECT * EXCLUDE (epic_business_value) FROM fx_panel", "fx_panel")
QUERIES["dedup_except"] = lambda spark, sf: prepare.dedup_except(
    panel(spark, sf).drop("epic_dev_roadmap", "epic_fix_version"), ["extract_date"], "row_ord")
ORACLE["dedup_except"] = with_views("""
SELECT key, extract_date, row_ord, epic_status, epic_level, epic_business_value, epic_priority FROM fx_panel
QUALIFY row_number() OVER (PARTITION BY key, epic_status, epic_level, epic_business_value, epic_priority ORDER BY row_ord) = 1""", "fx_panel")


def training(spark, sf):
    return prepare.training_table(panel(spark, sf), releases(spark, sf), "row_ord", CONFIG)


QUERIES["training_table"] = training
ORACLE["training_table"] = sql("SELECT * FROM final")
QUERIES["class_counts"] = lambda spark, sf: prepare.class_counts(training(spark, sf), "needed_lead_time")
ORACLE["class_counts"] = sql("SELECT needed_lead_time, count(*) AS n FROM final GROUP BY 1")

TEXTS = ["c_onehot", "c_topk", "c_high", "c_text", "t_bin", "t_topk", "y"]
LONG = "long0 AS (" + " UNION ALL ".join(f"SELECT '{c}' AS name, {c} AS value FROM fx_items" for c in TEXTS) + """),
long AS (SELECT name AS "column", value FROM long0 WHERE value IS NOT NULL),
counted AS (SELECT "column", value, count(*) AS n FROM long GROUP BY 1, 2),
stats AS (SELECT "column", count(*) AS n_unique, sum(CASE WHEN contains(value, '#') THEN n ELSE 0 END) / sum(n) AS multi_share,
                 sum(n * length(value)) / sum(n) AS mean_length FROM counted GROUP BY 1),
tag_list AS (SELECT "column", trim(unnest(string_split(value, '#'))) AS tag FROM long),
tag_counted AS (SELECT "column", tag, count(*) AS n FROM tag_list WHERE tag <> '' GROUP BY 1, 2),
tag_sum AS (SELECT "column", count(*) AS n_tags, avg(CASE WHEN n < 10 THEN 1.0 ELSE 0.0 END) AS rare_share FROM tag_counted GROUP BY 1),
profiled AS (SELECT s.*, CASE WHEN multi_share > 0.5 THEN n_tags END AS n_tags, CASE WHEN multi_share > 0.5 THEN rare_share END AS rare_share
             FROM stats s LEFT JOIN tag_sum t ON t."column" = s."column")
"""


def items(spark, sf):
    return fixture(spark, sf, "fx_items")


def items_sql(select: str) -> str:
    return with_views("", "fx_items").rstrip() + ",\n" + LONG + select


def _detected(spark, sf, pick):
    """Detected kinds, each beside the number of its non-null values in the table."""
    rows = items(spark, sf)
    kinds = dict(zip(("categorical", "date", "numeric"), profile.detect_types(rows)))
    named = [(c, kind) for kind, columns in kinds.items() if kind in pick for c in columns]
    counts = rows.agg(*[F.count(c).alias(c) for c, _ in named])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(c).alias("n")) for c, kind in named])))


def _kind_sql(c: str) -> str:
    """The rule for one column: its type, and for texts the share of values that are dates."""
    is_date = f"avg(CASE WHEN {c} IS NOT NULL THEN CAST(TRY_CAST(CAST({c} AS VARCHAR) AS DATE) IS NOT NULL AS INT) END) >= 0.8"
    kind = f"""CASE WHEN typeof(any_value({c})) IN ('DATE', 'TIMESTAMP') THEN 'date' WHEN typeof(any_value({c})) <> 'VARCHAR' THEN 'numeric'
      WHEN {is_date} THEN 'date' ELSE 'categorical' END"""
    return f"SELECT '{c}' AS \"column\", {kind} AS kind, count({c}) AS n FROM fx_items"


def _detected_sql(*kinds: str) -> str:
    columns = ["epic_status", *TEXTS, "extract_date", "c_date", "key", "n_const", "n_price", "n_qty"]
    wanted = ", ".join(f"'{k}'" for k in kinds)
    return with_views(f"SELECT * FROM ({' UNION ALL '.join(map(_kind_sql, columns))}) found WHERE kind IN ({wanted})", "fx_items")


QUERIES["detect_dates"] = lambda spark, sf: _detected(spark, sf, ("date",))
ORACLE["detect_dates"] = _detected_sql("date")
QUERIES["detect_types"] = lambda spark, sf: _detected(spark, sf, ("categorical", "date", "numeric"))
ORACLE["detect_types"] = _detected_sql("categorical", "date", "numeric")

QUERIES["sample"] = lambda spark, sf: profile.sample_rows(items(spark, sf), 0.1, F.col("key")).select("key")
ORACLE["sample"] = with_views(
    "SELECT key FROM fx_items WHERE CAST('0x' || substr(md5(CAST(key AS VARCHAR) || ':42'), 1, 8) AS BIGINT) / 4294967296.0 < 0.1", "fx_items")


QUERIES["sample_values"] = lambda spark, sf: profile.sample_values(items(spark, sf), TEXTS, 10, F.col("key"))
ORACLE["sample_values"] = with_views(
    "SELECT \"column\", value FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, md5(CAST(key AS VARCHAR) || ':{c}:42') AS digest FROM fx_items WHERE {c} IS NOT NULL" for c in TEXTS)
    + ") QUALIFY row_number() OVER (PARTITION BY \"column\" ORDER BY digest, value) <= 10", "fx_items")


def _values(spark, sf):
    return profile.value_counts(items(spark, sf), TEXTS)


QUERIES["value_counts"] = _values
ORACLE["value_counts"] = items_sql("SELECT * FROM counted")
QUERIES["is_multilabel"] = lambda spark, sf: profile.column_stats(_values(spark, sf)).select(
    "column", (F.col("multi_share") > 0.5).alias("multilabel"))
ORACLE["is_multilabel"] = items_sql('SELECT "column", multi_share > 0.5 AS multilabel FROM stats')
QUERIES["cardinality"] = lambda spark, sf: profile.column_stats(_values(spark, sf)).select("column", "n_unique")
ORACLE["cardinality"] = items_sql('SELECT "column", n_unique FROM stats')
QUERIES["avg_length"] = lambda spark, sf: profile.column_stats(_values(spark, sf)).select("column", F.round("mean_length", 6).alias("mean_length"))
ORACLE["avg_length"] = items_sql('SELECT "column", round(mean_length, 6) AS mean_length FROM stats')
QUERIES["tag_stats"] = lambda spark, sf: profile.tag_stats(
    profile.value_counts(items(spark, sf), ["t_bin", "t_topk"])).select("column", "n_tags", F.round("rare_share", 6).alias("rare_share"))
ORACLE["tag_stats"] = items_sql("""SELECT "column", n_tags, round(CAST(rare_share AS DOUBLE), 6) AS rare_share FROM tag_sum WHERE "column" IN ('t_bin', 't_topk')""")


def _classify(spark, sf):
    rows = profile.classify(profile.profile(items(spark, sf), TEXTS))
    return rows.select("column", "n_unique", "n_tags", F.round("multi_share", 6).alias("multi_share"), "strategy")


QUERIES["classify_columns"] = _classify
ORACLE["classify_columns"] = items_sql("""
SELECT "column", n_unique, n_tags, round(multi_share, 6) AS multi_share,
  CASE WHEN multi_share > 0.5 AND n_tags <= 100 THEN 'tag_binarize' WHEN multi_share > 0.5 AND rare_share < 0.3 THEN 'tag_top_k' WHEN multi_share > 0.5 THEN 'tag_count'
       WHEN n_unique <= 50 THEN 'one_hot' WHEN n_unique <= 200 THEN 'top_k' WHEN mean_length > 30 THEN 'text' ELSE 'frequency' END AS strategy FROM profiled""")
