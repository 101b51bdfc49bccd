"""Stand-in inputs: views in portable SQL over the driver tables.

The same text runs on Spark and, as WITH clauses, on the SQL side of the checks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.session import scratch_folder
from ticketlens.skew import last_before

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {}

VIEWS["fx_change"] = """
SELECT user_id AS key, event_id AS history_id, ts AS changed_at, event_type AS field,
       lag(CAST(CAST(floor(value / 20) AS INT) AS STRING)) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before_value,
       CAST(CAST(floor(value / 20) AS INT) AS STRING) AS after_value
FROM events
"""

VIEWS["fx_current"] = """
SELECT key, min(changed_at) - INTERVAL '1' DAY AS created,
       max_by(after_value, changed_at) FILTER (WHERE field = 'click') AS click,
       max_by(after_value, changed_at) FILTER (WHERE field = 'error') AS error,
       max_by(after_value, changed_at) FILTER (WHERE field = 'purchase') AS purchase,
       max_by(after_value, changed_at) FILTER (WHERE field = 'signup') AS signup,
       max_by(after_value, changed_at) FILTER (WHERE field = 'view') AS view
FROM fx_change GROUP BY key
"""

VIEWS["fx_tag_change"] = """
SELECT user_id AS key, event_id AS history_id, ts AS changed_at,
       CASE WHEN event_id % 3 = 0 THEN event_type END AS before_value,
       CASE WHEN event_id % 3 <> 0 THEN event_type END AS after_value
FROM events
"""

VIEWS["fx_equivalence"] = """
SELECT DISTINCT before_value AS var1, after_value AS var2
FROM fx_change WHERE before_value < after_value AND history_id % 2 = 0
"""

VIEWS["fx_release"] = """
SELECT concat('R', CAST(year(d) AS STRING), 'Q', CAST(quarter(d) AS STRING)) AS release, CAST(min(d) AS DATE) AS dev_cutoff
FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate AS d FROM lineitem) x
GROUP BY 1
"""

VIEWS["fx_panel"] = """
SELECT concat('C', CAST(o.o_custkey AS STRING)) AS key, CAST(o.o_orderdate AS DATE) AS extract_date, o.o_orderkey AS row_ord,
       CASE o.o_orderstatus WHEN 'F' THEN 'Done' WHEN 'O' THEN 'Open' ELSE 'Planned' END AS epic_status,
       CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Team Epic' ELSE 'ART Epic' END AS epic_level,
       CASE WHEN o.o_orderkey % 11 <> 0 THEN concat('R', CAST(year(o.o_orderdate) AS STRING), 'Q', CAST(quarter(o.o_orderdate) AS STRING), ', to_plan') END AS epic_dev_roadmap,
       concat('R', CAST(year(l.lo) AS STRING), 'Q', CAST(quarter(l.lo) AS STRING), '#', 'hit-pi-1', '# R', CAST(year(l.hi) AS STRING), 'Q', CAST(quarter(l.hi) AS STRING)) AS epic_fix_version,
       CASE WHEN o.o_orderkey % 50 = 0 THEN o.o_totalprice END AS epic_business_value,
       o.o_orderpriority AS epic_priority
FROM orders o JOIN (SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

#: The lines of an order as fx_items reads them; Spark builds the same rows by `order_lines`.
ORDER_LINES = """SELECT l_orderkey, sum(l_quantity) AS qty,
         concat_ws('#', max(CASE WHEN p_type = 'ECONOMY' THEN p_type END), max(CASE WHEN p_type = 'LARGE' THEN p_type END),
                   max(CASE WHEN p_type = 'MEDIUM' THEN p_type END), max(CASE WHEN p_type = 'PROMO' THEN p_type END),
                   max(CASE WHEN p_type = 'SMALL' THEN p_type END), max(CASE WHEN p_type = 'STANDARD' THEN p_type END)) AS tags,
         concat('P', CAST(min(l_partkey) % 150 AS STRING), '# P', CAST(max(l_partkey) % 150 AS STRING)) AS ptags
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""

VIEWS["fx_items"] = f"""
SELECT o.o_orderkey AS key, CAST(o.o_orderdate AS DATE) AS extract_date,
       CASE o.o_orderstatus WHEN 'F' THEN 'Accepted' WHEN 'O' THEN 'Open' ELSE 'Planned' END AS epic_status,
       CASE WHEN o.o_orderkey % 13 <> 0 THEN o.o_orderpriority END AS c_onehot,
       concat('M', CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS STRING)) AS c_topk,
       concat('C', CAST(o.o_custkey AS STRING)) AS c_high,
       concat('order placed by customer number ', CAST(o.o_custkey AS STRING), ' at ', CAST(o.o_orderkey AS STRING)) AS c_text,
       CASE WHEN o.o_orderkey % 7 = 0 THEN 'not a date' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS c_date,
       CASE WHEN o.o_orderkey % 17 <> 0 THEN o.o_totalprice END AS n_price,
       l.qty AS n_qty, CAST(1 AS DOUBLE) AS n_const, l.tags AS t_bin, l.ptags AS t_topk,
       CASE WHEN ceil(l.qty / 25) >= 8 THEN '8+' ELSE CAST(CAST(greatest(1, ceil(l.qty / 25)) AS INT) AS STRING) END AS y
FROM orders o JOIN (
  {ORDER_LINES}) l ON o.o_orderkey = l.l_orderkey
"""

VIEWS["fx_predictions"] = """
SELECT w.key AS epic_key,
       CASE WHEN w.key % 19 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 'Accepted' WHEN o.o_orderstatus = 'O' THEN 'Open' ELSE 'Planned' END AS epic_status,
       CASE WHEN a >= b AND a >= c AND a >= d THEN '1' WHEN b >= c AND b >= d THEN '2' WHEN c >= d THEN '3' ELSE '8+' END AS predicted_lead_time,
       a / (a + b + c + d) AS proba_1, b / (a + b + c + d) AS proba_2, c / (a + b + c + d) AS proba_3, d / (a + b + c + d) AS `proba_8+`
FROM (SELECT l_orderkey AS key,
             coalesce(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0.0) AS a,
             coalesce(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0.0) AS b,
             coalesce(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity END), 0.0) AS c,
             coalesce(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity END), 0.0) AS d
      FROM lineitem GROUP BY l_orderkey) w JOIN orders o ON o.o_orderkey = w.key
"""

VIEWS["fx_ledger"] = """
SELECT epic_key, epic_status, '1' AS predicted_lead_time, proba_2 AS proba_1, proba_1 AS proba_2, proba_3, `proba_8+`,
       CASE WHEN epic_key % 4 = 0 THEN 'm0' ELSE 'm1' END AS model_name
FROM fx_predictions WHERE epic_key % 2 = 0
"""

VIEWS["fx_scored_labels"] = """
SELECT i.key, i.y, CASE WHEN i.key % 5 = 0 THEN '8+' ELSE p.predicted_lead_time END AS pred
FROM fx_items i JOIN fx_predictions p ON i.key = p.epic_key
"""
# tags a key holds now: every event type whose last change added it
VIEWS["fx_tag_current"] = """
SELECT key, concat_ws('#', max(CASE WHEN tag = 'click' AND held THEN tag END), max(CASE WHEN tag = 'error' AND held THEN tag END),
       max(CASE WHEN tag = 'purchase' AND held THEN tag END), max(CASE WHEN tag = 'signup' AND held THEN tag END),
       max(CASE WHEN tag = 'view' AND held THEN tag END)) AS tags
FROM (SELECT key, coalesce(before_value, after_value) AS tag, max_by(after_value IS NOT NULL, changed_at) AS held
      FROM fx_tag_change GROUP BY key, coalesce(before_value, after_value)) x
GROUP BY key
"""

# what each view reads, in build order
NEEDS: dict[str, tuple[str, ...]] = {
    "fx_current": ("fx_change",),
    "fx_equivalence": ("fx_change",),
    "fx_tag_current": ("fx_tag_change",),
    "fx_ledger": ("fx_predictions",),
    "fx_scored_labels": ("fx_items", "fx_predictions"),
}


def needed(names: tuple[str, ...]) -> list[str]:
    """The views and all views below them, lowest first."""
    found: list[str] = []
    for name in names:
        for part in (*needed(NEEDS.get(name, ())), name):
            if part not in found:
                found.append(part)
    return found


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a DataFrame over the tables in `sf_dir`."""
    views = needed((name,))
    words = set(re.findall(r"\w+", " ".join(VIEWS[v] for v in views)))
    for base in words.intersection(TABLES):
        table(spark, sf_dir, base).createOrReplaceTempView(base)
    for view in views:
        if view == "fx_change":
            rows = changes(table(spark, sf_dir, "events"))
        elif view == "fx_items":
            order_lines(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")).createOrReplaceTempView("fx_order_lines")
            rows = spark.sql(VIEWS[view].replace(ORDER_LINES, "SELECT * FROM fx_order_lines"))
        else:
            rows = spark.sql(VIEWS[view])
        rows.createOrReplaceTempView(view)
    return spark.table(name)


def held_fixture(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    """A fixture view joined once and written beside the checkpoints, for queries that read it several times."""
    rows, path = fixture(spark, sf_dir, name), scratch_folder(spark)
    (rows.select(*columns) if columns else rows).write.parquet(path)
    return spark.read.parquet(path)


def order_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """ORDER_LINES without maxima of texts, which Spark would have to sort the lines for."""
    kinds = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    lines = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    found = lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"), F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high"),
        *[F.max(F.col("p_type") == k).alias(k) for k in kinds])
    return found.select(
        "l_orderkey", "qty", F.concat_ws("#", *[F.when(F.col(k), k) for k in kinds]).alias("tags"),
        F.concat(F.lit("P"), (F.col("low") % 150).cast("string"), F.lit("# P"), (F.col("high") % 150).cast("string")).alias("ptags"))


def changes(events: DataFrame) -> DataFrame:
    """fx_change without a window over a whole user, which may be hot."""
    level = F.floor(F.col("value") / 20).cast("int").cast("string")
    named = events.select(
        F.col("user_id").alias("key"), F.col("event_id").alias("history_id"), F.col("ts").alias("changed_at"),
        F.col("event_type").alias("field"), level.alias("after_value"),
    )
    before = last_before(named, ["key", "field"], [F.col("changed_at"), F.col("history_id")], ["after_value"])
    return before.select(
        "key", "history_id", "changed_at", "field", F.col("prev_after_value").alias("before_value"), "after_value"
    )


def with_views(sql: str, *names: str) -> str:
    """The query preceded by the fixture views it reads, for an engine that has only the base tables."""
    clauses = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed(names))
    return f"WITH RECURSIVE {clauses}\n{sql.strip()}".replace("`", '"')
