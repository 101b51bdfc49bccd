"""Registered queries over change logs, states and snapshots, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlens.catalogue import DEFAULT
from ticketlens.fixtures import fixture, table, with_views
from ticketlens.operators import history, snapshots
from ticketlens.plans import jobs
from ticketlens.session import scratch_folder
from ticketlens.functions.dates import text_day
from ticketlens.functions.normalise import RULES
from ticketlens.functions.text import plain_text, sorted_joined, sorted_words
from ticketlens.sources import tables, tickets

QUERIES = {}
ORACLE = {}

FIELDS = ["click", "error", "purchase", "signup", "view"]
# fixture event types under display names of the default catalogue; view stays unknown
NAMES = {"click": "Fix Version", "error": "timespent", "purchase": "Epic Owner", "signup": "Target start"}
NAME_SQL = "CASE field WHEN 'click' THEN 'Fix Version' WHEN 'error' THEN 'timespent' WHEN 'purchase' THEN 'Epic Owner' WHEN 'signup' THEN 'Target start' ELSE field END"


def scalar_changes(spark, sf):
    rows = fixture(spark, sf, "fx_change")
    return rows.select(
        "key", "changed_at", "history_id", F.lit(0).alias("item_ord"), F.col("field").alias("header"),
        F.col("before_value").alias("before"), F.col("after_value").alias("after"),
    )


def current_scalars(spark, sf):
    return fixture(spark, sf, "fx_current")


def tag_changes(spark, sf):
    rows = fixture(spark, sf, "fx_tag_change")
    return rows.select(
        "key", "changed_at", "history_id", F.lit(0).alias("item_ord"), F.lit("tags").alias("header"),
        F.col("before_value").alias("before"), F.col("after_value").alias("after"),
    )


def current_tags(spark, sf):
    return fixture(spark, sf, "fx_tag_current").select("key", F.lit("tags").alias("header"), F.col("tags").alias("value"))


def all_states(spark, sf, **options):
    """Scalars and the tag list of every key after each change and at its creation."""
    lists = history.replay_list(current_tags(spark, sf), tag_changes(spark, sf))
    now = current_scalars(spark, sf).join(fixture(spark, sf, "fx_tag_current"), "key")
    scalars = scalar_changes(spark, sf).drop("after")
    times = fixture(spark, sf, "fx_tag_change").select("key", "changed_at")
    # every event is one change time of its user
    sizes = table(spark, sf, "events").select(F.col("user_id").alias("key"))
    return history.states(now, scalars.unionByName(lists), [*FIELDS, "tags"], times=times, sizes=sizes, **options)


# the newest change of a key is row 1; each step undoes one change
WALK = """
walk AS (SELECT key, history_id, changed_at, before_value, after_value,
                row_number() OVER (PARTITION BY key ORDER BY changed_at DESC, history_id DESC) AS rn FROM fx_tag_change),
undo(key, rn, history_id, changed_at, held, undoable) AS (
  SELECT key, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS TIMESTAMP), list_filter(string_split(tags, '#'), lambda t: t <> ''), true FROM fx_tag_current
  UNION ALL
  SELECT w.key, w.rn, w.history_id, w.changed_at,
         CASE WHEN w.before_value IS NULL AND list_contains(u.held, w.after_value) THEN list_filter(u.held, lambda t: t <> w.after_value)
              WHEN w.after_value IS NULL AND NOT list_contains(u.held, w.before_value) THEN list_append(u.held, w.before_value) ELSE u.held END,
         CASE WHEN w.before_value IS NULL THEN list_contains(u.held, w.after_value) ELSE NOT list_contains(u.held, w.before_value) END
  FROM undo u JOIN walk w ON w.key = u.key AND w.rn = u.rn + 1),
tag_log AS (SELECT key, history_id, changed_at, undoable, nullif(array_to_string(held, '#'), '') AS tags_before FROM undo WHERE rn > 0)
"""
MARKS = ",\n".join(
    f"first_value(CASE WHEN field = '{f}' THEN coalesce(before_value, '~') END IGNORE NULLS) OVER later AS {f}" for f in FIELDS)
STATES = f"""
points AS (SELECT key, changed_at AS t, field, before_value FROM fx_change
           UNION ALL SELECT key, created, NULL, NULL FROM fx_current),
marks AS (SELECT key, t, {MARKS} FROM points
          WINDOW later AS (PARTITION BY key ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
states AS (SELECT m.key, m.t AS valid_from, {', '.join(f"CASE WHEN m.{f} IS NULL THEN c.{f} ELSE nullif(m.{f}, '~') END AS {f}" for f in FIELDS)}
           FROM marks m JOIN fx_current c ON c.key = m.key)
"""
STATE_COLUMNS = "key, valid_from, " + ", ".join(FIELDS)


def with_states(select: str) -> str:
    return (with_views("", "fx_change", "fx_current").rstrip() + ",\n" + STATES + select).replace("`", '"')


def with_tag_log(select: str, extra: str = "") -> str:
    base = with_views("", "fx_change", "fx_current", "fx_tag_change", "fx_tag_current").rstrip()
    return base + ",\n" + WALK + extra + select


def change_items(spark, sf):
    """Change items under catalogue names, with ids beside the texts."""
    rows = fixture(spark, sf, "fx_change")
    name = F.coalesce(*[F.when(F.col("field") == k, F.lit(v)) for k, v in NAMES.items()], F.col("field"))
    return rows.select(
        "key", "history_id", F.lit(0).alias("item_ord"), "changed_at", name.alias("field"),
        F.concat(F.lit("id"), "before_value").alias("from_id"), F.concat(F.lit("id"), "after_value").alias("to_id"),
        F.col("before_value").alias("from_string"), F.col("after_value").alias("to_string"),
    )


# columns a display name feeds: header, picks id, list
ROUTES = """
routes(field, header, picks_id) AS (VALUES
  ('Fix Version', 'epic_fix_version', false), ('Fix Version', 'epic_PI', false), ('Fix Version', 'epic_release_name', false),
  ('timespent', 'epic_jira_spent_dev_etc_md', false), ('Epic Owner', 'epic_owner', false), ('Epic Owner', 'epic_owner_email', false),
  ('Target start', 'epic_target_start', true)),
"""
ITEMS = f"items AS (SELECT key, history_id, {NAME_SQL} AS field, before_value, after_value FROM fx_change)\n"

QUERIES["field_routing"] = lambda spark, sf: history.route_changes(change_items(spark, sf)).select("key", "history_id", "field", "header", "is_list")
ORACLE["field_routing"] = with_views("", "fx_change").rstrip() + ",\n" + ROUTES + ITEMS + (
    "SELECT i.key, i.history_id, i.field, r.header, i.field = 'Fix Version' AS is_list FROM items i JOIN routes r ON r.field = i.field")
QUERIES["id_or_string"] = lambda spark, sf: history.route_changes(change_items(spark, sf)).select("history_id", "header", "before", "after")
ORACLE["id_or_string"] = with_views("", "fx_change").rstrip() + ",\n" + ROUTES + ITEMS + (
    "SELECT i.history_id, r.header, CASE WHEN r.picks_id THEN 'id' || i.before_value ELSE i.before_value END AS before, "
    "CASE WHEN r.picks_id THEN 'id' || i.after_value ELSE i.after_value END AS after FROM items i JOIN routes r ON r.field = i.field")


def _normalise_changes(spark, sf):
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("name"), F.concat(F.lower("c_name"), F.lit("@x.org")).alias("email"))
    rows = history.normalise_changes(history.route_changes(change_items(spark, sf)), people)
    spent = F.col("header") == "epic_jira_spent_dev_etc_md"  # days back to seconds, as whole numbers

    def shown(c):
        return F.when(spent, F.round(F.col(c).try_cast("double") * 86400).cast("long").cast("string")).otherwise(F.col(c)).alias(c)

    return rows.select("history_id", "header", shown("before"), shown("after"))


QUERIES["normalise_changes"] = _normalise_changes
ORACLE["normalise_changes"] = with_views("", "fx_change").rstrip() + ",\n" + ROUTES + ITEMS + """
, people AS (SELECT CAST(c_custkey AS VARCHAR) AS name, lower(c_name) || '@x.org' AS email FROM customer),
raw AS (SELECT i.history_id, r.header, CASE WHEN r.picks_id THEN 'id' || i.before_value ELSE i.before_value END AS before,
        CASE WHEN r.picks_id THEN 'id' || i.after_value ELSE i.after_value END AS after FROM items i JOIN routes r ON r.field = i.field)
SELECT history_id, header,
  CASE header WHEN 'epic_owner_email' THEN b.email WHEN 'epic_jira_spent_dev_etc_md' THEN coalesce(before, '0') ELSE before END AS before,
  CASE header WHEN 'epic_owner_email' THEN a.email WHEN 'epic_jira_spent_dev_etc_md' THEN coalesce(after, '0') ELSE after END AS after
FROM raw LEFT JOIN people b ON b.name = raw.before LEFT JOIN people a ON a.name = raw.after"""

QUERIES["undo_scalar"] = lambda spark, sf: history.replay_scalar(current_scalars(spark, sf), scalar_changes(spark, sf), FIELDS)
ORACLE["undo_scalar"] = with_states(
    f"SELECT {STATE_COLUMNS} FROM states WHERE (key, valid_from) NOT IN (SELECT (key, created) FROM fx_current)")

QUERIES["undo_list"] = lambda spark, sf: history.replay_list(current_tags(spark, sf), tag_changes(spark, sf)).select(
    "key", "history_id", "changed_at", F.col("before").alias("tags_before"))
ORACLE["undo_list"] = with_tag_log("SELECT key, history_id, changed_at, tags_before FROM tag_log WHERE undoable")

# in short pieces, so that lists are carried as spans of their tags
LISTS_FROM = "2024-01-15"
QUERIES["asked_lists"] = lambda spark, sf: history.replay_list(
    current_tags(spark, sf), tag_changes(spark, sf), list_rows=20, asked=history.on_or_after(LISTS_FROM)).select(
    "key", "history_id", "changed_at", F.col("before").alias("tags_before"))
ORACLE["asked_lists"] = with_tag_log(
    f"SELECT key, history_id, changed_at, tags_before FROM tag_log WHERE undoable AND changed_at >= DATE '{LISTS_FROM}'")


def _unresolved(spark, sf):
    effects = history.list_effects(current_tags(spark, sf), tag_changes(spark, sf))
    return history.unresolved(change_items(spark, sf), effects, list(DEFAULT.routes()))


QUERIES["unresolved_changes"] = _unresolved
ORACLE["unresolved_changes"] = with_tag_log(
    "SELECT field, 'unknown field' AS reason, count(*) AS n FROM fx_change WHERE field = 'view' GROUP BY 1 "
    "UNION ALL SELECT 'tags', 'not undoable', count(*) FROM tag_log WHERE NOT undoable HAVING count(*) > 0 ORDER BY 1, 2")

QUERIES["history_states"] = lambda spark, sf: all_states(spark, sf)
ORACLE["history_states"] = with_tag_log(
    f"""SELECT s.key, s.valid_from, {', '.join('s.' + f for f in FIELDS)},
        CASE WHEN count(l.history_id) OVER later = 0 THEN nullif(c.tags, '')
             ELSE nullif(first_value(coalesce(l.tags_before, '~') IGNORE NULLS) OVER later, '~') END AS tags
        FROM states s JOIN fx_tag_current c ON c.key = s.key LEFT JOIN tag_log l ON l.key = s.key AND l.changed_at = s.valid_from
        WINDOW later AS (PARTITION BY s.key ORDER BY s.valid_from ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    extra=", " + STATES)

PRUNE = "2024-01-15"
QUERIES["prune_history"] = lambda spark, sf: history.states(
    current_scalars(spark, sf), scalar_changes(spark, sf), FIELDS, min_valid_from=PRUNE)
ORACLE["prune_history"] = with_states(
    f"SELECT {STATE_COLUMNS} FROM states s WHERE valid_from >= TIMESTAMP '{PRUNE}' OR valid_from = (SELECT max(changed_at) FROM fx_change c WHERE c.key = s.key)")

QUERIES["equivalence_match"] = lambda spark, sf: history.equivalent(
    scalar_changes(spark, sf), "before", "after", fixture(spark, sf, "fx_equivalence")).select("history_id", "before", "after", "match")
ORACLE["equivalence_match"] = with_views("""
SELECT c.history_id, c.before_value AS before, c.after_value AS after,
       CASE WHEN c.before_value = c.after_value THEN 'equal'
            WHEN coalesce(c.before_value, '') = '' AND coalesce(c.after_value, '') = '' THEN 'empty'
            WHEN EXISTS (SELECT 1 FROM fx_equivalence e WHERE (e.var1 = c.before_value AND e.var2 = c.after_value)
                         OR (e.var1 = c.after_value AND e.var2 = c.before_value)) THEN 'listed' ELSE 'new' END AS match
FROM fx_change c""", "fx_change", "fx_equivalence")

QUERIES["new_equivalences"] = lambda spark, sf: history.new_equivalences(
    scalar_changes(spark, sf), "before", "after", fixture(spark, sf, "fx_equivalence"))
ORACLE["new_equivalences"] = with_views("""
SELECT DISTINCT CASE WHEN v1 IS NULL OR NOT has_low THEN v1 ELSE low END AS var1, CASE WHEN v1 IS NULL OR NOT has_low THEN v2 ELSE high END AS var2
FROM (SELECT min(before_value) FILTER (WHERE before_value IS NOT NULL) AS v0, least(coalesce(before_value, ''), coalesce(after_value, '')) AS low,
             greatest(coalesce(before_value, ''), coalesce(after_value, '')) AS high,
             bool_or(before_value = least(coalesce(before_value, ''), coalesce(after_value, ''))) AS has_low,
             CASE WHEN bool_or(before_value IS NULL) THEN NULL ELSE min(before_value) END AS v1, min(after_value) AS v2
      FROM fx_change GROUP BY 2, 3) p
WHERE low <> high AND NOT EXISTS (SELECT 1 FROM fx_equivalence e WHERE least(e.var1, e.var2) = p.low AND greatest(e.var1, e.var2) = p.high)""",
    "fx_change", "fx_equivalence")


def _blank(spark, sf):
    rows = fixture(spark, sf, "fx_tag_current")
    return history.blank_to_null(rows.withColumn("first_tag", F.regexp_extract("tags", "^(click|view)", 1)))


QUERIES["blank_to_null"] = _blank
ORACLE["blank_to_null"] = with_views(
    "SELECT key, nullif(tags, '') AS tags, nullif(regexp_extract(tags, '^(click|view)', 1), '') AS first_tag FROM fx_tag_current", "fx_tag_current")


def _skip_failed(spark, sf):
    """Changes without a before value count as rejected."""
    good, bad = tickets.split_bad(scalar_changes(spark, sf), ["key", "before"])
    return good.groupBy("header").agg(F.count(F.lit(1)).alias("good")).join(
        bad.groupBy("header").agg(F.count(F.lit(1)).alias("rejected")), "header", "left")


QUERIES["skip_failed"] = _skip_failed
ORACLE["skip_failed"] = with_views(
    "SELECT field AS header, count(before_value) AS good, nullif(count(*) - count(before_value), 0) AS rejected FROM fx_change GROUP BY 1", "fx_change")


def _ticket_lines(spark, sf):
    """A line of text per event: whole tickets, cut ones, other types, other JSON, and tickets without key or time."""
    kind = F.col("event_id") % 9
    key = F.when(kind == 3, F.lit("null")).otherwise(F.concat(F.lit('"E'), F.col("event_id"), F.lit('"')))
    made = F.when(kind == 4, F.lit("null")).otherwise(F.lit('"2024-01-01T00:00:00.000+0000"'))
    fields = F.when(kind == 2, F.lit("5")).otherwise(F.lit('{"status":{"name":"Open"}}'))
    whole = F.concat(F.lit('{"key":'), key, F.lit(',"created":'), made, F.lit(',"fields":'), fields, F.lit(',"changelog":{"histories":[]}}'))
    line = F.when(kind == 1, F.substr(whole, F.lit(1), F.length(whole) - 7)).when(kind == 5, F.concat(F.lit("["), F.col("event_id"), F.lit("]"))).otherwise(whole)
    folder = scratch_folder(spark)
    table(spark, sf, "events").select(line.alias("value")).write.text(folder)
    return tickets.read_tickets(spark, folder, keep_corrupt=True)


def _rejected_records(spark, sf):
    """Every line: usable, or the reason and the text that was rejected."""
    good, bad = tickets.split_tickets(_ticket_lines(spark, sf))
    return good.select(F.lit("usable").alias("reason"), "key", F.lit(None).cast("string").alias("record")).unionByName(
        bad.select("reason", F.when(F.col("record").isNull(), F.col("key")).alias("key"), "record"))


QUERIES["rejected_records"] = _rejected_records
ORACLE["rejected_records"] = """
WITH lines AS (SELECT event_id, event_id % 9 AS kind, '{"key":' || CASE WHEN event_id % 9 = 3 THEN 'null' ELSE '"E' || event_id || '"' END || ',"created":'
  || CASE WHEN event_id % 9 = 4 THEN 'null' ELSE '"2024-01-01T00:00:00.000+0000"' END || ',"fields":'
  || CASE WHEN event_id % 9 = 2 THEN '5' ELSE '{"status":{"name":"Open"}}' END || ',"changelog":{"histories":[]}}' AS line FROM events)
SELECT CASE kind WHEN 1 THEN 'broken JSON' WHEN 2 THEN 'wrong type: fields' WHEN 3 THEN 'no key' WHEN 4 THEN 'no creation time' WHEN 5 THEN 'no object' ELSE 'usable' END AS reason,
  CASE WHEN kind NOT IN (1, 2, 3, 5) THEN 'E' || event_id END AS key,
  CASE kind WHEN 1 THEN left(line, length(line) - 7) WHEN 2 THEN line WHEN 5 THEN '[' || event_id || ']' END AS record FROM lines"""


def _daily(spark, sf):
    states = history.states(current_scalars(spark, sf), scalar_changes(spark, sf), FIELDS)
    return snapshots.daily_last(states)


DAILY = """
, daily AS (SELECT *, CAST(valid_from AS DATE) AS extract_date FROM states
            QUALIFY row_number() OVER (PARTITION BY key, CAST(valid_from AS DATE) ORDER BY valid_from DESC) = 1)
"""
QUERIES["daily_last"] = _daily
ORACLE["daily_last"] = with_states(DAILY + f"SELECT extract_date, {STATE_COLUMNS} FROM daily")
QUERIES["period_filter"] = lambda spark, sf: snapshots.between_days(_daily(spark, sf), "2024-01-05", "2024-01-20")
ORACLE["period_filter"] = with_states(
    DAILY + f"SELECT extract_date, {STATE_COLUMNS} FROM daily WHERE extract_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
TARGETS = ["2024-01-01", "2024-01-10", "2024-01-11", "2024-01-25", "2025-06-30"]
QUERIES["asof_targets"] = lambda spark, sf: snapshots.asof(
    history.states(current_scalars(spark, sf), scalar_changes(spark, sf), FIELDS), TARGETS, keep_target=True)
ORACLE["asof_targets"] = with_states(
    ", targets(target_date) AS (VALUES " + ", ".join(f"(DATE '{t}')" for t in TARGETS) + f""")
SELECT t.target_date, CAST(s.valid_from AS DATE) AS extract_date, {STATE_COLUMNS} FROM targets t JOIN states s ON CAST(s.valid_from AS DATE) <= t.target_date
QUALIFY row_number() OVER (PARTITION BY key, t.target_date ORDER BY valid_from DESC) = 1""")
QUERIES["column_order"] = lambda spark, sf: snapshots.lead_columns(_daily(spark, sf).drop("valid_from"))
ORACLE["column_order"] = with_states(DAILY + f"SELECT extract_date, key, {', '.join(FIELDS)} FROM daily")


def raw_tickets(spark, sf):
    """Nested tickets, one per order, with two histories each."""
    orders = table(spark, sf, "orders")

    def item(field, old, new, old_text, new_text):
        return F.struct(F.lit(field).alias("field"), old.cast("string").alias("from"), new.cast("string").alias("to"),
                        old_text.cast("string").alias("fromString"), new_text.cast("string").alias("toString"))

    fields = F.struct(
        F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        F.struct(F.col("o_orderstatus").alias("name")).alias("status"),
        F.when(F.col("o_orderkey") % 3 > 0, F.array(F.struct(F.concat(F.lit("R"), (F.col("o_orderkey") % 7).cast("string")).alias("name")),
                F.struct(F.concat(F.lit("Q"), (F.col("o_orderkey") % 5).cast("string")).alias("name")))).alias("fixVersions"),
        F.array(F.col("o_orderpriority"), F.lit("a,b")).alias("labels"),
        F.struct(F.concat(F.lit('Doe, "'), F.col("o_custkey").cast("string")).alias("displayName"),
                 F.concat(F.lit("U"), F.col("o_custkey").cast("string"), F.lit("@X.org")).alias("emailAddress")).alias("customfield_18903"),
        F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderkey") * 100).alias("timeoriginalestimate"),
        F.struct((F.col("o_custkey") * 60).alias("timeSpentSeconds"), F.lit(None).cast("bigint").alias("remainingEstimateSeconds")).alias("timetracking"),
        F.concat(F.lit('a "big", order '), F.col("o_orderkey").cast("string")).alias("summary"),
    )
    histories = F.array(
        F.struct(F.col("o_orderdate").cast("string").alias("created"), F.array(
            item("status", F.lit(1), F.lit(2), F.lit("Open"), F.col("o_orderstatus")),
            item("colour", F.lit(1), F.lit(2), F.lit("red"), F.lit("blue"))).alias("items")),
        F.struct((F.col("o_orderdate") + F.expr("INTERVAL '1' DAY")).cast("string").alias("created"), F.array(
            item("Fix Version", F.lit(None), F.col("o_orderkey"), F.lit(None), F.concat(F.lit("R"), (F.col("o_orderkey") % 7).cast("string")))).alias("items")),
    )
    created = (F.col("o_orderdate") - F.expr("INTERVAL '1' DAY")).cast("string")
    return orders.select(F.concat(F.lit("T-"), F.col("o_orderkey").cast("string")).alias("key"), created.alias("created"),
                         fields.alias("fields"), F.struct(histories.alias("histories")).alias("changelog"))


def _held(raw):
    """The catalogue of the fields these tickets have."""
    return DEFAULT.restricted(set(raw.schema["fields"].dataType.names))


def _rounded(df):
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[F.round(c, 6).alias(c) if c in doubles else c for c in df.columns])


def _current(spark, sf):
    raw = raw_tickets(spark, sf)
    return _rounded(tickets.flatten_current(raw, _held(raw)))


FIX = "CASE WHEN o_orderkey % 3 > 0 THEN 'Q' || (o_orderkey % 5) || '#R' || (o_orderkey % 7) END"
FLAT = """o_orderpriority || '#a,b' AS epic_labels, 'Doe  ' || o_custkey AS epic_owner, {mail} AS epic_owner_email,
       round(CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey * 100 / 86400.0::DOUBLE ELSE 0.0::DOUBLE END, 6) AS epic_jira_forecast_dev_etc_md,
       round(o_custkey * 60 / 86400.0::DOUBLE, 6) AS epic_jira_spent_dev_etc_md, 0.0::DOUBLE AS epic_jira_remaining_dev_etc_md,
       'a big  order ' || o_orderkey AS epic_summary, o_orderpriority AS epic_priority""".format(mail="'u' || o_custkey || '@x.org'")


def versions_sql(value: str) -> str:
    return ", ".join(f'{value} AS "{c}"' for c in ("epic_fix_version", "epic_PI", "epic_release_name"))


QUERIES["flatten_current"] = _current
ORACLE["flatten_current"] = f"SELECT 'T-' || o_orderkey AS issuekey, o_orderstatus AS epic_status, {versions_sql(FIX)}, {FLAT} FROM orders"


def _panel(spark, sf):
    """Nested tickets to daily snapshots in one plan."""
    raw = raw_tickets(spark, sf)
    return _rounded(jobs.panel_from_tickets(raw, _held(raw)))


EARLIER = "CASE WHEN o_orderkey % 3 > 0 THEN 'Q' || (o_orderkey % 5) END"
QUERIES["ticket_panel"] = _panel
ORACLE["ticket_panel"] = " UNION ALL ".join(
    f"""SELECT CAST(o_orderdate AS DATE) + {day} AS extract_date, 'T-' || o_orderkey AS key, 'T-' || o_orderkey AS issuekey,
    {status} AS epic_status, {versions_sql(fix)}, {FLAT} FROM orders"""
    for day, status, fix in ((-1, "'Open'", EARLIER), (0, "o_orderstatus", EARLIER), (1, "o_orderstatus", FIX)))

QUERIES["flatten_changes"] = lambda spark, sf: tickets.flatten_changes(raw_tickets(spark, sf))
ORACLE["flatten_changes"] = """
SELECT 'T-' || o_orderkey AS key, CAST(0 AS BIGINT) AS history_id, 0 AS item_ord, CAST(o_orderdate AS VARCHAR) AS changed_at, 'status' AS field,
       '1' AS from_id, '2' AS to_id, 'Open' AS from_string, o_orderstatus AS to_string FROM orders
UNION ALL
SELECT 'T-' || o_orderkey, 1, 0, CAST(o_orderdate + INTERVAL 1 DAY AS VARCHAR), 'Fix Version',
       NULL, CAST(o_orderkey AS VARCHAR), NULL, 'R' || (o_orderkey % 7) FROM orders"""



def _write_table(spark, sf):
    """Orders written by status and read back."""
    folder = scratch_folder(spark)
    tables.write_table(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), folder, "parquet", partition_by=["o_orderstatus"])
    return tables.read_table(spark, folder)


def _csv(spark, sf):
    """Parts through CSV with inferred types."""
    folder = scratch_folder(spark)
    tables.write_table(table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), folder, "csv")
    return tables.read_table(spark, folder, "csv").select(F.col("p_partkey").cast("long").alias("p_partkey"), "p_name", "p_retailprice")


def _metrics(spark, sf):
    """Counts per status as JSON metrics."""
    folder = scratch_folder(spark)
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))
    tables.write_metrics(counts, folder)
    return tables.read_table(spark, folder, "json", "o_orderstatus string, n long, mean double")


def _params(spark, sf):
    """Parameters made from the orders, stored in both shapes and read back."""
    folder = scratch_folder(spark)
    sizes = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).cast("int").alias("k_features"))
    flat = F.struct("k_features", F.struct((F.col("k_features") % 50).alias("n_estimators"), F.col("o_orderstatus").alias("max_features")).alias("rf_params"))
    wrapped = F.col("o_orderstatus") == "F"
    sizes.select(F.when(wrapped, flat).alias("best_params"), F.when(~wrapped, flat).alias("flat")).select(
        "best_params", "flat.*").coalesce(1).write.json(folder)
    return tables.read_params(spark, folder, multi_line=False).select("k_features", "rf_params.n_estimators", "rf_params.max_features")


QUERIES["write_table"] = _write_table
ORACLE["write_table"] = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders"
QUERIES["csv_round_trip"] = _csv
ORACLE["csv_round_trip"] = "SELECT p_partkey, p_name, p_retailprice FROM part"
QUERIES["write_metrics"] = _metrics
ORACLE["write_metrics"] = "SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1"
QUERIES["read_params"] = _params
ORACLE["read_params"] = """
SELECT CAST(count(*) AS INTEGER) AS k_features, CAST(count(*) % 50 AS INTEGER) AS n_estimators, o_orderstatus AS max_features FROM orders GROUP BY o_orderstatus"""


def _normalisers(spark, sf):
    """The value normalisers on texts of the tables."""
    docs = table(spark, sf, "documents")
    stamped = F.concat(F.lit("2024-0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("-15T23:30:00.000+0200"))
    return docs.select(
        "doc_id", plain_text(F.col("text")).alias("plain"), F.md5(sorted_words(F.col("text"))).alias("words"),
        sorted_joined(F.array("source", "lang")).alias("joined"), RULES["float"](F.col("n_chars").cast("string")).alias("number"),
        RULES["int"](F.col("lang")).alias("no_number"), text_day(stamped).alias("day"))


QUERIES["normalisers"] = _normalisers
ORACLE["normalisers"] = """
SELECT doc_id, replace(replace(text, ',', ' '), '"', '') AS plain, md5(array_to_string(list_sort(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')), '#')) AS words, least(source, lang) || '#' || greatest(source, lang) AS joined,
       CAST(n_chars AS DOUBLE) AS number, CAST(NULL AS INTEGER) AS no_number, CAST('2024-0' || (doc_id % 9 + 1) || '-15' AS DATE) AS day
FROM documents"""

QUERIES["read_table"] = lambda spark, sf: tables.read_table(spark, f"{sf}/orders.parquet").filter("o_totalprice > 1000").select("o_orderkey", "o_orderstatus")
ORACLE["read_table"] = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 1000"
