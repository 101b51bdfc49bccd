"""Raw tickets with nested fields and change logs, flattened to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.catalogue import DEFAULT, Catalogue
from ticketlens.functions.normalise import RAW_TYPES, apply_rule
from ticketlens.skew import q

ITEM_TYPE = "struct<field:string,`from`:string,`to`:string,fromString:string,toString:string>"


def ticket_schema(catalogue: Catalogue = DEFAULT) -> str:
    """Schema of raw ticket JSON for the catalogued fields."""
    types = {}
    for h in catalogue.used_headers():
        rule = catalogue.current_rule(h)
        types[h.source] = RAW_TYPES.get(rule, types.get(h.source, "string"))
    fields = ",".join(f"`{s}`:{t}" for s, t in sorted(types.items()))
    log = f"changelog struct<histories:array<struct<created:string,items:array<{ITEM_TYPE}>>>>"
    return f"key string, created string, fields struct<{fields}>, {log}"


#: Column that holds the text of a line that is no ticket.
RECORD = "corrupt_record"


def read_tickets(spark: SparkSession, path: str, catalogue: Catalogue = DEFAULT, keep_corrupt: bool = False) -> DataFrame:
    """Raw tickets from JSON lines, one ticket per line, read without an inference pass.

    With `keep_corrupt` lines that do not fit the schema keep their text in RECORD (see `split_tickets`). They are then
    parsed as a whole: a reader that leaves out columns does not see what is wrong in them.
    """
    if not keep_corrupt:
        return spark.read.schema(ticket_schema(catalogue)).json(path)
    schema = f"{ticket_schema(catalogue)}, {RECORD} string"
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD})
    return lines.select(F.inline(F.array(parsed)))


def split_tickets(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable tickets, rejected ones with key, created, reason and, of lines that do not fit, their record).

    Broken JSON, JSON that is no object, and values of another type than the field's
    are told apart from tickets that lack a key or a creation time.
    """
    record = F.col(RECORD) if RECORD in raw.columns else F.lit(None).cast("string")
    parsed = F.try_parse_json(record)
    odd = [F.when(F.get_json_object(record, f"$.{c}").isNotNull() & q(c).isNull(), F.lit(c)) for c in ("key", "created", "fields", "changelog")]
    reason = (
        F.when(parsed.isNull() & record.isNotNull(), "broken JSON")
        .when(record.isNotNull() & ~F.ltrim(record).startswith("{"), "no object")
        .when(record.isNotNull(), F.concat(F.lit("wrong type: "), F.coalesce(*odd, F.lit("a nested field"))))
        .when(F.col("key").isNull(), "no key").when(F.col("created").isNull(), "no creation time")
    )
    judged = raw.withColumn("reason", reason)
    bad = judged.filter("reason IS NOT NULL").select("key", "created", "reason", record.alias("record"))
    return judged.filter("reason IS NULL").drop("reason", RECORD), bad


def flatten_current(raw: DataFrame, catalogue: Catalogue = DEFAULT, keep: Sequence[str] = ()) -> DataFrame:
    """One flat row per ticket: kept raw columns, `issuekey` and the catalogued columns in name order."""
    columns = {"issuekey": F.col("key")}
    for h in catalogue.used_headers():
        columns[h.name] = apply_rule(catalogue.current_rule(h), F.col("fields")[h.source], catalogue.seconds_per_day)
    return raw.select(*[q(c) for c in keep], *[columns[c].alias(c) for c in sorted(columns)])


def flatten_changes(raw: DataFrame, catalogue: Catalogue = DEFAULT) -> DataFrame:
    """One row per change item of a catalogued field, numbered by history and by item."""
    histories = raw.select("key", F.posexplode("changelog.histories").alias("history_id", "history"))
    items = histories.select(
        "key", F.col("history_id").cast("long"), F.col("history.created").alias("changed_at"),
        F.posexplode("history.items").alias("item_ord", "item"),
    )
    known = items.filter(F.col("item.field").isin(sorted(catalogue.routes())))
    return known.select(
        "key", "history_id", "item_ord", "changed_at", F.col("item.field").alias("field"),
        F.col("item")["from"].alias("from_id"), F.col("item")["to"].alias("to_id"),
        F.col("item.fromString").alias("from_string"), F.col("item.toString").alias("to_string"),
    )


def changed_fields(raw: DataFrame) -> DataFrame:
    """The field of every change item, known or not."""
    items = raw.select("key", F.explode("changelog.histories").alias("history")).select("key", F.explode("history.items").alias("item"))
    return items.select("key", F.col("item.field").alias("field"))


def changing_columns(raw: DataFrame, catalogue: Catalogue = DEFAULT) -> list[str]:
    """The columns that any change item of these tickets names; a pass over the change items that collects known names alone."""
    routes = catalogue.routes()
    known = changed_fields(raw).filter(F.col("field").isin(sorted(routes))).select("field").distinct().collect()
    return sorted({r.header for found in known for r in routes[found["field"]]})


def history_times(raw: DataFrame) -> DataFrame:
    """Every change time of every ticket, whatever field changed."""
    return raw.select("key", F.explode("changelog.histories.created").alias("changed_at"))


def split_bad(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rows that lack a required value)."""
    good = F.lit(True)
    for c in required:
        good = good & q(c).isNotNull()
    return df.filter(good), df.filter(~good)
