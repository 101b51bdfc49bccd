"""Chat formatting: records of several layouts become canonical turns, then one marked text.

A record is a JSON object. The paths of its nested fields, sorted and hashed,
are its fingerprint; the fingerprint selects a declared mapping, and the mapping
says where the turns are. A conversation is written with turn marks; marks inside
texts are escaped reversibly. The loss mask is a list of spans, one per
assistant text.

Only DataFrame operations. A conversation is one value of one row in the end, as
its formatted text must be; nothing larger is gathered.

Defined cases: a null text is empty, a null role is an empty role. Rows that
repeat a conversation's turn are turns of their own, ordered by role and text. A
record whose fingerprint is unknown has null turns; `unknown_layouts` counts
them. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Template marks. Every mark begins with "<", and texts never hold a bare "<" or "[" once escaped.
TURN_BEGIN = "<|turn|>"
TURN_END = "<|end|>\n"
#: The escape puts this after each character that could begin a control string.
ESCAPE = ";"
CONTROL_STARTS = ("<", "[")

TURNS = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class Layout:
    """A declared mapping: the field paths of a record, and the SQL type and expression that give its turns."""

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: str

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256("|".join(sorted(self.paths)).encode()).hexdigest()


def _turn(role: str, field: str) -> str:
    return f"named_struct('role', '{role}', 'content', r.{field})"


LAYOUTS = (
    Layout(
        "messages", ("messages", "messages[].content", "messages[].role"),
        "messages array<struct<role:string,content:string>>", "r.messages",
    ),
    Layout(
        "sharegpt", ("conversations", "conversations[].from", "conversations[].value"),
        "conversations array<struct<`from`:string,value:string>>",
        "transform(r.conversations, x -> named_struct('role', CASE x.`from` WHEN 'human' THEN 'user' "
        "WHEN 'gpt' THEN 'assistant' ELSE x.`from` END, 'content', x.value))",
    ),
    Layout(
        "prompt", ("prompt", "response"), "prompt string, response string",
        f"array({_turn('user', 'prompt')}, {_turn('assistant', 'response')})",
    ),
    Layout(
        "instruction", ("input", "instruction", "output"), "instruction string, input string, output string",
        f"array({_turn('system', 'instruction')}, {_turn('user', 'input')}, {_turn('assistant', 'output')})",
    ),
)


def field_paths(record: Column) -> Column:
    """Sorted paths of a JSON object at any depth, over all elements of its arrays: `a`, `a.b` in objects, `a[].b` in arrays.

    Read off the record's type, which puts the fields of all elements together. A
    record that has none (text that is no JSON) gives the paths of its first level.
    """
    kind = F.schema_of_variant(F.try_parse_json(record))
    marks = F.regexp_extract_all(kind, F.lit(r"(OBJECT<|ARRAY<|>|(?:`(?:[^`]|``)+`|[^<>,: ]+): )"), F.lit(1))
    start = F.struct(F.array(F.lit("")).alias("above"), F.lit("").alias("at"), F.array().cast("array<string>").alias("paths"))

    def read(state: Column, mark: Column) -> Column:
        above, at, paths = state["above"], state["at"], state["paths"]
        inside = F.when(mark == "ARRAY<", F.concat(at, F.lit("[]"))).when(at == "", "").otherwise(F.concat(at, F.lit(".")))
        named = F.concat(F.element_at(above, -1), F.substr(mark, F.lit(1), F.length(mark) - 2))
        return (
            F.when(mark == ">", F.struct(F.slice(above, F.lit(1), F.size(above) - 1).alias("above"), at.alias("at"), paths.alias("paths")))
            .when(mark.isin("OBJECT<", "ARRAY<"), F.struct(
                F.array_append(above, inside).alias("above"), F.when(mark == "ARRAY<", inside).otherwise(at).alias("at"), paths.alias("paths")))
            .otherwise(F.struct(above.alias("above"), named.alias("at"), F.array_append(paths, named).alias("paths")))
        )

    found = F.array_sort(F.array_distinct(F.aggregate(marks, start, read, lambda s: s["paths"])))
    return F.coalesce(found, _first_level(record))


def _first_level(record: Column) -> Column:
    keys = F.json_object_keys(record)
    nested = F.flatten(
        F.transform(
            keys,
            lambda k: F.transform(
                F.coalesce(
                    F.json_object_keys(F.call_function("get_json_object", record, F.concat(F.lit("$['"), k, F.lit("'][0]")))),
                    F.array().cast("array<string>"),
                ),
                lambda inner: F.concat(k, F.lit("[]."), inner),
            ),
        )
    )
    return F.array_sort(F.concat(keys, nested))


def fingerprint(record: Column) -> Column:
    return F.sha2(F.array_join(field_paths(record), "|"), 256)


def canonical_turns(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds layout and turns (role, content) to each record."""
    printed = records.withColumn("__print", fingerprint(F.col(record)))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        here = F.col("__print") == layout.fingerprint
        parsed = F.from_json(F.col(record), layout.schema)
        mapped = F.expr("transform(array(__parsed), r -> " + layout.turns + ")[0]")
        printed = printed.withColumn("__parsed", F.when(here, parsed)).withColumn(
            f"__{layout.name}", F.when(here, mapped).cast(TURNS)
        ).drop("__parsed")
        name, turns = F.when(here, layout.name).otherwise(name), F.coalesce(F.col(f"__{layout.name}"), turns)
    filled = F.transform(
        turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["content"], F.lit("")).alias("content"))
    )
    return printed.select("*", name.alias("layout"), filled.alias("turns")).drop(
        "__print", *[f"__{layout.name}" for layout in layouts]
    )


def unknown_layouts(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Fingerprint, one example of its paths and the number of records that no layout covers."""
    known = [layout.fingerprint for layout in layouts]
    found = records.select(fingerprint(F.col(record)).alias("fingerprint"), F.array_join(field_paths(F.col(record)), "|").alias("paths"))
    return (
        found.filter(~F.coalesce(F.col("fingerprint").isin(known), F.lit(False)))
        .groupBy("fingerprint").agg(F.min("paths").alias("paths"), F.count(F.lit(1)).alias("records"))
    )


def escape(text: Column) -> Column:
    for start in CONTROL_STARTS:
        text = F.replace(text, F.lit(start), F.lit(start + ESCAPE))
    return text


def unescape(text: Column) -> Column:
    for start in CONTROL_STARTS:
        text = F.replace(text, F.lit(start + ESCAPE), F.lit(start))
    return text


def _header(role: Column) -> Column:
    """Roles are URL-encoded, so any role is one line without marks."""
    return F.concat(F.lit(TURN_BEGIN), F.url_encode(role), F.lit("\n"))


def format_turns(conversations: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds formatted, the text of all turns, and loss_spans (start and length in code points) of the assistant texts."""
    written = F.transform(
        turns, lambda t: F.concat(_header(t["role"]), escape(t["content"]), F.lit(TURN_END))
    )
    with_text = conversations.select("*", written.alias("__written"))
    # the running length is folded once; a span follows from the length up to and including its turn
    ends = F.aggregate(
        "__written",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("ends")),
        lambda acc, w: F.struct(
            (acc["at"] + F.length(w)).alias("at"), F.array_append(acc["ends"], acc["at"] + F.length(w)).alias("ends")
        ),
    )["ends"]
    placed = with_text.select("*", ends.alias("__ends"))
    size = lambda t: F.length(escape(t["content"])).cast("long")
    spans = F.transform(
        F.filter(
            F.transform(
                turns,
                lambda t, i: F.struct(
                    t["role"].alias("role"),
                    (F.get("__ends", i) - len(TURN_END) - size(t)).alias("start"), size(t).alias("length"),
                ),
            ),
            lambda s: s["role"] == "assistant",
        ),
        lambda s: F.struct(s["start"], s["length"]),
    )
    return placed.select(
        *conversations.columns, F.array_join("__written", "").alias("formatted"), spans.alias("loss_spans")
    )


def read_back(formatted: DataFrame, column: str = "formatted") -> DataFrame:
    """Adds turns_read (role, content) and loss_read, parsed from the formatted text and its spans alone."""
    parts = F.filter(F.split(F.col(column), _literal(TURN_END)), lambda p: p != "")
    body = F.transform(parts, lambda p: F.substr(p, F.lit(len(TURN_BEGIN) + 1)))
    turns = F.transform(
        body,
        lambda b: F.struct(
            F.url_decode(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.substr(b, F.locate("\n", b) + 1)).alias("content"),
        ),
    )
    loss = F.transform(
        "loss_spans", lambda s: unescape(F.substr(F.col(column), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return formatted.select("*", turns.alias("turns_read"), loss.alias("loss_read"))


def _literal(mark: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "\n" else c for c in mark)


def gather_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id and turns, in order."""
    own = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("content"),
        ).alias("row"),
    )
    listed = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return listed.select("conv_id", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content"))).alias("turns"))


def as_records(conversations: DataFrame) -> DataFrame:
    """conv_id and record: each conversation in the layout that fits its roles, JSON as a collection would hold it."""
    roles = F.transform("turns", lambda t: t["role"])

    def are(*names: str) -> Column:
        return roles == F.array(*[F.lit(n) for n in names])

    content = lambda k: F.get("turns", F.lit(k))["content"]
    other = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
            t["content"].alias("value"),
        ),
    )
    plain = F.transform("turns", lambda t: t["role"].isin("user", "assistant", "system"))
    even = F.forall(plain, lambda x: x) & (F.pmod(F.xxhash64("conv_id"), F.lit(2)) == 0)
    record = (
        F.when(are("user", "assistant"), F.to_json(F.struct(content(0).alias("prompt"), content(1).alias("response"))))
        .when(
            are("system", "user", "assistant"),
            F.to_json(F.struct(content(0).alias("instruction"), content(1).alias("input"), content(2).alias("output"))),
        )
        .when(even, F.to_json(F.struct(other.alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.col("turns").alias("messages"))))
    )
    return conversations.select("conv_id", record.alias("record"))


def digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of what `read_back` found."""
    lines = F.transform("turns_read", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n")))
    loss = F.array_join("loss_read", "")
    return read.select(
        "conv_id", F.size("turns_read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
