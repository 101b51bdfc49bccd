"""Ticket history: states rebuilt from the current ticket and its change log, newest to oldest.

The current ticket enters the log as its newest row, so a state is always "the
nearest later before-value" and no join is needed. All steps hold for a key
with any share of the rows (see `ticketlens.skew`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.catalogue import DEFAULT, Catalogue
from ticketlens.functions.normalise import SECONDS_PER_DAY, apply_rule
from ticketlens.functions.text import SEPARATOR, blank_as_null, tags
from ticketlens.session import materialize
from ticketlens.skew import HOT_ROWS, hot_groups, largest_group, last_before, lookup_join, q, range_chunks, split_hot

# changes one array fold may hold (its cost grows with the square); longer logs are folded piece by piece
LIST_ROWS = 1_000
# column of the fields that no change names
STILL = "still fields"


def route_changes(changes: DataFrame, catalogue: Catalogue = DEFAULT) -> DataFrame:
    """One row per change item and output column, with the value pair that column reads.

    The catalogue is a constant in the plan, not a table to join.
    """
    routes = catalogue.routes()
    pairs = []
    for name, targets in routes.items():
        rows = [
            F.struct(
                F.lit(t.header).alias("header"), F.lit(t.picks_id).alias("picks_id"),
                F.lit(t.is_list).alias("is_list"), F.lit(t.rule).alias("rule"),
            )
            for t in targets
        ]
        pairs += [F.lit(name), F.array(*rows)]
    routed = changes.withColumn("route", F.explode(F.try_element_at(F.create_map(*pairs), F.col("field"))))
    by_id = F.col("route.picks_id")
    return routed.select(
        "key", "history_id", "item_ord", "changed_at", "field", "route.header", "route.is_list", "route.rule",
        id_or_string(by_id, F.col("from_id"), F.col("from_string")).alias("before"),
        id_or_string(by_id, F.col("to_id"), F.col("to_string")).alias("after"),
    )


def id_or_string(picks_id: Column, by_id: Column, by_string: Column) -> Column:
    return F.when(picks_id, by_id).otherwise(by_string)


def normalise_changes(routed: DataFrame, people: DataFrame | None = None, seconds_per_day: int = SECONDS_PER_DAY) -> DataFrame:
    """Before and after values by the rule of their column; days have `seconds_per_day`.

    `people(name, email)` with unique names serves the e-mail rule; a name it
    does not list, or any name without it, gives null.
    """
    rules = ("text", "words", "float", "int", "days")

    def value(c: str) -> Column:
        out = F.when(F.col("rule") == "", q(c))
        for rule in rules:
            out = out.when(F.col("rule") == rule, apply_rule(rule, q(c), seconds_per_day).cast("string"))
        if people is not None:
            named = F.when(q(c).isNull() | (q(c) == ""), q(c)).otherwise(q(f"{c}_email"))
            out = out.when(F.col("rule") == "email_of_name", named)
        return out

    rows = routed
    if people is not None:
        for c in ("before", "after"):
            found = people.select(F.col("name").alias(f"{c}_name"), F.col("email").alias(f"{c}_email"))
            asked = rows.withColumn(f"{c}_name", F.when(F.col("rule") == "email_of_name", q(c)))
            rows = lookup_join(asked, found, [f"{c}_name"])
    return rows.select(
        *[value(c).alias(c) if c in ("before", "after") else q(c) for c in routed.columns if c != "rule"]
    )


def with_moment(df: DataFrame) -> DataFrame:
    """Adds `moment`, the point in time of `changed_at`. Texts with unlike zone offsets are in order only by it."""
    at = F.col("changed_at")
    text = df.schema["changed_at"].dataType.simpleString() == "string"
    return df.withColumn("moment", F.try_to_timestamp(at) if text else at.cast("timestamp"))


def _walk() -> list[Column]:
    """Newest to oldest; histories backwards, items of one history forwards."""
    return [
        F.col("recent").desc(), F.col("moment").desc(), F.col("history_id").desc(), F.col("item_ord").asc(),
        F.col("changed_at").desc(),
    ]


def _walk_rank() -> Column:
    """Ascending order of this struct is the reverse of the walk."""
    return F.struct("recent", "moment", "history_id", (-F.col("item_ord")).alias("item_back"), "changed_at")


def list_effects(current: DataFrame, changes: DataFrame, limit: int | None = HOT_ROWS) -> DataFrame:
    """List changes with `undoable`: an addition undoes if the tag is there, a removal if it is not.

    Whether a tag is there follows from the next later change of that tag alone.
    `current(key, header, value)` holds joined tags; its rows come back with recent = 1.
    """
    before, after = blank_as_null(F.col("before")), blank_as_null(F.col("after"))
    one_sided = before.isNull() != after.isNull()
    logged = with_moment(changes).select(
        "key", "header", "changed_at", "moment", "history_id", "item_ord", F.lit(0).alias("recent"),
        F.when(one_sided, F.coalesce(before, after)).alias("tag"), before.isNull().alias("added"),
    )
    held = current.select("key", "header", F.posexplode(F.array_distinct(tags(F.col("value")))).alias("item_ord", "tag"))
    start = held.select(
        "key", "header", F.lit(None).cast(changes.schema["changed_at"].dataType).alias("changed_at"),
        F.lit(None).cast("timestamp").alias("moment"), F.lit(0).cast("long").alias("history_id"), "item_ord", F.lit(1).alias("recent"), "tag", F.lit(False).alias("added"),
    )
    log = logged.unionByName(start)
    if limit is None:
        # no large group: one shuffle serves the fill by tag and whatever follows by key and header
        log = log.repartition("key", "header")
    later = last_before(log, ["key", "header", "tag"], _walk(), ["added"], limit)
    present = F.coalesce(~F.col("prev_added"), F.lit(False))
    return later.withColumn(
        "undoable", F.col("tag").isNotNull() & ((F.col("recent") == 1) | (F.col("added") == present))
    ).drop("prev_added")


def _fold(rows: DataFrame, keys: Sequence[str], carry: DataFrame | None = None) -> DataFrame:
    """Walks the changes of one group in one array, from the carried tag list on; lists come out at the asked ones."""
    event = F.struct(*[_walk_rank().alias("rank"), "tag", "added", "asked"])
    grouped = rows.groupBy(*keys).agg(F.reverse(F.sort_array(F.collect_list(event))).alias("events"))
    empty = F.array().cast("array<string>")
    if carry is not None:
        grouped = grouped.join(carry, list(keys), "left")
        start = F.coalesce(F.col("carry"), empty)
    else:
        start = empty
    rank_type = rows.select(_walk_rank().alias("rank")).schema["rank"].dataType.simpleString()
    done = F.array().cast(f"array<struct<rank:{rank_type},held:array<string>>>")

    def undo(state: Column, change: Column) -> Column:
        held = F.when(change["added"], F.array_remove(state["held"], change["tag"])).otherwise(
            F.array_append(state["held"], change["tag"])
        )
        step = F.array(F.struct(change["rank"].alias("rank"), held.alias("held")))
        return F.struct(held.alias("held"), F.when(change["asked"], F.concat(state["done"], step)).otherwise(state["done"]).alias("done"))

    steps = F.aggregate("events", F.struct(start.alias("held"), done.alias("done")), undo, lambda s: s["done"])
    return grouped.select(*keys, F.inline(steps))


def _pieces(chunks: DataFrame, rows: int) -> DataFrame:
    """Cuts the ordered chunks of each group into pieces of at most `rows`; adds `piece`, counting up along the walk."""
    keys = ["key", "header", "chunk"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*_walk()))
    used = chunks.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / rows).alias("used"))
    earlier = Window.partitionBy("key", "header").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = used.select(*keys, F.coalesce(F.sum("used").over(earlier), F.lit(0)).alias("offset"))
    placed = chunks.withColumn("place", place).join(offsets, keys)
    return placed.withColumn("piece", F.col("offset") + F.floor((F.col("place") - 1) / rows)).drop("place", "offset", "chunk")


def tag_spans(pieces: DataFrame) -> DataFrame:
    """One row per tag and piece that leaves it held: key, header, tag, rank (when it came) and the pieces [first, until) it is held at the start of.

    Rows are in proportion to the changes, however many pieces a tag is held through.
    """
    group = ["key", "header"]
    last = pieces.groupBy(*group, "tag", "piece").agg(F.min(F.struct(_walk_rank().alias("rank"), "added")).alias("last"))
    following = F.lead("piece").over(Window.partitionBy(*group, "tag").orderBy("piece"))
    until = F.coalesce(F.col("following") + 1, F.lit(2**62))
    spans = last.withColumn("following", following).filter(~F.col("last.added"))
    return spans.select(*group, "tag", F.col("last.rank").alias("rank"), (F.col("piece") + 1).cast("long").alias("first"), until.cast("long").alias("until"))


#: Places of a block of the next level, and levels (an end beyond all places is cut at the group's last one).
BLOCK_PLACES = 16
BLOCK_LEVELS = 15


def span_blocks(first: Column, until: Column) -> Column:
    """The fewest aligned blocks (level, block) that make up the places [first, until); a block of a level has 16 of the level below."""

    def edge(level: Column) -> Column:
        size = F.pow(F.lit(BLOCK_PLACES), level).cast("long")
        low, high = F.ceil(first / size), F.floor(until / size)
        next_low, next_high = F.ceil(first / (size * BLOCK_PLACES)), F.floor(until / (size * BLOCK_PLACES))
        inner = next_low < next_high
        left = _places(low, F.when(inner, next_low * BLOCK_PLACES).otherwise(high))
        right = F.when(inner, _places(next_high * BLOCK_PLACES, high)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.concat(left, right), lambda block: F.struct(level.cast("int").alias("level"), block.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1)), edge))


def _places(low: Column, high: Column) -> Column:
    return F.when(low < high, F.sequence(low.cast("long"), high.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))


def place_blocks(place: Column) -> Column:
    """The block of each level that holds a place."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_LEVELS - 1)),
        lambda level: F.struct(level.cast("int").alias("level"), F.floor(place / F.pow(F.lit(BLOCK_PLACES), level).cast("long")).cast("long").alias("block")),
    )


def held_at(spans: DataFrame, wanted: DataFrame) -> DataFrame:
    """The tag list at the start of each wanted piece (key, header, piece), in the order the tags came.

    Spans meet pieces in aligned blocks, so only what is held at a wanted piece
    becomes a row; a span through any number of other pieces costs a few.
    """
    group = ["key", "header"]
    ends = wanted.groupBy(*group).agg(F.max("piece").alias("last_piece"))
    cut = lookup_join(spans, ends, group, "inner").withColumn("until", F.least("until", F.col("last_piece") + 1)).filter("first < until")
    parts = cut.select(*group, "tag", "rank", F.inline(span_blocks(F.col("first"), F.col("until"))))
    points = wanted.select(*group, "piece", F.inline(place_blocks(F.col("piece"))))
    held = parts.join(points, [*group, "level", "block"])
    in_order = F.reverse(F.sort_array(F.collect_list(F.struct("rank", "tag"))))
    return held.groupBy(*group, "piece").agg(F.transform(in_order, lambda x: x["tag"]).alias("carry"))


def replay_list(
    current: DataFrame, changes: DataFrame, limit: int = HOT_ROWS, list_rows: int = LIST_ROWS, asked: Column | None = None
) -> DataFrame:
    """Joined tags in force before each undoable list change, or before those for which `asked` holds.

    Removed tags come back at the end of the list. Groups above `list_rows` are
    cut into ordered pieces; those with an asked change are folded, each from the
    tags held at its start. `asked` reads key, header, changed_at, history_id and
    item_ord. Groups are measured on the change rows as given, before any other
    work on them.
    """
    group = ["key", "header"]
    hot = hot_groups(changes, group, min(limit, list_rows))
    steps = list_effects(current, changes, None if hot is None else limit).filter("undoable").drop("undoable")
    wanted = F.col("recent") == 0
    steps = steps.withColumn("asked", wanted if asked is None else wanted & F.coalesce(asked, F.lit(False)))
    if hot is None:
        rows = _fold(steps, group)
    else:
        hot_rows, cold_rows = split_hot(materialize(steps), group, hot)
        pieces = _pieces(range_chunks(hot_rows, [F.col("key"), F.col("header"), *_walk()], hot.rows, limit), list_rows)
        read = pieces.filter("asked").select(*group, "piece").distinct()
        used = pieces if asked is None else pieces.join(read, [*group, "piece"], "left_semi")
        hot_folded = _fold(used, [*group, "piece"], held_at(tag_spans(pieces), read)).drop("piece")
        rows = _fold(cold_rows, group).unionByName(hot_folded)
    return rows.select(
        "key", "header", "rank.changed_at", "rank.history_id", (-F.col("rank.item_back")).alias("item_ord"),
        blank_as_null(F.array_join("held", SEPARATOR)).alias("before"),
    )


def on_or_after(day: str) -> Column:
    """Changes that a state of this day or later can need the list of."""
    return F.col("changed_at").cast("date") >= F.lit(day).cast("date")


def unresolved(changes: DataFrame, effects: DataFrame | None, known: Sequence[str]) -> DataFrame:
    """Fields whose changes could not be used, with the reason, sorted.

    `changes` needs `field`; `effects` are list changes with `undoable`.
    """
    unknown = changes.filter(~F.col("field").isin(list(known))).select("field", F.lit("unknown field").alias("reason"))
    if effects is not None:
        stuck = effects.filter((F.col("recent") == 0) & ~F.col("undoable"))
        unknown = unknown.unionByName(stuck.select(F.col("header").alias("field"), F.lit("not undoable").alias("reason")))
    return unknown.groupBy("field", "reason").agg(F.count(F.lit(1)).alias("n")).orderBy("field", "reason")


def states(
    current: DataFrame, changes: DataFrame, fields: Sequence[str], times: DataFrame | None = None,
    min_valid_from: str | None = None, require_history: bool = False, creation: bool = True, limit: int = HOT_ROWS,
    sizes: DataFrame | None = None, changing: Sequence[str] | None = None,
) -> DataFrame:
    """State of every ticket after each change and, with `creation`, at its creation.

    `current(key, created, <fields>)`; `changes(key, changed_at, history_id,
    item_ord, header, before)` holds scalar before-values and replayed lists;
    `times(key, changed_at)` adds change times without a catalogued field.
    With `min_valid_from` older states are not built; the newest always is.
    `sizes` is any cheap table with at least as many rows per key as there are
    change times (such as the raw change items); keys are measured on it.
    `changing` are the fields that `changes` can name, if the caller knows them:
    the others are carried along as one value, the current ticket's.
    """
    types = dict(current.dtypes)
    moved = [f for f in fields if changing is None or f in changing]
    still = [f for f in fields if f not in moved]
    measured = sizes if sizes is not None else (
        changes.select("key") if times is None else changes.select("key").unionAll(times.select("key")))
    fill_limit = limit if largest_group(measured, ["key"]) + 2 > limit else None
    touched = changes.select("key", "changed_at", "history_id", "item_ord", "header", "before")
    bare = [F.lit(None).cast("long").alias("history_id"), F.lit(None).cast("int").alias("item_ord"),
            F.lit(None).cast("string").alias("header"), F.lit(None).cast("string").alias("before")]
    if times is not None:
        touched = touched.unionByName(times.select("key", "changed_at", *bare))
    births = current.select("key", F.col("created").alias("changed_at"), *bare).filter(F.lit(creation))
    touched, births = with_moment(touched), with_moment(births)
    if require_history:
        births = births.join(touched.select("key").distinct(), "key", "left_semi")
    if min_valid_from is not None:
        newest = touched.groupBy("key").agg(F.max(F.struct("moment", "changed_at")).alias("newest"))
        newest = newest.select("key", "newest.changed_at", *bare, "newest.moment")
        touched = touched.filter(on_or_after(min_valid_from)).unionByName(newest)
        births = births.filter(on_or_after(min_valid_from))
    # several changes at one time: the one undone last holds the value before all of them
    undone_last = F.struct("history_id", (-F.col("item_ord")).alias("item_back"))
    rows = touched.unionByName(births)
    if fill_limit is None:
        # no hot key: one shuffle by key serves the states of a time and the fill along the key
        rows, current = rows.repartition("key"), current.repartition("key")
    per_time = rows.groupBy("key", "moment", F.when(F.col("moment").isNull(), F.col("changed_at")).alias("at")).agg(
        F.max("changed_at").alias("changed_at"),
        *[
            F.min(F.when(F.col("header") == f, F.struct(undone_last.alias("rank"), F.col("before").try_cast(types[f]).alias("v")))).alias(f)
            for f in moved
        ]
    )
    as_now = F.struct(*[q(f) for f in still])
    carried = [*moved, *([STILL] if still else [])]
    before = per_time.select(
        "key", "changed_at", "moment", F.lit(0).alias("recent"), *[_wrapped(q(f)["v"], q(f).isNotNull()).alias(f) for f in moved],
        *[F.lit(None).cast(current.select(as_now.alias(c)).schema[c].dataType).alias(c) for c in carried[len(moved):]],
    )
    now = current.select(
        "key", F.lit(None).cast(before.schema["changed_at"].dataType).alias("changed_at"),
        F.lit(None).cast("timestamp").alias("moment"), F.lit(1).alias("recent"),
        *[_wrapped(q(f), F.lit(True)).alias(f) for f in moved], *[as_now.alias(c) for c in carried[len(moved):]],
    )
    order = [F.col("recent").desc(), F.col("moment").desc(), F.col("changed_at").desc()]
    log = now.unionByName(before)
    # with a hot key the log is read several times, so it is built once
    filled = last_before(log if fill_limit is None else materialize(log), ["key"], order, carried, fill_limit)
    found = {f: q(f"prev_{f}")["v"] if f in moved else q(f"prev_{STILL}")[f] for f in fields}
    return filled.filter(F.col("recent") == 0).select(
        "key", F.col("changed_at").alias("valid_from"), *[_clean(found[f], types[f]).alias(f) for f in fields]
    )


def _wrapped(value: Column, there: Column) -> Column:
    """A value in a struct, so that a null value differs from no value."""
    return F.when(there, F.struct(value.alias("v")))


def _clean(value: Column, kind: str) -> Column:
    return blank_as_null(value) if kind == "string" else value


def replay_scalar(current: DataFrame, changes: DataFrame, fields: Sequence[str], limit: int = HOT_ROWS) -> DataFrame:
    """States after each change, from scalar changes alone."""
    return states(current, changes, fields, creation=False, limit=limit)


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[blank_as_null(q(c)).alias(c) if t == "string" else q(c) for c, t in df.dtypes])


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """The pair in either order as one (low, high) pair; null counts as blank."""
    left, right = F.coalesce(q(a), F.lit("")), F.coalesce(q(b), F.lit(""))
    return df.withColumns({"low": F.least(left, right), "high": F.greatest(left, right)})


def _listed(known: DataFrame) -> DataFrame:
    return _pairs(known, "var1", "var2").select("low", "high").distinct()


def equivalent(df: DataFrame, a: str, b: str, known: DataFrame, limit: int = HOT_ROWS) -> DataFrame:
    """Adds `match`: equal, empty, listed (in either order) or new. All four are accepted."""
    found = lookup_join(_pairs(df, a, b), _listed(known).withColumn("listed", F.lit(True)), ["low", "high"], limit=limit)
    match = (
        F.when(q(a).eqNullSafe(q(b)), "equal").when(F.col("high") == "", "empty")
        .when(F.col("listed"), "listed").otherwise("new")
    )
    return found.withColumn("match", match).drop("low", "high", "listed")


def new_equivalences(df: DataFrame, a: str, b: str, known: DataFrame) -> DataFrame:
    """Unequal pairs that are listed in neither order, once each, to be appended to the list."""
    seen = _pairs(df, a, b).filter("low <> high").groupBy("low", "high").agg(
        F.min(F.struct(q(a).alias("var1"), q(b).alias("var2"))).alias("pair")
    )
    return seen.join(_listed(known), ["low", "high"], "left_anti").select("pair.var1", "pair.var2")
