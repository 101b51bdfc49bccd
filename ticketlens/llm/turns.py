"""Repair of damaged conversations as one integer minimum over a graph of edits.

The rows of a conversation in order, and what has been put out so far (nothing, a
system turn, a user's turn, an assistant's turn), are the nodes of an acyclic
graph; keeping, re-roling or deleting a row and inserting a turn are its edges.
The weight of a path is one integer in base `BASE`: its high digits are the cost,
below them stand the letters of its edits in fixed places, the first one highest,
with zeros behind the last. So the smallest integer is the cheapest repair and,
of equally cheap ones, the one whose letters come first in ASCII, a shorter one
before its continuations. The minimum is worked out from the last row back to the
first; a letter in front moves the others down a place.

From a node no two edges have the same letter, so the first letters settle every
tie and digits beyond any width change no decision. A conversation of at most
`SPAN` rows is one integer per node. A longer one is cut into spans: the digits
reach over one span, the integers at the borders are kept, and the letters are
read off span by span; the work grows with the rows, not with their square.

Conversations are dealt out by id and sorted, and stream through their task: the
first pass carries no texts (an initial and a fault a row) and gives the letters,
the second one brings texts and letters together and hashes as it goes. Which
rows repeat an earlier one is found by an aggregate over digests of role and
text. So no conversation's texts are held at once; its letters are one value.

Defined cases: a null role or text is one space, so is a null conv_id or turn in
the text that decides the damage; a null turn comes first, a null conv_id is a
conversation of its own. Rows of equal turn are
ordered by role, then by the SHA-256 of their text. A role
counts by its first character; the empty role has none and fits nowhere. An empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ticketlens.llm.storage import stored

# Letters of the edits in ASCII order, their costs, what an unmended truncated row adds
LETTERS = "DIKR"
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED_COST = 3

BASE = len(LETTERS) + 1
CODE = {letter: i + 1 for i, letter in enumerate(LETTERS)}
#: Rows whose letters one integer holds.
SPAN = 256

# what has been put out: nothing, a system turn, a user's turn, an assistant's turn
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
#: State after a turn with this initial, for each state that may stand before it.
AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The turn that may be inserted, or a row re-roled to.
NEXT = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLES = {"u": "user", "a": "assistant"}

SPACES = "\\x20\\x09-\\x0D"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the rows that are left, changed as their crc32 says; a repeated row stands twice."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    part = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("part") == 4, "user").otherwise(F.col("role"))
    found = rows.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), part.alias("part")).filter("part <> 0")
    times = F.when(F.col("part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return found.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


# a row's first fault; of rows that repeat an earlier one the first in its place is still to be told
FINE, BLANK, DUPLICATE, TRUNCATED, FIRST, FIRST_TRUNCATED = range(6)


def placed(rows: DataFrame) -> DataFrame:
    """The rows, null roles and texts as one space, with `digest`, that of the text: order is by turn, role and digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role, text).withColumn("digest", F.sha2("text", 256))


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest and fault (blank, duplicate, truncated or fine) of the placed rows; no texts.

    The smallest turn of each role and digest is an aggregate, so a text that very
    many rows share is combined before it is dealt out. Rows at that turn may be
    several equal ones; they are FIRST, and whoever reads them in order takes the
    first for itself and the others for duplicates.
    """
    blank = ~F.col("text").rlike(f"[^{SPACES}]")
    cut = ~F.col("text").rlike(f"[.!?][{SPACES}]*\\z")
    seen = rows.select("conv_id", "turn", "role", "digest", blank.alias("blank"), cut.alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    first = seen.filter(~F.col("blank")).groupBy(F.col("conv_id").alias("of"), F.col("role").alias("as"), F.col("digest").alias("known")).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("as")) & (F.col("digest") == F.col("known"))
    joined = seen.join(first, same, "left")
    repeats = F.col("first").isNotNull()
    fault = (
        F.when(F.col("blank"), BLANK).when(repeats & ~place.eqNullSafe(F.col("first")), DUPLICATE)
        .when(repeats & F.col("cut"), FIRST_TRUNCATED).when(repeats, FIRST).when(F.col("cut"), TRUNCATED).otherwise(FINE)
    )
    return joined.select("conv_id", "turn", "role", "digest", fault.alias("fault"))


@dataclass
class Weights:
    """Integers with the cost in the high digits and letters in `width` places below."""

    width: int
    unit: int = field(init=False)
    top: int = field(init=False)

    def __post_init__(self) -> None:
        self.unit = BASE**self.width
        self.top = BASE ** (self.width - 1)

    def front(self, letter: str, weight: int, more: int = 0) -> int:
        """The weight with a letter in front and the cost of its edit."""
        cost, letters = divmod(weight, self.unit)
        return (cost + COSTS[letter] + more) * self.unit + CODE[letter] * self.top + letters // BASE

    def letters(self, weight: int) -> Iterator[str]:
        digits = weight % self.unit
        place = self.top
        while place and (digit := digits // place % BASE):
            yield LETTERS[digit - 1]
            place //= BASE


def step(weights: Weights, initial: str, fault: int, after: list[int | None]) -> list[int | None]:
    """The least weights from before a row on, given those from behind it on; None where no repair is possible."""
    out: list[int | None] = []
    must_go = fault in (BLANK, DUPLICATE)
    more = TRUNCATED_COST if fault == TRUNCATED else 0
    taken: list[int | None] = []
    for state in STATES:
        ways = [("D", state, 0)]
        if not must_go:
            if (state, initial) in AFTER:
                ways.append(("K", AFTER[state, initial], more))
            ways.append(("R", AFTER[state, NEXT[state]], more))
        taken.append(min((weights.front(letter, after[to], m) for letter, to, m in ways if after[to] is not None), default=None))
    for state in STATES:  # a turn inserted in front; two of them only ever add to the cost
        inserted = taken[AFTER[state, NEXT[state]]]
        ways = [taken[state]] + ([] if inserted is None else [weights.front("I", inserted)])
        out.append(min((w for w in ways if w is not None), default=None))
    return out


def ending(weights: Weights) -> list[int | None]:
    """The least weights behind the last row: whole as it is, or after an inserted answer."""
    return [0, None, weights.front("I", 0), 0]


def cheapest(initials: Sequence[str], faults: Sequence[int], span: int = SPAN) -> tuple[int, str]:
    """Cost and letters of the cheapest repair."""
    n = len(initials)
    weights = Weights(2 * min(n, span) + 2)
    now = ending(weights)
    borders = {n: now}
    for i in range(n - 1, -1, -1):
        now = step(weights, initials[i], faults[i], now)
        if i % span == 0:
            borders[i] = now
    out: list[str] = []
    row, state = 0, NOTHING
    while True:
        last = min(row + span, n)
        for letter in weights.letters(borders[row][state]):
            out.append(letter)
            state = moved(state, letter, initials[row] if letter != "I" else "")
            row += letter != "I"
            if row == last < n:
                break
        if row == n:
            return borders[0][NOTHING] // weights.unit, "".join(out)


def moved(state: int, letter: str, initial: str) -> int:
    """The state after an edit."""
    return state if letter == "D" else AFTER[state, initial if letter == "K" else NEXT[state]]


class Conversation:
    """What the first pass keeps of a conversation: an initial and a fault a row, and counts."""

    def __init__(self, conv_id: object):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults = bytearray()
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, digest: str, fault: int) -> None:
        initial = role[:1]
        if self.initials and self.initials[-1] + initial not in ("su", "ua", "au"):
            self.illegal += 1
        if fault in (FIRST, FIRST_TRUNCATED):
            again = self.last == (turn, role, digest)
            fault = DUPLICATE if again else TRUNCATED if fault == FIRST_TRUNCATED else FINE
        if turn is not None and (self.high is None or turn != self.high):
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.last = (turn, role, digest)
        self.initials.append(sys.intern(initial))
        self.faults.append(fault)

    def figures(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = cheapest(self.initials, self.faults)
        counts = [self.faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        return (self.conv_id, gaps if gaps < 1 << 63 else None, *counts, self.illegal, cost, audit)


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation of the placed rows, and of `ids`."""
    kind, id_type = _id_types(rows)
    every = (rows if ids is None else ids).select("conv_id").distinct()
    head = every.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("fault", "int"))])
    body = judged(rows).select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "digest", "fault")
    names = ["conv_id", *FIGURES]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended() -> Iterator[tuple]:
            now = None
            for batch in batches:
                for conv, head, turn, role, digest, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if head == 0:
                        if now is not None:
                            yield now.figures()
                        now = Conversation(conv)
                    else:
                        now.add(turn, role, digest, fault)
            if now is not None:
                yield now.figures()

        yield from _batches(ended(), names, (id_type, *FIGURE_TYPES))

    ordered = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return ordered.mapInArrow(walk, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
FIGURE_TYPES = (*[pa.int64()] * 6, pa.string())


def _id_types(rows: DataFrame) -> tuple[str, pa.DataType]:
    """The type of conv_id, for Spark and for Arrow."""
    kind = rows.schema["conv_id"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _batches(rows: Iterator[tuple], names: Sequence[str], types: Sequence, most: int = 4096, most_chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The rows as Arrow batches of limited size."""
    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], list(names))

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or chars >= most_chars:
            yield batch(held)
            held, chars = [], 0
    if held:
        yield batch(held)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of sorted rows with the letters in front: the head of each conversation, then its repaired turns (None, place, role, text, letter)."""
    letters, at, state, place, initial = "", 0, NOTHING, 0, ""

    def inserted() -> Iterator[tuple]:
        nonlocal at, state, place
        while at < len(letters) and letters[at] == "I":
            role = ROLES[NEXT[state]]
            state, at, place = moved(state, "I", ""), at + 1, place + 1
            yield None, place, role, "", "I"

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for values in zip(*columns, strict=True):
            conv, head, _, role, _, text, figures = values
            if head == 0:
                yield from inserted()
                letters, at, state, place = figures["audit"], 0, NOTHING, 0
                yield conv, figures
                continue
            yield from inserted()
            letter, initial = letters[at], role[:1]
            if letter == "R":
                role = ROLES[NEXT[state]]
            state, at = moved(state, letter, initial), at + 1
            if letter != "D":
                place += 1
                yield None, place, role, text, letter
    yield from inserted()


def _with_letters(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Letters in front of the placed rows of each conversation, dealt out by conversation and sorted."""
    kinds = found.schema
    figures = F.struct(*[F.col(c) for c in FIGURES]).alias("figures")
    none = F.lit(None).cast("struct<" + ",".join(f"{c}:{kinds[c].dataType.simpleString()}" for c in FIGURES) + ">")
    head = found.select(
        "conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("text", "string"))], figures
    )
    body = rows.select("conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "role", "digest", "text", none.alias("figures"))
    return head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place (from 1), role, text and edit (K, R or I)."""
    rows = placed(rows)
    kind, id_type = _id_types(rows)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            conv = None
            for event in _replayed(batches):
                if len(event) == 2:
                    conv = event[0]
                else:
                    yield conv, *event[1:]

        yield from _batches(turns(), ["conv_id", "place", "role", "text", "edit"], (id_type, pa.int64(), pa.string(), pa.string(), pa.string()))

    return _with_letters(rows, stored(audits(rows))).mapInArrow(walk, f"conv_id {kind}, place long, role string, text string, edit string")


def report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The figures of each conversation (of `ids`, if given) with repaired_sha256, that of its repaired `role:text`, joined by newlines."""
    rows = placed(rows)
    kind, id_type = _id_types(rows)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended() -> Iterator[tuple]:
            head, digest = None, None
            for event in _replayed(batches):
                if len(event) == 2:
                    if head:
                        yield *head, digest.hexdigest()
                    head, digest = (event[0], *[event[1][c] for c in FIGURES]), hashlib.sha256()
                else:
                    _, place, role, text, _ = event
                    digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
            if head:
                yield *head, digest.hexdigest()

        yield from _batches(ended(), ["conv_id", *FIGURES, "repaired_sha256"], (id_type, *FIGURE_TYPES, pa.string()))

    schema = f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _with_letters(rows, stored(audits(rows, ids))).mapInArrow(walk, schema)
