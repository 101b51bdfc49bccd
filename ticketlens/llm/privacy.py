"""Personal data: patterns, and a skip-chain conditional random field for what the patterns miss.

The patterns find e-mail addresses, IP addresses, card and phone numbers. The field
labels the words that hold a digit or an `@`; all other words have no label. It is
fitted on the patterns' own finds in a bounded sample of texts. To each of them the
same entities are added once more in a form that the patterns miss, with their
labels, and those of another text in such a form, without: so the field learns that
a similar occurrence elsewhere in the text decides, not the form. Its spans are
added where they touch no span of the patterns; those all stay.

Similar are words with the same digits at their end (seven), the same name in front
of an `@`, or the same letters and digits. A text's words are taken whole, at any
length; a task holds the words with digits of some texts, or of one long text.

Defined cases: a null text is empty and has no spans. Rows that repeat come out as
often. Without any word to learn from the field adds nothing. Other columns are not
looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ticketlens.llm.crf import FEATURES, Field, Tokens

KINDS = ("email", "ip", "card", "phone")

# What the patterns take
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, LARGEST_PART = (13, 19), (9, 15), 255

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_ACTIVE = re.compile("[0-9@]")
_GAP = re.compile("[\x20\x09-\x0d]+")
_DIGITS = re.compile("[^0-9]+")
_FIRST, _LAST = re.compile(r"[A-Za-z0-9+(]"), re.compile(r"[A-Za-z0-9)]")

#: Texts and characters of a text that the field may be fitted on.
SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 20_000
#: Tokens that are labelled at once; a text with more is labelled by itself.
MOST_TOKENS = 20_000

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, last, at = 0, -1, text.find("@")
    while at >= 0:
        low = max(done, last + 1)
        start = low + len(text[low:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        last, at = at, text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points by kind, then start; in time that grows with the text."""
    out = [(0, *s) for s in _emails(text)] if "@" in text else []
    if not _has_digit(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= LARGEST_PART for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_DIGITS.sub("", m.group())) <= PHONE_DIGITS[1]:
                out.append((3, *m.span()))
    return out


_DIGIT = re.compile("[0-9]")


def _has_digit(text: str) -> bool:
    return _DIGIT.search(text) is not None


def words(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the words that hold a digit or an `@`."""
    end = 0
    found = _ACTIVE.search(text)
    while found:
        start = found.start()
        while start > end and text[start - 1] not in SPACE:
            start -= 1
        stop = _GAP.search(text, found.end())
        end = stop.start() if stop else len(text)
        yield start, end
        found = _ACTIVE.search(text, end)


def core(word: str) -> tuple[int, int]:
    """Where a word begins and ends without the marks around it."""
    first = _FIRST.search(word)
    if not first:
        return 0, len(word)
    end = len(word)
    while end > first.start() + 1 and not _LAST.match(word, end - 1):
        end -= 1
    return first.start(), end


def similar(word: str) -> str | None:
    """What similar words have in common."""
    if "@" in word:
        name = word.partition("@")[0].lower()
        return "@" + name if name else None
    digits = _DIGITS.sub("", word)
    if len(digits) >= 7:
        return digits[-7:]
    plain = "".join(c for c in word.lower() if c.isalnum())
    return plain if len(plain) >= 4 else None


_SHAPES = [(re.compile("[0-9]+"), "9"), (re.compile("[a-z]+"), "a"), (re.compile("[A-Z]+"), "A"), (re.compile(r"[^\x00-\x7f]+"), "u")]


def _shape(word: str) -> str:
    for pattern, sign in _SHAPES:
        word = pattern.sub(sign, word)
    return word


def features(word: str) -> list[int]:
    """Hashed features: form, numbers of digits and dots, signs, check digit."""
    digits = _DIGITS.sub("", word)
    checked = CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    n = min(len(digits), 20)
    said = (f"s{_shape(word)}", f"d{n}", f"p{word.count('.')}{'@' in word}{word[:1] == '+'}", f"l{checked}", f"d{n}l{checked}")
    return [zlib.crc32(x.encode()) % FEATURES for x in said]


class Labelled:
    """The words of one text with their features; `labels` are those of the given spans."""

    def __init__(self, text: str, spans: Sequence[Span]):
        self.at: list[tuple[int, int]] = []
        self.follows: list[bool] = []
        self.groups: list[str | None] = []
        self.features: list[list[int]] = []
        self.base: list[bool] = []
        self.labels: list[int] = []
        ordered = sorted(spans, key=lambda s: s[1])
        found = list(words(text))
        next_span, open_spans, used = 0, [], set()
        for i, (start, end) in enumerate(found):
            word = text[start:end]
            a, b = core(word)
            low, word = start + a, word[a:b]
            gap = _GAP.match(text, found[i - 1][1]) if i else None
            self.follows.append(bool(gap) and gap.end() == start)
            self.at.append((low, low + len(word)))
            self.groups.append(similar(word))
            self.features.append(features(word))
            while next_span < len(ordered) and ordered[next_span][1] < end:
                open_spans.append(ordered[next_span])
                next_span += 1
            open_spans = [s for s in open_spans if s[2] > start]
            own = min(open_spans, default=None)
            self.base.append(own is not None)
            self.labels.append(0 if own is None else 2 * own[0] + (2 if own in used else 1))
            used.add(own)


def another_form(kind: int, found: str) -> str:
    """The entity as a text might write it again, in a form that no pattern takes."""
    if kind == 0:
        name, _, domain = found.partition("@")
        return f"{name}@{domain.partition('.')[0]}"
    if kind == 1:
        return found.replace(".", "-")
    if kind == 2:
        return found.replace(" ", ".").replace("-", ".") if not found.isdigit() else ".".join(re.findall("..?.?.?", found))
    rest = (found.partition(" ")[2] or found[2:]).strip()
    last = rest.rpartition(" ")[2]
    return last if len(_DIGITS.sub("", last)) >= 7 and zlib.crc32(found.encode()) % 2 else rest


def lesson(text: str, other: str = "") -> Labelled:
    """The words of a text with the patterns' labels; its entities in another form, labelled, and those of the other text, not."""
    spans = base_spans(text)
    known = {similar(text[a:b]) for _, a, b in spans}
    pieces, marked, at = [text], list(spans), len(text)
    for source, found in ((text, spans), (other, base_spans(other))):
        for kind, start, end in found:
            form = another_form(kind, source[start:end])
            if source is text:
                marked.append((kind, at + 3, at + 3 + len(form)))
            elif similar(source[start:end]) in known:
                continue
            pieces.append(f" . {form}")
            at += 3 + len(form)
    return Labelled("".join(pieces), marked)


def fit(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Field:
    """The field, fitted on at most `sample_rows` different texts of at most SAMPLE_CHARS characters, those with the smallest hashes.

    Texts are counted first, so that no more than about as many as are wanted leave
    their tasks; copies are combined before.
    """
    chosen = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    share = 1.25 * sample_rows / max(1, chosen.count())
    hashed = chosen.select("text", F.xxhash64("text").alias("h"))
    if share < 1:
        hashed = hashed.filter(F.col("h") < int((share - 0.5) * 2.0**64))
    rows = hashed.groupBy("h").agg(F.min("text").alias("text")).collect()  # bounded by the share
    return learned([r["text"] for r in sorted(rows, key=lambda r: r["h"])[:sample_rows]])


def learned(texts: Sequence[str]) -> Field:
    """The field fitted on lessons of the texts; each takes the entities of the text before as those of the other one."""
    with_some = [t for t in dict.fromkeys(texts) if base_spans(t)]
    others = dict(zip(with_some, [*with_some[-1:], *with_some[:-1]], strict=True))
    lessons = [lesson(t, others.get(t, "")) for t in texts]
    field = Field(len(KINDS))
    if not any(x.at for x in lessons):
        return field
    t = Tokens.gather(
        [f for x in lessons for f in x.features], [f for x in lessons for f in x.follows],
        [None if g is None else (i, g) for i, x in enumerate(lessons) for g in x.groups],
    )
    return field.fit(t, np.array([n for x in lessons for n in x.labels], dtype=np.int64))


def added(found: Labelled, labels: np.ndarray) -> list[Span]:
    """Spans of neighbouring words with the label of one kind; words in spans of the patterns have theirs already."""
    out: list[Span] = []
    last = -1
    for i, label in enumerate(labels.tolist()):
        if not label or found.base[i]:
            continue
        kind, begins = (label - 1) // 2, label % 2 == 1
        if not begins and out and last == i - 1 and found.follows[i] and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], found.at[i][1])
        else:
            out.append((kind, *found.at[i]))
        last = i
    return out


def labelled(texts: Sequence[str], field: Field) -> Iterator[tuple[list[Span], list[Span]]]:
    """The patterns' spans and all spans of each text."""
    def together(held: list[tuple[list[Span], Labelled]]) -> Iterator[tuple[list[Span], list[Span]]]:
        t = Tokens.gather(
            [f for _, x in held for f in x.features], [f for _, x in held for f in x.follows],
            [None if g is None else (i, g) for i, (_, x) in enumerate(held) for g in x.groups],
        )
        labels, at = field.labels(t), 0
        for spans, x in held:
            yield spans, sorted([*spans, *added(x, labels[at : at + len(x.at)])])
            at += len(x.at)

    held, tokens = [], 0
    for text in texts:
        spans = base_spans(text)
        found = Labelled(text, spans)
        if held and tokens + len(found.at) > MOST_TOKENS:
            yield from together(held)
            held, tokens = [], 0
        held.append((spans, found))
        tokens += len(found.at)
    yield from together(held)


def find(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base and spans: arrays of kind, start and end (code points, end exclusive) by kind, then start."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def structs(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s] for s in spans], of)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                base, every = zip(*labelled(batch.column(1).to_pylist(), field), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(to_arrow_type(kind)), structs(base), structs(every)], ["doc_id", "base", "spans"])

    span = "array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(search, f"doc_id {kind.simpleString()}, base {span}, spans {span}")
