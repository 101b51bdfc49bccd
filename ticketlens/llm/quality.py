"""Quality rules by cross-document line frequency; DataFrame operations only.

Lines are normalised and hashed, the documents of a host that hold a line are
counted, lines above the limit are taken out of all but the first of them, and
documents that are left with too little are rejected.

Defined cases: a null or empty text has no words and no lines, so all its
figures are 0 and it fails the base rule. A null host is a host of its own. Rows
that repeat a document's text, host and id all get that document's figures; for
the line rule rows with one id are one document, rows without an id one per text.
Columns other than the three named ones are not read and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.storage import small, stored

#: White space as the rules understand it: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Symbols that are counted.
SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8


@dataclass(frozen=True)
class Limits:
    """Few words or much repetition fail the base rule; the rest is the line rule.

    A line is above the limit if more than `line_docs` documents of the host and
    more than `line_share` of them hold it. A document is depleted if less than
    `left_share` of its words are left.
    """

    min_words: int = 20
    repeat_percent: int = 30
    line_docs: int = 20
    line_share: float = 0.05
    left_share: float = 1 / 3


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def every_line(text: Column) -> Column:
    """All lines in lower case, runs of white space as one blank, numbers as 0: counters and dates do not make
    lines differ. The whole text is normalised at once, its line ends apart."""
    bare = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    lines = F.split(F.regexp_replace(bare, r"[\x20\x09\x0B-\x0D]+", " "), "\n")
    return F.transform(lines, lambda x: F.trim(x))


def normalised_lines(text: Column) -> Column:
    """Those of them that hold a word."""
    return F.filter(every_line(text), lambda x: x != "")


def base_figures(docs: DataFrame, doc_id: str, text: str, host: str, limits: Limits = Limits()) -> DataFrame:
    """One row per document: counts over its own words and lines, and whether the base rule fails it.

    Written once, so that a filter on any of them reads numbers and is not pushed into the steps that count them.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), whole.alias("text"),
        row_key(F.col(doc_id), F.col(host), whole).alias("row_key"),
    )
    split = own.select("*", word_array(F.col("text")).alias("words"))
    counted = split.select(
        "doc_id", "host", "row_key",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_SPACE)).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # a window can come back only if there are two
    last = F.size("hashes") - (WINDOW_WORDS - 1)
    windows = F.when(
        last >= 2,
        F.transform(
            F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW_WORDS))
        ),
    )
    windowed = counted.select(
        "doc_id", "host", "row_key", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # only the few texts in which a window comes back are sorted
    repeated = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    sorted_windows = windowed.select("*", repeated.alias("sorted")).drop("windows")
    same = lambda a, b: F.coalesce(F.get("sorted", a)["h"] == F.get("sorted", b)["h"], F.lit(False))
    places = F.transform(
        F.filter(
            F.transform(
                "sorted", lambda x, k: F.struct(x["i"].alias("i"), (same(k, k - 1) | same(k, k + 1)).alias("again"))
            ),
            lambda x: x["again"],
        ),
        lambda x: x["i"],
    )
    placed = sorted_windows.select("*", F.array_sort(places).alias("places")).drop("sorted")
    covered = F.aggregate(
        F.transform(
            "places",
            lambda p, k: F.when(k == 0, F.lit(WINDOW_WORDS)).otherwise(
                F.least(F.lit(WINDOW_WORDS), p - F.get("places", k - 1))
            ),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    figures = placed.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("places")
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )
    return stored(figures.select("*", failed.alias("base_failed")))


def row_key(*columns: Column) -> Column:
    """Rows with equal values share it; a document's own key even where ids repeat."""
    return F.xxhash64(*columns)


def host_lines(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row per line with a word: row_key, host, line (a hash), and whether it is the document's first such."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), row_key(F.col(doc_id), F.col(host), whole).alias("row_key"),
        normalised_lines(whole).alias("lines"),
    )
    hashed = F.array_sort(F.transform("lines", lambda x: F.xxhash64(x)))
    ordered = lines.select("doc_id", "host", "row_key", hashed.alias("lines"))
    marked = F.transform(
        "lines",
        lambda x, k: F.struct(
            x.alias("line"), F.coalesce(x != F.get("lines", k - 1), F.lit(True)).alias("first")
        ),
    )
    return ordered.select("doc_id", "host", "row_key", F.inline(marked))


def _document() -> list[Column]:
    """What tells documents apart: the id, of rows without one their key."""
    return [F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("row_key")).alias("no_id")]


def held_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """host, line, doc_id and row_key of the lines in more rows than documents may hold; written once.

    Rows are counted first, combined before the shuffle, so a line of a third of all
    rows is one row per task; only the lines that many rows hold are looked at again.
    """
    many = lines.groupBy("host", "line").agg(F.sum(F.col("first").cast("long")).alias("rows")).filter(F.col("rows") > limits.line_docs)
    many = many.select(F.col("host").alias("many_host"), F.col("line").alias("many_line"))
    same = (F.col("line") == F.col("many_line")) & F.col("host").eqNullSafe(F.col("many_host"))
    # these lines are few, their occurrences may be many: Spark splits a hot line in this join
    return stored(lines.filter("first").join(many, same).select("host", "line", "doc_id", "row_key"))


def frequent_lines(held: DataFrame, docs: DataFrame, doc_id: str, text: str, host: str, limits: Limits) -> DataFrame:
    """host, line and the first document of the lines that too many distinct documents of a host hold."""
    counts = held.select("host", "line", *_document()).distinct().groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc")
    ).filter(F.col("docs") > limits.line_docs)
    key = row_key(F.col(doc_id), F.col(host), F.coalesce(F.col(text), F.lit("")))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("size_host"), F.when(F.col(doc_id).isNull(), key).alias("row_key"))
    sizes = own.select("size_host", *_document()).distinct().groupBy("size_host").agg(F.count(F.lit(1)).alias("host_docs"))
    return (
        counts.join(sizes, F.col("host").eqNullSafe(F.col("size_host")))
        .filter(F.col("docs") > limits.line_share * F.col("host_docs"))
        .select(F.col("host").alias("frequent_host"), F.col("line").alias("frequent_line"), "first_doc")
    )


def removed_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """removed_key, removed_doc and gone (hashes of lines) of each document with lines above the limit that are not its own to keep."""
    lines = host_lines(docs, doc_id, text, host)
    every = held_lines(lines, limits)
    held = every.join(
        frequent_lines(every, docs, doc_id, text, host, limits),
        (F.col("line") == F.col("frequent_line")) & F.col("host").eqNullSafe(F.col("frequent_host")),
    ).filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    # at most the distinct lines of one document
    return stored(
        held.groupBy(F.col("row_key").alias("removed_key"), F.col("doc_id").alias("removed_doc")).agg(F.collect_set("line").alias("gone"))
    )


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines of these hashes; all others stay as they are."""
    normal = every_line(text)
    left = F.filter(
        F.arrays_zip(F.split(text, "\n").alias("raw"), normal.alias("normal")),
        lambda x: ~F.array_contains(gone, F.xxhash64(x["normal"])),
    )
    return F.array_join(F.transform(left, lambda x: x["raw"]), "\n")


def cleaned(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits(),
    removed: DataFrame | None = None,
) -> DataFrame:
    """The same rows and columns, `text` without the lines above the limit; lengths in other columns stay those of the whole text."""
    removed = removed_lines(docs, doc_id, text, host, limits) if removed is None else removed
    gone = removed.select(F.col("removed_key").alias("__key"), F.col("removed_doc").alias("__doc"), F.col("gone").alias("__gone"))
    key = row_key(F.col(doc_id), F.col(host), F.coalesce(F.col(text), F.lit("")))
    joined = docs.withColumn("__row_key", key).join(
        small(gone), (F.col("__row_key") == F.col("__key")) & F.col(doc_id).eqNullSafe(F.col("__doc")), "left"
    )
    left = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(without_lines(F.col(text), F.col("__gone")))
    return joined.withColumn(text, left).select(*docs.columns)


def verdicts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits(),
    removed: DataFrame | None = None,
) -> DataFrame:
    """Base figures, words less in the cleaned text, `kept` (neither failed by the base rule nor depleted) and row_key for each row."""
    removed = removed_lines(docs, doc_id, text, host, limits) if removed is None else removed
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), row_key(F.col(doc_id), F.col(host), whole).alias("row_key"), whole.alias("text"))
    same = (F.col("row_key") == F.col("removed_key")) & F.col("doc_id").eqNullSafe(F.col("removed_doc"))
    fewer = F.size(word_array(F.col("text"))) - F.size(word_array(without_lines(F.col("text"), F.col("gone"))))
    # rows that repeat a document lose the same words
    words = own.join(small(removed), same).groupBy("removed_key", "removed_doc").agg(F.max(fewer).alias("n_removed_words"))
    joined = base_figures(docs, doc_id, text, host, limits).join(words, same, "left")
    gone = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    depleted = (F.col("n_words") - gone) < limits.left_share * F.col("n_words")
    return joined.select(
        "doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        gone.alias("n_removed_words"), (~F.col("base_failed") & ~depleted).alias("kept"),
    )
