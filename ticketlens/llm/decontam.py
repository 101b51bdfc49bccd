"""Benchmark decontamination with a positional inverted index; DataFrame operations only.

The corpus frequency of every test term is counted. Each window of a benchmark
item is looked up by its rarest terms: their postings (document and position) are
stored, moved back by their place in the window, and intersected; what both lists
agree on is a possible occurrence, and its words are compared as a whole. Where
the lists agree only up to some words the match is one of proximity. The postings of common terms are never stored, so the index stays small beside the
texts, and a passage that stands in very many documents is many rows of many
documents.

Defined cases: a null or empty text has no words and is clean; a benchmark row
without words matches nothing. Items shorter than a window are one window. Rows
that repeat a document get its figures each; item ids that repeat count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.storage import stored
from ticketlens.session import materialize, scratch_folder

WINDOW_WORDS = 10
#: Terms of a window whose postings are intersected.
RAREST = 2
#: Tables of terms or document keys (8 bytes a row) up to this size are broadcast, larger ones joined by shuffle.
BROADCAST_ROWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII but digits and lower-case letters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    """The words of a text, in order, as 64-bit hashes; A-Z are lower-cased."""
    words = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _measured(df: DataFrame) -> DataFrame:
    """Written once; broadcast if it is small."""
    df = materialize(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


@dataclass
class Index:
    """Where the index of a corpus is stored, and the windows it was made for.

    `postings`: row_key, doc_id, n_words, pos, term; one row for each stored
    posting, and one with pos 0 or null for each document. `windows`: item,
    item_id, start, length, digest. `probes`: item, start, q, term, rank for the
    rarest terms of each window.
    """

    postings: DataFrame
    windows: DataFrame
    probes: DataFrame
    rarest: int = RAREST


def items_of(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """item (a key of its own per row), item_id and terms of each benchmark row with a word."""
    rows = benchmark.select(
        F.xxhash64(F.col(item_id), F.col(text)).alias("item"), F.col(item_id).alias("item_id"), word_hashes(F.col(text)).alias("terms")
    )
    return rows.filter(F.size("terms") > 0).dropDuplicates(["item"])


def item_windows(items: DataFrame) -> DataFrame:
    """item, item_id, start, length, digest and terms of each window."""
    length = F.least(F.size("terms"), F.lit(WINDOW_WORDS))
    cut = items.select("*", length.alias("length")).select(
        "item", "item_id", "length", "terms", F.explode(F.sequence(F.lit(0), F.size("terms") - F.col("length"))).alias("start")
    )
    window = F.slice("terms", F.col("start") + 1, F.col("length"))
    return cut.select("item", "item_id", "start", "length", F.xxhash64(window).alias("digest"), window.alias("terms"))


def build_index(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", rarest: int = RAREST,
) -> Index:
    """Count the test terms in the corpus, choose the rarest of each window and store their postings."""
    windows = materialize(item_windows(items_of(benchmark, item_id, item_text)))
    vocabulary = _measured(windows.select(F.explode("terms").alias("term")).distinct())
    terms = docs.select(F.explode(word_hashes(F.col(text))).alias("term"))
    counts = terms.join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    placed = windows.select("item", "start", F.posexplode("terms").alias("q", "term"))
    rarity = Window.partitionBy("item", "start").orderBy(F.coalesce("n", F.lit(0)), "q")
    probes = materialize(
        placed.join(counts, "term", "left")
        .withColumn("rank", F.row_number().over(rarity))
        .filter(F.col("rank") <= rarest)
        .select("item", "start", "q", "term", "rank")
    )
    wanted = _measured(probes.select(F.col("term").alias("wanted")).distinct())
    hashed = docs.select(
        F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"), F.col(doc_id).alias("doc_id"), word_hashes(F.col(text)).alias("terms")
    )
    tokens = hashed.select("row_key", "doc_id", F.size("terms").alias("n_words"), F.posexplode_outer("terms").alias("pos", "term"))
    kept = tokens.join(wanted, F.col("term") == F.col("wanted"), "left").filter(
        F.col("wanted").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0)
    )
    path = scratch_folder(docs.sparkSession)
    kept.select("row_key", "doc_id", "n_words", "pos", F.col("wanted").alias("term")).write.parquet(path)
    return Index(docs.sparkSession.read.parquet(path), windows.drop("terms"), probes, rarest)


def _starts(index: Index) -> DataFrame:
    """Where each window would begin, by each stored posting of one of its rarest terms."""
    found = index.postings.filter(F.col("term").isNotNull()).select("row_key", "n_words", "pos", "term")
    probes = index.probes
    if probes.count() <= BROADCAST_ROWS:
        probes = F.broadcast(probes)
    return found.join(probes, "term").select(
        "row_key", "n_words", "item", "start", "rank", (F.col("pos") - F.col("q")).alias("at")
    ).filter(F.col("at") >= 0)


def _agreed(index: Index) -> DataFrame:
    """Each place where a window would begin, the set of its rarest terms that say so (as bits) and how many terms it has."""
    needed = index.probes.groupBy("item", "start").agg(F.count(F.lit(1)).alias("needed"))
    needed = index.windows.join(needed, ["item", "start"])
    if index.windows.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    agreed = _starts(index).groupBy("row_key", "n_words", "item", "start", "at").agg(
        F.expr("bit_or(shiftleft(1, rank))").alias("ranks")
    )
    return agreed.join(needed, ["item", "start"])


def phrase_candidates(index: Index) -> DataFrame:
    """row_key, item, start, at: where all the rarest terms of a window stand as the window has them."""
    return _agreed(index).filter(
        (F.bit_count("ranks") == F.col("needed")) & (F.col("at") + F.col("length") <= F.col("n_words"))
    ).select("row_key", "item", "item_id", "at", "length", "digest")


def exact_matches(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row_key and matches (item_id, at, length), the occurrences of windows, for each document that has one."""
    candidates = materialize(
        phrase_candidates(index).groupBy("row_key").agg(
            F.collect_set(F.struct("item_id", "at", "length", "digest")).alias("candidates")
        )
    )
    listed = candidates.select(F.col("row_key").alias("listed"))
    if candidates.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    texts = docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"), F.col(text).alias("text"))
    asked = texts.join(listed, F.col("row_key") == F.col("listed"), "left_semi").dropDuplicates(["row_key"])
    # the words are bound once per text, as the element of an array, and not per candidate
    same = F.transform(
        F.array(word_hashes(F.col("text"))),
        lambda terms: F.filter("candidates", lambda c: F.xxhash64(F.slice(terms, c["at"] + 1, c["length"])) == c["digest"]),
    )[0]
    compared = asked.join(candidates, "row_key").select("row_key", same.alias("matches"))
    return stored(compared.filter(F.size("matches") > 0))


def proximity_matches(index: Index, slop: int) -> DataFrame:
    """row_key, item_id and at: documents where all the rarest terms of a window stand within `slop` words of their places to each other.

    One pass along each list of starts carries the last start by every term, so
    far postings never meet; `at` is the first of the starts that lie together.
    """
    along = Window.partitionBy("row_key", "item", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    seen = [
        F.last(F.when(F.col("ranks").bitwiseAND(1 << rank) != 0, F.col("at")), ignorenulls=True).over(along).alias(f"at_{rank}")
        for rank in range(1, index.rarest + 1)
    ]
    lists = _agreed(index).select("row_key", "item_id", "needed", "at", *seen)
    last = [F.col(f"at_{rank}") for rank in range(1, index.rarest + 1)]
    first = F.array_min(F.array(*last))
    there = F.size(F.array_compact(F.array(*last)))
    near = lists.filter((there == F.col("needed")) & (F.col("at") - first <= slop))
    return near.select("row_key", "item_id", first.alias("at")).distinct()


def coverage(matches: Column) -> Column:
    """How many words the matches cover together."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["at"].alias("at"), (m["at"] + m["length"]).alias("end"))))
    total = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, m: F.struct(
            (acc["n"] + F.greatest(m["end"] - F.greatest(acc["end"], m["at"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(acc["end"], m["end"]).alias("end"),
        ),
    )
    return total["n"]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    slop: int | None = None,
) -> DataFrame:
    """doc_id, row_key, n_words, n_hit, item_ids (sorted as strings) and contaminated for each row.

    With `slop` also near_item_ids, the items with a match of proximity (see `proximity_matches`); they do not
    contaminate a document by themselves.
    """
    index = build_index(docs, benchmark, doc_id, text, item_id, item_text)
    matches = exact_matches(docs, index, doc_id, text).select(
        F.col("row_key").alias("match_key"), coverage(F.col("matches")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"].cast("string")))).alias("item_ids"),
    )
    lengths = index.postings.filter(F.coalesce("pos", F.lit(0)) == 0).select(
        "doc_id", "row_key", F.greatest("n_words", F.lit(0)).cast("long").alias("n_words")
    )
    joined = lengths.join(matches, F.col("row_key") == F.col("match_key"), "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    found = [
        "doc_id", "row_key", "n_words", hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (hit > 0).alias("contaminated"),
    ]
    if slop is None:
        return joined.select(*found)
    near = proximity_matches(index, slop).groupBy(F.col("row_key").alias("near_key")).agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("near_item_ids")
    )
    nearby = F.coalesce("near_item_ids", F.array().cast("array<string>")).alias("near_item_ids")
    return joined.join(near, F.col("row_key") == F.col("near_key"), "left").select(*found, nearby)
