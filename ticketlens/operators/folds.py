"""Feature plans of all folds from one count of the values.

The values of every column are counted once by class and fold. A fold's training
side is the total less its own part, so the column types, profiles, medians,
moments, vocabularies, class statistics and mutual information of all folds come
out of that table: the rows are read once, and the number of jobs does not depend
on the number of folds. What is a constant of a fold (a median, a vocabulary, a
column's encoding) is the same as if its training side were fitted by itself.

A view is one such side: all rows but those of one fold, or all rows (reference
rows have no folds). The count is written to the shared checkpoint folder, sorted
by column.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.functions.dates import date_or_null
from ticketlens.functions.text import SEPARATOR, tags
from ticketlens.operators import select
from ticketlens.operators.encode import ENTRIES, MOST_COLUMNS, TOP_K, EncoderState, Preprocessor, terms
from ticketlens.operators.neighbours import RANGE_ROWS, binned_information, neighbour_information, ranges
from ticketlens.operators.profile import DATE_SHARE, HIGH_CARDINALITY, LONG_TEXT, NUMBERS, RARE_COUNT, ColumnGroups, classify
from ticketlens.operators.quantiles import number
from ticketlens.operators.select import FeatureStats
from ticketlens.session import materialize, scratch_folder
from ticketlens.skew import q

#: Fold of rows that are not dealt into folds, and the view of all rows.
NO_FOLD, ALL_ROWS = -1, -2


@dataclass
class ValueCounts:
    """(c, v, cells): the values of the columns as text, with rows by class and fold, null values too."""

    table: DataFrame
    columns: list[str]
    kinds: dict[str, str]
    sizes: dict[tuple[str, int], int]

    @classmethod
    def count(cls, df: DataFrame, columns: Sequence[str], label: Column | None = None, fold: Column | None = None) -> ValueCounts:
        """One pass over the rows; rows without a class are left out if there are classes."""
        cells = F.array(*[F.struct(F.lit(i).alias("c"), q(c).cast("string").alias("v")) for i, c in enumerate(columns)])
        label = F.lit("") if label is None else label.cast("string")
        fold = F.lit(NO_FOLD) if fold is None else fold.cast("int")
        long = df.select(label.alias("label"), fold.alias("fold"), F.inline(cells)).filter("label IS NOT NULL")
        counted = long.groupBy("c", "v", "label", "fold").agg(F.count(F.lit(1)).alias("n"))
        held = counted.groupBy("c", "v").agg(F.collect_list(F.struct("label", "fold", "n")).alias("cells"))  # classes x folds at most
        path = scratch_folder(df.sparkSession)
        held.sortWithinPartitions("c").write.parquet(path)
        table = df.sparkSession.read.parquet(path)
        sizes = table.filter("c = 0").select(F.inline("cells")).groupBy("label", "fold").agg(F.sum("n").alias("n")).collect()
        kinds = dict(df.dtypes)
        return cls(table, list(columns), {c: kinds[c] for c in columns}, {(r["label"], r["fold"]): r["n"] for r in sizes})

    def rows(self, view: int) -> int:
        return sum(n for (_, fold), n in self.sizes.items() if fold != view)

    def classes(self, view: int) -> dict[str, int]:
        out: dict[str, int] = {}
        for (label, fold), n in self.sizes.items():
            if fold != view:
                out[label] = out.get(label, 0) + n
        return out

    def of(self, columns: Sequence[str]) -> DataFrame:
        return self.table.filter(F.col("c").isin([self.columns.index(c) for c in columns]))

    def weighted(self, columns: Sequence[str], views: Sequence[int]) -> DataFrame:
        """(c, v, view, w): rows of each value on each side, where there are any. `view` counts from 0 in the order given."""
        sums = F.array(*[weight(f) for f in views])
        return self.of(columns).select("c", "v", F.posexplode(sums).alias("view", "w")).filter("w > 0")


def side(view: int) -> Column:
    """The value's rows by class and fold on one side."""
    return F.filter("cells", lambda x: x["fold"] != view)


def weight(view: int) -> Column:
    """Rows of the value on one side."""
    return F.aggregate(side(view), F.lit(0).cast("long"), lambda s, x: s + x["n"])


def value_as(kind: str) -> Column:
    return F.col("v").cast(kind)


def shown(counts: ValueCounts, columns: Sequence[str]) -> Column:
    """A value as the profile reads it: booleans are True and False."""
    flags = [counts.columns.index(c) for c in columns if counts.kinds[c] == "boolean"]
    return F.when(F.col("c").isin(flags), F.initcap("v")).otherwise(F.col("v")) if flags else F.col("v")


def unread_texts(rows: DataFrame, columns: Sequence[str], label: Column, fold: Column, views: Sequence[int], sep: str = SEPARATOR) -> list[str]:
    """Text columns that are long texts in every view, found by one pass without a shuffle of their values.

    Without terms such a column enters no feature, so its values, most of them
    different, need not be counted. A column is told by a sketch only if it is far
    above the high threshold (four times, as in `group_columns`) in every view, all
    else is exact; a column that is not told is left to the count.
    """
    kinds = dict(rows.dtypes)
    texts = [c for c in columns if kinds[c] == "string"]
    if not texts:
        return []
    measures = []
    for i, c in enumerate(texts):
        v = q(c)
        measures += [
            F.approx_count_distinct(v).alias(f"d{i}"), F.count(v).alias(f"n{i}"), F.count(F.when(v.contains(sep), True)).alias(f"m{i}"),
            F.sum(F.length(v)).alias(f"l{i}"), F.count(date_or_null(v)).alias(f"t{i}"),
        ]
    seen = rows.filter(label.isNotNull()).groupBy(fold.cast("int").alias("fold")).agg(*measures).collect()  # a row per fold

    def told(i: int, view: int) -> bool:
        parts = [r for r in seen if r["fold"] != view and r[f"n{i}"]]
        n = sum(r[f"n{i}"] for r in parts)
        return bool(n) and (
            max(r[f"d{i}"] for r in parts) > 4 * HIGH_CARDINALITY and sum(r[f"m{i}"] for r in parts) / n <= 0.5
            and sum(r[f"l{i}"] for r in parts) / n > LONG_TEXT and sum(r[f"t{i}"] for r in parts) / n < DATE_SHARE)

    return [c for i, c in enumerate(texts) if all(told(i, view) for view in views)]


def column_groups(counts: ValueCounts, views: Sequence[int], sep: str = SEPARATOR, rare: int = RARE_COUNT) -> list[ColumnGroups]:
    """Types and encodings of all columns, per view."""
    kinds = counts.kinds
    texts = [c for c in counts.columns if kinds[c] in ("string", "boolean")]
    values = counts.weighted(texts, views).filter("v IS NOT NULL").withColumn("value", shown(counts, texts)) if texts else None
    stats: dict[tuple[int, int], object] = {}
    if values is not None:
        dated = F.when(date_or_null(F.col("v")).isNotNull(), F.col("w")).otherwise(0)
        per_column = values.groupBy("c", "view").agg(
            F.count(F.lit(1)).alias("n_unique"), (F.sum(dated) / F.sum("w")).alias("date_share"),
            (F.sum(F.when(F.col("value").contains(sep), F.col("w")).otherwise(0)) / F.sum("w")).alias("multi_share"),
            (F.sum(F.col("w") * F.length("value")) / F.sum("w")).alias("mean_length"),
        )
        multi = materialize(per_column)
        labelled = multi.filter("multi_share > 0.5").select("c", "view")
        tagged = values.join(F.broadcast(labelled), ["c", "view"]).select("c", "view", "w", F.explode(tags(F.col("value"), sep)).alias("tag"))
        per_tag = tagged.groupBy("c", "view", "tag").agg(F.sum("w").alias("n")).groupBy("c", "view").agg(
            F.count(F.lit(1)).alias("n_tags"), F.avg((F.col("n") < rare).cast("double")).alias("rare_share"))
        stats = {(r["c"], r["view"]): r for r in classify(multi.join(per_tag, ["c", "view"], "left")).collect()}  # columns x views
    out = []
    for place in range(len(views)):
        def found(c: str, at: int = place):
            return stats.get((counts.columns.index(c), at))

        dates = [
            c for c in counts.columns
            if kinds[c] in ("date", "timestamp", "timestamp_ntz") or kinds[c] == "string" and found(c) and found(c)["date_share"] >= DATE_SHARE
        ]
        groups = ColumnGroups(numeric=sorted(c for c in counts.columns if kinds[c].startswith(NUMBERS)), dates=dates)
        for c in [c for c in texts if c not in dates]:
            chosen = found(c)["strategy"] if found(c) else "one_hot"
            getattr(groups, chosen).append(c)
            if chosen in ("tag_binarize", "tag_top_k"):
                groups.tag_count.append(c)
        out.append(groups)
    return out


def _numbers(counts: ValueCounts, states: Sequence[EncoderState], views: Sequence[int], range_rows: int) -> None:
    """Medians, and means and deviations of the filled values, into the states."""
    columns = sorted({c for s in states for c in s.groups.numeric})
    if not columns:
        return
    values = counts.weighted(columns, views).withColumn("x", number(F.col("v"))).filter("x IS NOT NULL")
    # equal numbers may be written in several ways
    values = materialize(values.groupBy("c", "view", "x").agg(F.sum("w").alias("w")))
    totals = {(r["c"], r["view"]): r for r in values.groupBy("c", "view").agg(
        F.count(F.lit(1)).alias("values"), F.sum("w").alias("n"), (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mean")).collect()}
    if not totals:
        return
    spark = values.sparkSession
    known = F.broadcast(spark.createDataFrame([(*k, r["n"], r["mean"]) for k, r in totals.items()], "c int, view int, n long, mean double"))
    around = F.col("x") - F.col("mean")
    spread = {(r["c"], r["view"]): r["v"] for r in values.join(known, ["c", "view"]).groupBy("c", "view").agg(
        (F.sum(F.col("w") * around * around) / F.sum("w")).alias("v")).collect()}
    cut = ranges(values, ["c", "view", "x"], sum(r["values"] for r in totals.values()), range_rows)
    sums = cut.groupBy("c", "view", "chunk").agg(F.sum("w").alias("sum"))
    chain = Window.partitionBy("c", "view").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("c", "view", "chunk", F.coalesce(F.sum("sum").over(chain), F.lit(0)).alias("offset"))
    run = Window.partitionBy("c", "view", "chunk").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cut.withColumn("run", F.sum("w").over(run)).join(offsets, ["c", "view", "chunk"]).join(known, ["c", "view"])
    upto = F.col("run") + F.col("offset")
    middle = [F.min(F.when(upto > place, F.col("x"))).alias(name) for name, place in (("low", F.floor((F.col("n") - 1) / 2)), ("high", F.floor(F.col("n") / 2)))]
    medians = {(r["c"], r["view"]): (r["low"] + r["high"]) / 2 for r in ranked.groupBy("c", "view").agg(*middle).collect()}
    for place, state in enumerate(states):
        for c in state.groups.numeric:
            key = (counts.columns.index(c), place)
            if key not in totals:
                continue
            fill, mean, variance, n = medians[key], totals[key]["mean"], spread[key], totals[key]["n"]
            missing = 1 - n / counts.rows(views[place])
            state.fill[c] = fill
            filled = (1 - missing) * variance + missing * (1 - missing) * (fill - mean) ** 2
            state.scale[c] = (mean + missing * (fill - mean), math.sqrt(filled) or 1.0)


def _vocabularies(
    counts: ValueCounts, states: Sequence[EncoderState], views: Sequence[int], within: Sequence[EncoderState] | None, k: int, sep: str, most_columns: int
) -> None:
    """Modes, categories, most frequent values and tags, into the states."""
    def asked(pick: Callable[[ColumnGroups], Sequence[str]]) -> list[tuple[int, int]]:
        return [(counts.columns.index(c), at) for at, s in enumerate(states) for c in pick(s.groups)]

    def chosen(rows: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
        return rows.filter(F.struct("c", "view").isin([F.struct(F.lit(c), F.lit(at)) for c, at in pairs]))

    def limited(rows: DataFrame, kind: str) -> DataFrame:
        if within is None:
            return rows
        allowed = [
            (counts.columns.index(c), at, v) for at, s in enumerate(within) for c, vs in getattr(s, kind).items() if c in counts.columns for v in vs
        ]
        known = rows.sparkSession.createDataFrame(allowed, "c int, view int, value string")
        return rows.join(F.broadcast(known), ["c", "view", "value"], "left_semi")  # at most the columns of the training encoders

    def first(rows: DataFrame, most: int) -> DataFrame:
        order = Window.partitionBy("c", "view").orderBy(F.col("w").desc(), "value")
        return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)

    def parted(rows: DataFrame) -> DataFrame:
        uses = rows.select("c", "view", "w", F.explode(tags(F.col("value"), sep)).alias("value"))
        return uses.groupBy("c", "view", "value").agg(F.sum("w").alias("w"))

    texts = sorted({c for s in states for g in (s.groups.one_hot, s.groups.top_k, s.groups.tag_binarize, s.groups.tag_top_k) for c in g})
    if not texts:
        return
    values = counts.weighted(texts, views).filter("v IS NOT NULL").withColumn("value", shown(counts, texts)).drop("v")
    parts = []
    if pairs := asked(lambda g: g.one_hot):
        rows = chosen(values, pairs)
        parts += [("categories", limited(rows, "categories").withColumn("place", F.lit(0))), ("mode", first(rows, 1))]
    if pairs := asked(lambda g: g.top_k):
        parts.append(("top_values", first(chosen(values, pairs), k)))
    if pairs := asked(lambda g: g.tag_binarize):
        parts.append(("tag_vocabulary", limited(parted(chosen(values, pairs)), "tag_vocabulary").withColumn("place", F.lit(0))))
    if pairs := asked(lambda g: g.tag_top_k):
        parts.append(("top_tags", first(parted(chosen(values, pairs)), k)))
    every = functools.reduce(DataFrame.unionByName, [rows.select(F.lit(kind).alias("kind"), "c", "view", "value", "place") for kind, rows in parts])
    limit = most_columns * len(states)
    found = every.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {most_columns} values would become columns; choose other encodings")
    for r in sorted(found, key=lambda r: (r["kind"], r["c"], r["view"], r["place"], r["value"])):
        state, c = states[r["view"]], counts.columns[r["c"]]
        if r["kind"] == "mode":
            state.mode[c] = r["value"]
        else:
            getattr(state, r["kind"]).setdefault(c, []).append(r["value"])


def _terms(counts: ValueCounts, states: Sequence[EncoderState], views: Sequence[int], within: Sequence[EncoderState] | None, k: int) -> None:
    """Inverse document frequencies of the k terms of each long text that most rows have, into the states."""
    asked = [(counts.columns.index(c), at) for at, s in enumerate(states) for c in s.groups.text]
    if not asked:
        return
    texts = sorted({counts.columns[c] for c, _ in asked})
    rows = counts.weighted(texts, views).filter(F.struct("c", "view").isin([F.struct(F.lit(c), F.lit(at)) for c, at in asked]))
    uses = rows.select("c", "view", "w", F.explode(F.array_distinct(terms(F.col("v")))).alias("term")).groupBy("c", "view", "term").agg(F.sum("w").alias("rows"))
    if within is not None:
        known = [(counts.columns.index(c), at, t) for at, s in enumerate(within) for c, idf in s.text_terms.items() for t in idf]
        uses = uses.join(F.broadcast(uses.sparkSession.createDataFrame(known, "c int, view int, term string")), ["c", "view", "term"], "left_semi")
    order = Window.partitionBy("c", "view").orderBy(F.col("rows").desc(), "term")
    first = uses.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).collect()  # k per column and view
    for r in sorted(first, key=lambda r: (r["c"], r["view"], r["place"])):
        idf = math.log((counts.rows(views[r["view"]]) + 1.0) / (r["rows"] + 1.0))
        states[r["view"]].text_terms.setdefault(counts.columns[r["c"]], {})[r["term"]] = idf


def encoders(
    counts: ValueCounts, groups: Sequence[ColumnGroups], views: Sequence[int], within: Sequence[EncoderState] | None = None,
    k: int = TOP_K, sep: str = SEPARATOR, most_columns: int = MOST_COLUMNS, range_rows: int = RANGE_ROWS, text_terms: int = 0,
) -> list[Preprocessor]:
    """A fitted encoder per view."""
    states = []
    for g in groups:
        used = [*g.numeric, *g.dates, *g.one_hot, *g.top_k, *g.frequency, *g.tag_count]
        states.append(EncoderState(g, {c: counts.kinds[c] for c in used}))
    _numbers(counts, states, views, range_rows)
    _vocabularies(counts, states, views, within, k, sep, most_columns)
    if text_terms:
        _terms(counts, states, views, within, text_terms)
    return [Preprocessor(s, _shares(counts, s.groups.frequency, view), sep) for s, view in zip(states, views, strict=True)]


def _share(counts: ValueCounts, view: int, filled: dict[int, int]) -> Column:
    total = F
    for c, n in filled.items():
        total = total.when(F.col("c") == c, F.lit(n))
    return F.when(F.col("v").isNotNull(), weight(view) / total).otherwise(0.0) if filled else F.lit(0.0)


def _filled(counts: ValueCounts, columns: Sequence[str], views: Sequence[int]) -> dict[int, dict[int, int]]:
    """Rows with a value per view and column."""
    out: dict[int, dict[int, int]] = {at: {} for at in range(len(views))}
    if columns:
        for r in counts.weighted(columns, views).filter("v IS NOT NULL").groupBy("c", "view").agg(F.sum("w").alias("n")).collect():
            out[r["view"]][r["c"]] = r["n"]
    return out


def _shares(counts: ValueCounts, columns: Sequence[str], view: int) -> DataFrame | None:
    """(column, value, share) of the view's training side, read from the count."""
    if not columns:
        return None
    rows = counts.of(columns).filter("v IS NOT NULL").select("c", shown(counts, columns).alias("value"), weight(view).alias("w")).filter("w > 0")
    names = F.array(*[F.lit(c) for c in counts.columns])
    totals = rows.groupBy(F.col("c").alias("of")).agg(F.sum("w").alias("total"))
    return rows.join(F.broadcast(totals), F.col("c") == F.col("of")).select(F.get(names, F.col("c")).alias("column"), "value", (F.col("w") / F.col("total")).alias("share"))


def feature_table(counts: ValueCounts, fitted: Sequence[Preprocessor], views: Sequence[int]) -> DataFrame:
    """(view, j, label, x, n): how many rows of a class have the value x in feature j of the view's encoder; written once.

    Features that a value leaves at 0 have no row.
    """
    named = {c: F.when(F.col("c") == i, value_as(counts.kinds[c])) for i, c in enumerate(counts.columns)}
    rows = counts.table.withColumns({f"raw {c}": x for c, x in named.items()})
    rows = rows.select("c", "v", "cells", *[q(f"raw {c}").alias(c) for c in counts.columns])
    split = sorted({c for e in fitted for c in [*e.state.groups.tag_binarize, *e.state.groups.tag_top_k]})
    if split:
        rows = rows.withColumns({f"tags of {c}": tags(q(c), fitted[0].sep) for c in split})
    long_texts = sorted({c for e in fitted for c in e.state.text_terms})
    if long_texts:
        rows = rows.withColumns({f"words of {c}": terms(q(c)) for c in long_texts})
    frequent = sorted({c for e in fitted for c in e.state.groups.frequency})
    filled = _filled(counts, frequent, views)
    sides = []
    for at, (view, encoder) in enumerate(zip(views, fitted, strict=True)):
        wanted = {c: n for c, n in filled[at].items() if counts.columns[c] in encoder.state.groups.frequency}
        share = _share(counts, view, wanted)
        entries = F
        for c, found in encoder.entries(shares={c: share for c in encoder.state.groups.frequency}).items():
            entries = entries.when(F.col("c") == counts.columns.index(c), found)
        entries = F.coalesce(entries, F.array().cast(ENTRIES)) if entries is not F else F.array().cast(ENTRIES)
        sides.append(F.struct(F.lit(at).alias("view"), side(view).alias("own"), entries.alias("entries")))
    sided = rows.select(F.inline(F.array(*sides))).filter(F.size("own") > 0)
    long = sided.select("view", "own", F.inline("entries")).select("view", "j", "x", F.inline("own"))
    return materialize(long.groupBy("view", "j", "label", "x").agg(F.sum("n").alias("n")))


def feature_stats(counts: ValueCounts, table: DataFrame, fitted: Sequence[Preprocessor], views: Sequence[int]) -> list[list[FeatureStats]]:
    """Statistics of every feature of every view, from its values and their counts."""
    n, x = F.col("n"), F.col("x")
    first = table.groupBy("view", "j", "label").agg(
        F.sum("n").alias("n"), F.sum(F.when(x != 0, n).otherwise(0)).alias("present"), (F.sum(n * x) / F.sum(n)).alias("mean"),
        F.min("x").alias("low"), F.max("x").alias("high"))
    held = materialize(first)
    names = [F.col(c).alias(f"of_{c}") for c in ("view", "j", "label", "mean")]
    same = functools.reduce(lambda a, b: a & b, [F.col(c) == F.col(f"of_{c}") for c in ("view", "j", "label")])
    variance = (F.sum(n * (x - F.col("of_mean")) ** 2) / F.sum(n)).alias("variance")
    rows = held.join(table.join(held.select(*names), same).groupBy("view", "j", "label").agg(variance), ["view", "j", "label"]).collect()
    found = {(r["view"], r["j"], r["label"]): r for r in rows}  # features x classes
    out = []
    for at, (view, encoder) in enumerate(zip(views, fitted, strict=True)):
        classes = counts.classes(view)
        labels = sorted(classes)
        every = [
            select.of_entries(name, [classes[c] for c in labels], [found.get((at, j, c)) for c in labels]) for j, name in enumerate(encoder.names())
        ]
        out.append(every)
    return out


def information(
    counts: ValueCounts, table: DataFrame, stats: Sequence[Sequence[FeatureStats]], views: Sequence[int], bins: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> list[dict[str, float]]:
    """Mutual information of every varying feature and the class, per view: by nearest neighbours, or over equal-frequency bins."""
    wide = max((len(s) for s in stats), default=0)
    asked = [(at, j) for at, every in enumerate(stats) for j, s in enumerate(every) if s.varies]
    if not asked:
        return [{s.name: 0.0 for s in every} for every in stats]
    spark = table.sparkSession
    known = F.broadcast(spark.createDataFrame(asked, "view int, j int"))
    place = (F.col("view") * wide + F.col("j")).cast("int")
    there = table.join(known, ["view", "j"]).select(place.alias("i"), "label", "x", "n")
    sizes = spark.createDataFrame(
        [(at * wide + j, label, n) for at, j in asked for label, n in counts.classes(views[at]).items()], "i int, label string, size long")
    # rows that no entry speaks of have the value 0
    zeros = sizes.join(there.groupBy("i", "label").agg(F.sum("n").alias("n")), ["i", "label"], "left").select(
        "i", "label", F.lit(0.0).alias("x"), (F.col("size") - F.coalesce("n", F.lit(0))).alias("n"))
    every_value = there.unionByName(zeros)
    if bins is None:
        found = neighbour_information(every_value, range_rows=range_rows)
    else:
        flags = [at * wide + j for at, j in asked if stats[at][j].is_flag]
        found = binned_information(every_value, bins, flags, range_rows)
    return [{s.name: found.get(at * wide + j, 0.0) for j, s in enumerate(every)} for at, every in enumerate(stats)]
