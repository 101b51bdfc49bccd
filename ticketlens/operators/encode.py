"""Encoders: fitting yields small tables, transforming is one generated projection.

Only vocabularies that become columns reach the driver. The frequency table has
one row per distinct value, stays distributed and is joined.
"""

from __future__ import annotations

import functools
import json
import math
import zlib
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens import skew
from ticketlens.functions.dates import day_of
from ticketlens.functions.text import SEPARATOR, tag_count, tags
from ticketlens.operators.profile import ColumnGroups, as_text, most_frequent, tag_counts, value_counts
from ticketlens.operators.quantiles import Moments, medians, number
from ticketlens.session import materialize, together
from ticketlens.skew import HOT_ROWS, Hot, hot_groups, hot_table, lookup_join, q

OTHER = "Other"
TOP_K = 10
MISSING_DATE_PART = -1
# values of all columns together that may become columns of their own
MOST_COLUMNS = 100_000
# terms of texts that one task counts
TERMS_AT_ONCE = 2_000_000
DATE_PARTS = {"year": F.year, "month": F.month}


def flag(condition: Column) -> Column:
    """1 or 0; null counts as 0."""
    return F.when(condition, 1).otherwise(0)


def impute_median(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Median per numeric column; a column without values is left out."""
    return {c: m for c, m in medians(df, columns).items() if m is not None}


def scaling(fill: dict[str, float], moments: dict[str, Moments]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of the filled columns, deviation 1 for constants."""
    out = {}
    for c, f in fill.items():
        # the moments of the values there and of the copies of the fill value, put together
        m = moments[c]
        missing = (m.rows - m.n) / m.rows
        mean = m.mean + missing * (f - m.mean)
        variance = (1 - missing) * m.variance + missing * (1 - missing) * (f - m.mean) ** 2
        out[c] = (mean, math.sqrt(variance) or 1.0)
    return out


def frequencies(values: DataFrame) -> DataFrame:
    """(column, value, share): share of a value among the non-null rows of its column."""
    totals = values.groupBy("column").agg(F.sum("n").alias("total")).collect()
    total = F
    for r in totals:
        total = total.when(F.col("column") == r["column"], F.lit(r["total"]))
    share = F.col("n") / total if totals else F.lit(None).cast("double")
    return values.select("column", "value", share.alias("share"))


def hot_values(df: DataFrame, columns: Sequence[str], limit: int = HOT_ROWS) -> dict[str, Hot | None]:
    """The values of each column that more than `limit` rows have, as `lookup_join` takes them; one job for all columns."""
    if not columns:
        return {}
    texts = F.array(*[F.struct(F.lit(c).alias("column"), as_text(df, c).alias("value")) for c in columns])
    counts = df.select(F.explode(texts).alias("v")).groupBy("v.column", "v.value").agg(F.count(F.lit(1)).alias("n"))
    # one more than can be listed tells that there are more
    found = _by_column(most_frequent(counts.filter(F.col("n") > limit), "value", skew.MAX_BROADCAST_ROWS + 1).collect())
    return {
        c: hot_table(df.sparkSession, "frequency_value string", [(r["value"],) for r in found[c]], [r["n"] for r in found[c]])
        if c in found else None
        for c in columns
    }


def join_frequency(
    df: DataFrame, shares: DataFrame, column: str, into: str, limit: int = HOT_ROWS, hot: Hot | None | bool = True
) -> DataFrame:
    """Adds the share of the column's value; 0 for null and unseen values. `hot` as `hot_values` found it, or True to look."""
    one = shares.filter(F.col("column") == column).select(F.col("value").alias("frequency_value"), F.col("share").alias(into))
    asked = df.withColumn("frequency_value", as_text(df, column))
    found = lookup_join(asked, one, ["frequency_value"], limit=limit, hot=hot)
    return found.drop("frequency_value").withColumn(into, F.coalesce(q(into), F.lit(0.0)))


def null_columns(df: DataFrame) -> list[str]:
    """Columns that hold at least one null."""
    row = df.agg(*[F.max(q(c).isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c]]


def select_fill(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.coalesce(as_text(df, column), F.lit("")).alias(column))


def align(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Exactly the expected columns in their order, absent ones as 0."""
    return df.select(*[q(c) if c in df.columns else F.lit(0).alias(c) for c in expected])


def total_of(terms: Sequence[Column]) -> Column:
    return functools.reduce(add, terms)


@dataclass
class EncoderState:
    """Everything a transform needs besides the frequency table."""

    groups: ColumnGroups
    kinds: dict[str, str]
    fill: dict[str, float] = field(default_factory=dict)
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    mode: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    top_values: dict[str, list[str]] = field(default_factory=dict)
    tag_vocabulary: dict[str, list[str]] = field(default_factory=dict)
    top_tags: dict[str, list[str]] = field(default_factory=dict)
    text_terms: dict[str, dict[str, float]] = field(default_factory=dict)


class Preprocessor:
    """Encodes mixed columns by group; output names carry the group as prefix, other columns go."""

    def __init__(self, state: EncoderState, shares: DataFrame | None, sep: str = SEPARATOR):
        self.state = state
        self.shares = shares
        self.sep = sep

    @classmethod
    def fit(
        cls, df: DataFrame, groups: ColumnGroups, k: int = TOP_K, sep: str = SEPARATOR, within: EncoderState | None = None,
        text_terms: int = 0, most_columns: int = MOST_COLUMNS,
    ) -> Preprocessor:
        """Fit on the rows. The texts of all columns are counted once, the numbers take two passes.

        `within` limits the values that become columns to those of another encoder,
        so that what reaches the driver is bounded by it. More than `most_columns`
        such values are an error. `text_terms` > 0 gives each long text the TF-IDF
        columns of its most frequent terms; without it long texts go.
        """
        kinds = dict(df.dtypes)
        used = [*groups.numeric, *groups.dates, *groups.one_hot, *groups.top_k, *groups.frequency, *groups.tag_count]
        state = EncoderState(groups, {c: kinds[c] for c in used})
        texts = list(dict.fromkeys([*groups.one_hot, *groups.top_k, *groups.tag_binarize, *groups.tag_top_k]))

        def numbers() -> None:
            moments: dict[str, Moments] = {}
            state.fill = {c: m for c, m in medians(df, groups.numeric, moments=moments).items() if m is not None}
            state.scale = scaling(state.fill, moments)

        def vocabularies() -> None:
            values = value_counts(df, texts).persist()
            for r in _vocabularies(values, groups, k, sep, within, most_columns):
                c, v = r["column"], r["value"]
                if r["kind"] == "mode":
                    state.mode[c] = v
                else:
                    getattr(state, r["kind"]).setdefault(c, []).append(v)
            values.unpersist()

        def shares() -> DataFrame:
            return materialize(frequencies(value_counts(df, groups.frequency)))

        # three independent sets of small jobs
        asked = [t for t, there in ((numbers, groups.numeric), (vocabularies, texts), (shares, groups.frequency)) if there]
        found = dict(zip(asked, together(*asked), strict=True)) if asked else {}
        for c in groups.text if text_terms else []:
            state.text_terms[c] = frequent_terms(df, c, text_terms, None if within is None else list(within.text_terms.get(c, {})))
        return cls(state, found.get(shares), sep)

    # one method per encoder: output name -> expression over the input columns

    def numeric(self) -> dict[str, Column]:
        s = self.state
        return {
            f"num__{c}": (F.coalesce(number(q(c)), F.lit(float(s.fill[c]))) - F.lit(s.scale[c][0])) / F.lit(s.scale[c][1])
            for c in s.groups.numeric if c in s.fill
        }

    def one_hot(self) -> dict[str, Column]:
        s = self.state
        return {
            f"onehot__{c}_{v}": flag(F.coalesce(self._text(c), F.lit(s.mode[c])) == v)
            for c in s.groups.one_hot for v in s.categories.get(c, [])
        }

    def date_parts(self) -> dict[str, Column]:
        s = self.state
        return {
            f"date__{c}_{part}": F.coalesce(of(day_of(q(c), s.kinds[c])), F.lit(MISSING_DATE_PART))
            for c in s.groups.dates for part, of in DATE_PARTS.items()
        }

    def top_k(self) -> dict[str, Column]:
        s = self.state
        out = {}
        for c in s.groups.top_k:
            # a real value "Other" shares the column of all rarer values
            values = [v for v in s.top_values.get(c, []) if v != OTHER]
            out.update({f"topk__{c}_{v}": flag(self._text(c) == v) for v in values})
            out[f"topk__{c}_{OTHER}"] = F.when(self._text(c).isin(*values), 0).otherwise(1) if values else F.lit(1)
        return out

    def frequency(self) -> dict[str, Column]:
        return {f"high_card__{c}": q(f"high_card__{c}") for c in self.state.groups.frequency}

    def tag_count(self) -> dict[str, Column]:
        return {f"ml_count__{c}": tag_count(q(c), self.sep) for c in self.state.groups.tag_count}

    def tag_binarize(self) -> dict[str, Column]:
        s = self.state
        return {
            f"ml_binarize__{c}_{t}": flag(F.array_contains(q(f"tags of {c}"), t))
            for c in s.groups.tag_binarize for t in s.tag_vocabulary.get(c, [])
        }

    def tag_top_k(self) -> dict[str, Column]:
        s = self.state
        return {
            f"ml_topk__{c}_{t}": flag(F.array_contains(q(f"tags of {c}"), t))
            for c in s.groups.tag_top_k for t in s.top_tags.get(c, [])
        }

    def text_columns(self) -> dict[str, Column]:
        """Uses of a term in the text times its inverse document frequency."""
        out = {}
        for c, terms in self.state.text_terms.items():
            for term, idf in terms.items():
                out[f"text__{c}_{term}"] = _uses(q(f"words of {c}"), term) * F.lit(float(idf))
        return out

    def _text(self, c: str) -> Column:
        return F.initcap(q(c).cast("string")) if self.state.kinds[c] == "boolean" else q(c).cast("string")

    def features(self) -> dict[str, Column]:
        """All output columns in order, over the columns of `prepared`."""
        return {
            **self.numeric(), **self.one_hot(), **self.date_parts(), **self.top_k(), **self.frequency(),
            **self.tag_count(), **self.tag_binarize(), **self.tag_top_k(), **self.text_columns(),
        }

    def names(self) -> list[str]:
        """Names of all features in order, without an expression for each."""
        s, g = self.state, self.state.groups
        return [
            *[f"num__{c}" for c in g.numeric if c in s.fill],
            *[f"onehot__{c}_{v}" for c in g.one_hot for v in s.categories.get(c, [])],
            *[f"date__{c}_{part}" for c in g.dates for part in DATE_PARTS],
            *[f"topk__{c}_{v}" for c in g.top_k for v in [*[v for v in s.top_values.get(c, []) if v != OTHER], OTHER]],
            *[f"high_card__{c}" for c in g.frequency], *[f"ml_count__{c}" for c in g.tag_count],
            *[f"ml_binarize__{c}_{t}" for c in g.tag_binarize for t in s.tag_vocabulary.get(c, [])],
            *[f"ml_topk__{c}_{t}" for c in g.tag_top_k for t in s.top_tags.get(c, [])],
            *[f"text__{c}_{t}" for c, idf in s.text_terms.items() for t in idf],
        ]

    def entries(self, names: Sequence[str] | None = None, shares: dict[str, Column] | None = None) -> dict[str, Column]:
        """Per input column its features that are not 0, as an array of j (the place in `names`) and x.

        Over the columns of `prepared`; numbers have an entry also for 0. A value's
        flag is looked up, so the work and the size of a row follow its values, not
        the vocabulary. `shares` are the frequencies of columns that are not joined.
        """
        s, g = self.state, self.state.groups
        place = {n: j for j, n in enumerate(self.names() if names is None else names)}
        out: dict[str, list[Column]] = {}

        def known(prefix: str, values: Sequence[str]) -> dict[str, int]:
            return {v: place[prefix + v] for v in values if prefix + v in place}

        for name, x in {**self.numeric(), **self.date_parts(), **self.tag_count()}.items():
            if name in place:
                out.setdefault(_source_column(name, g), []).append(F.array(_entry(F.lit(place[name]), x)))
        for c in g.frequency:
            if f"high_card__{c}" in place:
                share = shares[c] if shares else q(f"high_card__{c}")
                out.setdefault(c, []).append(F.array(_entry(F.lit(place[f"high_card__{c}"]), share)))
        for c in g.one_hot:
            if listed := known(f"onehot__{c}_", s.categories.get(c, [])):
                out.setdefault(c, []).append(_flag(F.coalesce(self._text(c), F.lit(s.mode[c])), listed))
        for c in g.top_k:
            listed = known(f"topk__{c}_", [v for v in s.top_values.get(c, []) if v != OTHER])
            other = place.get(f"topk__{c}_{OTHER}")
            found = _flag(self._text(c), listed) if listed else F.array().cast(ENTRIES)
            if other is not None:
                named = [v for v in s.top_values.get(c, []) if v != OTHER]
                rest = F.when(self._text(c).isin(*named), F.array().cast(ENTRIES)) if named else F
                found = F.concat(found, rest.otherwise(F.array(_entry(F.lit(other), F.lit(1.0)))) if named else F.array(_entry(F.lit(other), F.lit(1.0))))
            out.setdefault(c, []).append(found)
        for columns, prefix, vocabulary in ((g.tag_binarize, "ml_binarize__", s.tag_vocabulary), (g.tag_top_k, "ml_topk__", s.top_tags)):
            for c in columns:
                if listed := known(f"{prefix}{c}_", vocabulary.get(c, [])):
                    out.setdefault(c, []).append(_flags(F.array_distinct(q(f"tags of {c}")), listed))
        for c, idf in s.text_terms.items():
            listed = known(f"text__{c}_", list(idf))
            if listed:
                said = F.transform(_flags(F.array_distinct(q(f"words of {c}")), {t: k for k, t in enumerate(listed)}), lambda e: e["j"])
                terms_, places, weights = (F.array(*[F.lit(v) for v in vs]) for vs in (list(listed), list(listed.values()), [float(idf[t]) for t in listed]))
                out.setdefault(c, []).append(F.transform(said, lambda k: _entry(
                    F.get(places, k), F.size(F.filter(q(f"words of {c}"), lambda w: w == F.get(terms_, k))) * F.get(weights, k))))
        return {c: F.concat(*parts) if len(parts) > 1 else parts[0] for c, parts in out.items()}

    def sparse(self, df: DataFrame, keep: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
        """The kept columns and `entries`: j (the place in `names`) and x of the features that are not 0."""
        found = self.entries(names)
        ready = self.prepared(df, names)
        together_ = F.concat(*found.values()) if found else F.array().cast(ENTRIES)
        return ready.select(*[q(c) for c in keep], together_.alias("entries"))

    def prepared(self, df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
        """The input with the frequency columns that are asked for, the split tags and words."""
        g = self.state.groups
        asked = [c for c in g.frequency if names is None or f"high_card__{c}" in names]
        for c, hot in hot_values(df, asked).items():
            df = join_frequency(df, self.shares, c, f"high_card__{c}", hot=hot)
        split = {f"tags of {c}": tags(q(c), self.sep) for c in [*g.tag_binarize, *g.tag_top_k]}
        split.update({f"words of {c}": terms(q(c)) for c in self.state.text_terms})
        return df.withColumns(split) if split else df

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The kept columns and one column per feature."""
        ready = self.prepared(df)
        return ready.select(*[q(c) for c in keep], *[x.alias(n) for n, x in self.features().items()])

    def vectors(self, df: DataFrame, keep: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
        """The kept columns and `features`, an array of the named features; unknown names are 0."""
        features = self.features()
        names = list(features) if names is None else names
        ready = self.prepared(df, names)
        cells = [features[n].cast("double") if n in features else F.lit(0.0) for n in names]
        return ready.select(*[q(c) for c in keep], F.array(*cells).alias("features"))

    def save(self, path: str, spark: SparkSession) -> None:
        spark.createDataFrame([(json.dumps(asdict(self.state)), self.sep)], "state string, sep string").coalesce(1).write.mode(
            "overwrite").json(f"{path}/encoder")
        if self.shares is not None:
            self.shares.write.mode("overwrite").partitionBy("column").parquet(f"{path}/shares")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        row = spark.read.schema("state string, sep string").json(f"{path}/encoder").first()
        stored = json.loads(row["state"])
        stored["groups"] = ColumnGroups(**stored["groups"])
        stored["scale"] = {c: tuple(v) for c, v in stored["scale"].items()}
        state = EncoderState(**stored)
        shares = spark.read.schema("value string, share double, column string").parquet(f"{path}/shares") if state.groups.frequency else None
        return cls(state, shares, row["sep"])


ENTRIES = "array<struct<j:int,x:double>>"


def _entry(j: Column, x: Column) -> Column:
    return F.struct(j.cast("int").alias("j"), x.cast("double").alias("x"))


def _place(places: dict[str, int], per_bucket: int = 4) -> Callable[[Column], Column]:
    """The place of a key, null without one. Keys are looked up in buckets by crc32, so a long list costs no more."""
    buckets: list[dict[str, int]] = [{} for _ in range(max(1, len(places) // per_bucket))]
    for key, j in places.items():
        buckets[zlib.crc32(key.encode()) % len(buckets)][key] = j
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")
    return lambda key: F.try_element_at(F.get(table, (F.crc32(key) % len(buckets)).cast("int")), key)


def _flag(key: Column, places: dict[str, int]) -> Column:
    """An entry 1 if the key has a place; without a lambda, so the code of a row is generated."""
    place = _place(places)(key)
    return F.when(place.isNotNull(), F.array(_entry(place, F.lit(1.0)))).otherwise(F.array().cast(ENTRIES))


def _flags(keys: Column, places: dict[str, int]) -> Column:
    """An entry 1 for each of the keys that has a place."""
    place = _place(places)
    return F.filter(F.transform(keys, lambda k: _entry(place(k), F.lit(1.0))), lambda e: e["j"].isNotNull())


def _source_column(name: str, groups: ColumnGroups) -> str:
    """The input column of a number, a part of a date or a tag count."""
    kind, _, rest = name.partition("__")
    if kind == "date":
        return next(c for c in groups.dates for part in DATE_PARTS if rest == f"{c}_{part}")
    return rest


def _by_column(rows: list) -> dict[str, list]:
    out: dict[str, list] = {}
    for r in rows:
        out.setdefault(r["column"], []).append(r)
    return out


def _vocabularies(
    values: DataFrame, groups: ColumnGroups, k: int, sep: str, within: EncoderState | None, most_columns: int
) -> list:
    """Rows kind, column, value, in the order in which the columns will stand; `values` are value counts."""
    def of(columns: Sequence[str]) -> DataFrame:
        return values.filter(F.col("column").isin(list(columns)))

    def limited(rows: DataFrame, known: dict[str, list[str]] | None) -> DataFrame:
        if known is None:
            return rows
        allowed = F.lit(False)
        for c, listed in known.items():
            allowed = allowed | ((F.col("column") == c) & F.col("value").isin(listed))
        return rows.filter(allowed)

    parts = []
    if groups.one_hot:
        rows = of(groups.one_hot)
        parts.append(limited(rows, within and within.categories).select(F.lit("categories").alias("kind"), "column", "value", F.lit(0).alias("place")))
        parts.append(most_frequent(rows, "value", 1).select(F.lit("mode").alias("kind"), "column", "value", F.lit(0).alias("place")))
    if groups.top_k:
        parts.append(most_frequent(of(groups.top_k), "value", k).select(F.lit("top_values").alias("kind"), "column", "value", "place"))
    if groups.tag_binarize:
        rows = tag_counts(of(groups.tag_binarize), sep).withColumnRenamed("tag", "value")
        parts.append(limited(rows, within and within.tag_vocabulary).select(F.lit("tag_vocabulary").alias("kind"), "column", "value", F.lit(0).alias("place")))
    if groups.tag_top_k:
        rows = most_frequent(tag_counts(of(groups.tag_top_k), sep), "tag", k)
        parts.append(rows.select(F.lit("top_tags").alias("kind"), "column", F.col("tag").alias("value"), "place"))
    found = functools.reduce(DataFrame.unionByName, parts).limit(most_columns + 1).collect()
    if len(found) > most_columns:
        raise ValueError(f"more than {most_columns} values would become columns; choose other encodings")
    return sorted(found, key=lambda r: (r["kind"], r["column"], r["place"], r["value"]))


def terms(text: Column) -> Column:
    """Words of a text, lower-cased, between white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def _uses(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == F.lit(term)))


def document_frequency(df: DataFrame, column: str) -> DataFrame:
    """term and the number of rows whose text has it."""
    return df.select(F.explode(F.array_distinct(terms(q(column)))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("rows"))


def inverse_frequency(rows: Column, total: int) -> Column:
    return F.log((F.lit(float(total)) + 1.0) / (rows + 1.0))


def frequent_terms(df: DataFrame, column: str, k: int, among: Sequence[str] | None = None) -> dict[str, float]:
    """Inverse document frequency of the k terms that most rows have, smallest term first on ties; of those `among`, if given."""
    order = [F.col("rows").desc(), F.col("term")]
    idf = inverse_frequency(F.col("rows"), df.count())
    rows = document_frequency(df, column)
    if among is not None:
        rows = rows.filter(F.col("term").isin(list(among)))
    return {r["term"]: r["idf"] for r in rows.orderBy(*order).limit(k).select("term", idf.alias("idf")).collect()}


def text_tfidf(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, term and tfidf for every term of every text: its uses times ln((rows + 1) / (rows with the term + 1)).

    Terms stay apart at any vocabulary size; the table is as long as the texts and
    stays distributed.
    """
    rows = df.select(q(key).alias("key"), q(column).alias("text"))
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size(terms(F.col("text")))), F.lit(0)).alias("terms")).first()
    # a task gets so many terms however large the table; a hot key is spread, its terms are counted before they meet
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size["terms"] / TERMS_AT_ONCE))
    spread = rows.repartition(parts) if hot_groups(rows, ["key"]) else rows.repartition(parts, "key")
    uses = spread.select("key", F.explode(terms(F.col("text"))).alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("uses"))
    known = materialize(document_frequency(spread, "text"))
    # no term is used by more keys than by rows
    hot = known.filter(F.col("rows") > HOT_ROWS).orderBy(F.col("rows").desc(), "term").limit(skew.MAX_BROADCAST_ROWS + 1).collect()
    hot = hot_table(df.sparkSession, "term string", [(r["term"],) for r in hot], [r["rows"] for r in hot]) if hot else None
    weight = known.select("term", inverse_frequency(F.col("rows"), size["rows"]).alias("idf"))
    return lookup_join(uses, weight, ["term"], "inner", hot=hot).select("key", "term", (F.col("uses") * F.col("idf")).alias("tfidf"))
