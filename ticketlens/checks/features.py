"""Registered queries over encoders and feature selection, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlens.fixtures import fixture, held_fixture, with_views
from ticketlens.functions.text import tag_count
from ticketlens.operators import encode
from ticketlens.operators.encode import Preprocessor
from ticketlens.operators.profile import ColumnGroups, value_counts
from ticketlens.skew import q

QUERIES = {}
ORACLE = {}

GROUPS = ColumnGroups(
    numeric=["n_price", "n_qty"], dates=["c_date"], one_hot=["c_onehot"], top_k=["c_topk"], frequency=["c_high"],
    tag_count=["t_bin", "t_topk"], tag_binarize=["t_bin"], tag_top_k=["t_topk"],
)


def items(spark, sf):
    return fixture(spark, sf, "fx_items")


def sql(select: str) -> str:
    return with_views(select, "fx_items")


def _fit(spark, sf, **groups):
    return Preprocessor.fit(items(spark, sf), ColumnGroups(**groups))


def _impute_median(spark, sf):
    rows = items(spark, sf)
    fill = encode.impute_median(rows, ["n_price"])
    return rows.select("key", F.coalesce("n_price", F.lit(fill["n_price"])).alias("n_price"))


QUERIES["impute_median"] = _impute_median
ORACLE["impute_median"] = sql("SELECT key, coalesce(n_price, (SELECT median(n_price) FROM fx_items)) AS n_price FROM fx_items")


def _standard_scale(spark, sf):
    rows = items(spark, sf)
    fitted = Preprocessor.fit(rows, ColumnGroups(numeric=["n_price", "n_qty", "n_const"]))
    return fitted.transform(rows, ["key"]).select("key", *[F.round(c, 6).alias(c) for c in ("num__n_price", "num__n_qty", "num__n_const")])


FILLED = "filled AS (SELECT *, coalesce(n_price, (SELECT median(n_price) FROM fx_items)) AS f_price FROM fx_items)"
QUERIES["standard_scale"] = _standard_scale
ORACLE["standard_scale"] = with_views("", "fx_items").rstrip() + ",\n" + FILLED + """
SELECT key, round((f_price - avg(f_price) OVER ()) / stddev_pop(f_price) OVER (), 6) AS num__n_price,
       round((n_qty - avg(n_qty) OVER ()) / stddev_pop(n_qty) OVER (), 6) AS num__n_qty, CAST(0 AS DOUBLE) AS num__n_const FROM filled"""


def _impute_mode(spark, sf):
    rows = items(spark, sf)
    mode = Preprocessor.fit(rows, ColumnGroups(one_hot=["c_onehot"])).state.mode["c_onehot"]
    return rows.select("key", F.coalesce("c_onehot", F.lit(mode)).alias("c_onehot"))


MODE = "(SELECT c_onehot FROM fx_items WHERE c_onehot IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, c_onehot LIMIT 1)"
QUERIES["impute_mode"] = _impute_mode
ORACLE["impute_mode"] = sql(f"SELECT key, coalesce(c_onehot, {MODE}) AS c_onehot FROM fx_items")
QUERIES["impute_const"] = lambda spark, sf: _fit(spark, sf, dates=["c_date"]).transform(items(spark, sf), ["key"]).select("key", "date__c_date_year")
ORACLE["impute_const"] = sql("SELECT key, CAST(coalesce(year(TRY_CAST(c_date AS DATE)), -1) AS INTEGER) AS date__c_date_year FROM fx_items")
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _long(df, prefix):
    """Feature columns as (key, feature, value), zeros left out, so that names are data."""
    names = [c for c in df.columns if c.startswith(prefix)]
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), q(c).cast("int").alias("value")) for c in names])
    return df.select("key", F.inline(cells)).filter("value <> 0")


def _transformed(spark, sf, **groups):
    return _fit(spark, sf, **groups).transform(items(spark, sf), ["key"])


QUERIES["one_hot"] = lambda spark, sf: _long(_transformed(spark, sf, one_hot=["c_onehot"]), "onehot__")
ORACLE["one_hot"] = sql(f"SELECT key, 'onehot__c_onehot_' || coalesce(c_onehot, {MODE}) AS feature, 1 AS value FROM fx_items")
QUERIES["date_parts"] = lambda spark, sf: _transformed(spark, sf, dates=["c_date", "extract_date"])
ORACLE["date_parts"] = sql("""
SELECT key, CAST(coalesce(year(TRY_CAST(c_date AS DATE)), -1) AS INTEGER) AS date__c_date_year, CAST(coalesce(month(TRY_CAST(c_date AS DATE)), -1) AS INTEGER) AS date__c_date_month,
       CAST(year(extract_date) AS INTEGER) AS date__extract_date_year, CAST(month(extract_date) AS INTEGER) AS date__extract_date_month FROM fx_items""")
QUERIES["top_k_encode"] = lambda spark, sf: _long(_transformed(spark, sf, top_k=["c_topk"]), "topk__")
ORACLE["top_k_encode"] = sql("""
SELECT key, 'topk__c_topk_' || CASE WHEN c_topk IN (SELECT c_topk FROM fx_items GROUP BY 1 ORDER BY count(*) DESC, c_topk LIMIT 10) THEN c_topk ELSE 'Other' END AS feature,
       1 AS value FROM fx_items""")


def _frequency(spark, sf, limit=encode.HOT_ROWS):
    rows = items(spark, sf)
    shares = encode.frequencies(value_counts(rows, ["c_high", "c_onehot"]))
    for c in ("c_high", "c_onehot"):
        rows = encode.join_frequency(rows, shares, c, f"{c}_share", limit)
    return rows.select("key", *[F.round(f"{c}_share", 9).alias(f"{c}_share") for c in ("c_high", "c_onehot")])


QUERIES["frequency_encode"] = _frequency
ORACLE["frequency_encode"] = sql("""
SELECT key, round(count(c_high) OVER (PARTITION BY c_high) / (count(c_high) OVER ())::DOUBLE, 9) AS c_high_share,
       round(count(c_onehot) OVER (PARTITION BY c_onehot) / (count(c_onehot) OVER ())::DOUBLE, 9) AS c_onehot_share FROM fx_items""")
QUERIES["frequency_encode_spread"] = lambda spark, sf: _frequency(spark, sf, 500)
ORACLE["frequency_encode_spread"] = ORACLE["frequency_encode"]
QUERIES["tag_binarize"] = lambda spark, sf: _long(_transformed(spark, sf, tag_binarize=["t_bin"]), "ml_binarize__")
ORACLE["tag_binarize"] = sql(
    "SELECT DISTINCT key, 'ml_binarize__t_bin_' || tag AS feature, 1 AS value FROM (SELECT key, trim(unnest(string_split(t_bin, '#'))) AS tag FROM fx_items) t WHERE tag <> ''")
QUERIES["tag_top_k"] = lambda spark, sf: _long(_transformed(spark, sf, tag_top_k=["t_topk"]), "ml_topk__")
ORACLE["tag_top_k"] = with_views("", "fx_items").rstrip() + """,
pieces AS (SELECT key, trim(unnest(string_split(t_topk, '#'))) AS tag FROM fx_items)
SELECT DISTINCT key, 'ml_topk__t_topk_' || tag AS feature, 1 AS value FROM pieces
WHERE tag IN (SELECT tag FROM pieces WHERE tag <> '' GROUP BY 1 ORDER BY count(*) DESC, tag LIMIT 10)"""
QUERIES["tag_count"] = lambda spark, sf: items(spark, sf).select("key", tag_count(F.col("t_bin")).alias("n_bin"), tag_count(F.col("t_topk")).alias("n_topk"))
ORACLE["tag_count"] = sql("""
SELECT key, CAST(len(list_filter(string_split(t_bin, '#'), lambda t: trim(t) <> '')) AS INTEGER) AS n_bin,
       CAST(len(list_filter(string_split(t_topk, '#'), lambda t: trim(t) <> '')) AS INTEGER) AS n_topk FROM fx_items""")
QUERIES["select_fill"] = lambda spark, sf: encode.select_fill(items(spark, sf), "c_onehot")
ORACLE["select_fill"] = sql("SELECT coalesce(c_onehot, '') AS c_onehot FROM fx_items")


def _null_check(spark, sf):
    rows = items(spark, sf)
    held = encode.null_columns(rows)
    return rows.agg(*[F.count(F.when(q(c).isNull(), 1)).alias(c) for c in held])


QUERIES["null_check"] = _null_check
ORACLE["null_check"] = sql("SELECT count(*) - count(c_onehot) AS c_onehot, count(*) - count(n_price) AS n_price FROM fx_items")


def _preprocess(spark, sf):
    rows = items(spark, sf)
    out = Preprocessor.fit(rows, GROUPS).transform(rows, ["key"])
    flags = [c for c in out.columns if c.startswith(("onehot__", "topk__", "ml_binarize__", "ml_topk__"))]
    return out.select(
        "key", F.round("num__n_price", 6).alias("num__n_price"), F.round("num__n_qty", 6).alias("num__n_qty"),
        F.col("date__c_date_year"), F.col("date__c_date_month"), F.round("high_card__c_high", 9).alias("high_card__c_high"),
        F.col("ml_count__t_bin"), F.col("ml_count__t_topk"), encode.total_of([q(c) for c in flags]).alias("n_flags"),
        F.lit(len(out.columns) - 1).alias("n_features"),
    )


QUERIES["preprocess"] = _preprocess
ORACLE["preprocess"] = with_views("", "fx_items").rstrip() + ",\n" + FILLED + """,
pieces AS (SELECT key, trim(unnest(string_split(t_topk, '#'))) AS tag FROM fx_items),
top_tags AS (SELECT tag FROM pieces WHERE tag <> '' GROUP BY 1 ORDER BY count(*) DESC, tag LIMIT 10),
flags AS (SELECT key, count(DISTINCT CASE WHEN tag IN (SELECT tag FROM top_tags) THEN tag END) AS n_top FROM pieces GROUP BY 1),
bins AS (SELECT trim(unnest(string_split(t_bin, '#'))) AS tag FROM fx_items)
SELECT f.key, round((f_price - avg(f_price) OVER ()) / stddev_pop(f_price) OVER (), 6) AS num__n_price,
       round((n_qty - avg(n_qty) OVER ()) / stddev_pop(n_qty) OVER (), 6) AS num__n_qty,
       CAST(coalesce(year(TRY_CAST(c_date AS DATE)), -1) AS INTEGER) AS date__c_date_year, CAST(coalesce(month(TRY_CAST(c_date AS DATE)), -1) AS INTEGER) AS date__c_date_month,
       round(count(*) OVER (PARTITION BY c_high) / (count(*) OVER ())::DOUBLE, 9) AS high_card__c_high,
       CAST(len(list_filter(string_split(t_bin, '#'), lambda t: trim(t) <> '')) AS INTEGER) AS ml_count__t_bin,
       CAST(len(list_filter(string_split(t_topk, '#'), lambda t: trim(t) <> '')) AS INTEGER) AS ml_count__t_topk,
       CAST(2 + len(list_filter(string_split(t_bin, '#'), lambda t: trim(t) <> '')) + n_top AS INTEGER) AS n_flags,
       CAST(2 + 5 + 2 + 11 + 1 + 2 + (SELECT count(DISTINCT tag) FROM bins WHERE tag <> '') + 10 AS INTEGER) AS n_features
FROM filled f JOIN flags g ON g.key = f.key"""


def _align(spark, sf):
    out = _transformed(spark, sf, one_hot=["c_onehot"], numeric=["n_qty"]).withColumn("key", F.col("key").cast("long"))
    return encode.align(out, ["onehot__c_onehot_5-LOW", "onehot__c_onehot_unseen", "key"])


QUERIES["align_features"] = _align
ORACLE["align_features"] = sql(
    f"""SELECT CASE WHEN coalesce(c_onehot, {MODE}) = '5-LOW' THEN 1 ELSE 0 END AS "onehot__c_onehot_5-LOW", 0 AS "onehot__c_onehot_unseen", key FROM fx_items""")


def _text(spark, sf):
    rows = held_fixture(spark, sf, "fx_items", ["key", "c_text"])
    return encode.text_tfidf(rows, "key", "c_text").select("key", "term", F.round("tfidf", 9).alias("tfidf"))


QUERIES["text_tfidf"] = _text
ORACLE["text_tfidf"] = with_views("", "fx_items").rstrip() + r""",
pieces AS (SELECT key, unnest(list_filter(string_split_regex(lower(c_text), '\s+'), lambda w: w <> '')) AS term FROM fx_items),
uses AS (SELECT key, term, count(*) AS uses FROM pieces GROUP BY 1, 2),
idf AS (SELECT term, ln(((SELECT count(*) FROM fx_items) + 1.0) / (count(*) + 1.0)) AS idf FROM uses GROUP BY 1)
SELECT key, term, round(uses * idf, 9) AS tfidf FROM uses JOIN idf USING (term)"""


def _text_columns(spark, sf):
    rows = items(spark, sf)
    fitted = Preprocessor.fit(rows, ColumnGroups(text=["c_text"]), text_terms=60)
    wide = fitted.transform(rows, ["key"])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), q(c).alias("value")) for c in wide.columns if c != "key"])
    return wide.select("key", F.inline(cells)).filter("value <> 0").select("key", "feature", F.round("value", 9).alias("value"))


QUERIES["text_columns"] = _text_columns
ORACLE["text_columns"] = ORACLE["text_tfidf"].split("SELECT key, term, round")[0] + """
SELECT key, 'text__c_text_' || term AS feature, round(uses * idf, 9) AS value FROM uses JOIN idf USING (term)
WHERE idf <> 0 AND term IN (SELECT term FROM uses GROUP BY 1 ORDER BY count(*) DESC, term LIMIT 60)"""
