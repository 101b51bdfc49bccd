"""Edges of the scoring, ledger and summary operators."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from ticketlens.functions.labels import cap_label, label_position, ordered_labels, to_quarters
from ticketlens.operators import ledger, score, summaries


def test_label_order():
    assert ordered_labels(["8+", "x", "10", "2", "8"]) == ["2", "8", "8+", "10", "x"]
    assert label_position("8+") == 8 and label_position("x") is None


def test_bands_at_their_edges(spark):
    rows = spark.createDataFrame([(v,) for v in (0.0, 0.5, 0.75, 0.9, 1.0, 1.0 + 1e-12, 1.2, -0.1, None)], "s double")
    got = [r.b for r in rows.select(score.trust_band(F.col("s")).alias("b")).collect()]
    assert got == ["Low", "Low", "Med", "High", "Very High", "Very High", None, None, None]


def test_one_probability_column(spark):
    rows = spark.createDataFrame([Row(epic_key="a", proba_1=1.0)])
    got = score.score(rows).first()
    assert (got.Proba_Max, got.top2_proba, got.top2_margin, got.proximity_score) == (1.0, 0.0, 1.0, None)


def test_absent_class_has_no_mass(spark):
    rows = spark.createDataFrame([("a", 0.5, 0.5, None)], "epic_key string, proba_1 double, proba_2 double, proba_3 double")
    got = score.score(rows).first()
    assert got.Proba_Max == 0.5 and got.top2_margin == 0.0 and got.trust_band is not None


def test_given_proba_max_is_kept(spark):
    rows = spark.createDataFrame([("a", 0.9, 0.5, 0.5)], "epic_key string, Proba_Max double, proba_1 double, proba_2 double")
    assert score.top2(rows).first().Proba_Max == 0.9


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(st.floats(0, 1), min_size=4, max_size=4).filter(lambda r: sum(r) > 0.1), min_size=1, max_size=20))
def test_measures_stay_in_range_and_match_the_formula(spark, raw):
    rows = [[x / sum(r) for x in r] for r in raw]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "epic_key int, proba_1 double, proba_2 double, proba_3 double, `proba_8+` double")
    place = [1, 2, 3, 8]
    for got in score.score(df).collect():
        p = rows[got.epic_key]
        top = p.index(max(p))
        assert got.proximity_score == pytest.approx(1 - sum(x * abs(a - place[top]) / 7 for x, a in zip(p, place)))
        assert got.local_mass_pm1 == pytest.approx(sum(p[max(0, top - 1): top + 2]))
        mu = sum(x * a for x, a in zip(p, place))
        assert got.dispersion_score == pytest.approx(1 - sum(x * (a - mu) ** 2 for x, a in zip(p, place)) / (49 / 4))
        assert got.entropy_norm == pytest.approx(min(1, -sum(x * math.log2(x) for x in p if x > 0) / 2), abs=1e-9)
        assert 0 <= got.trust_score_v2 <= 1 + 1e-9 and got.trust_band is not None


def test_upsert_new_wins_is_idempotent_and_takes_null_keys(spark):
    schema = "epic_key string, model_name string, v int"
    old = spark.createDataFrame([("a", "m", 1), ("b", "m", 1), (None, "m", 1)], schema)
    new = spark.createDataFrame([("a", "m", 2), ("a", "n", 3), (None, "m", 4)], schema)
    want = {("a", "m", 2), ("a", "n", 3), ("b", "m", 1), (None, "m", 4)}
    for unique in (False, True):
        once = ledger.upsert(old, new, old_unique=unique)
        assert {tuple(r) for r in once.collect()} == want
        assert {tuple(r) for r in ledger.upsert(once, new, old_unique=unique).collect()} == want


def test_upsert_keeps_the_last_of_a_batch_and_of_old_copies(spark):
    schema = "epic_key string, at int, v string"
    old = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("c", 1, "p"), ("c", 3, "q")], schema)
    new = spark.createDataFrame([("a", 1, "first"), ("a", 5, "last")], schema)
    got = {tuple(r) for r in ledger.upsert(old, new, order=["at"]).collect()}
    assert got == {("a", 5, "last"), ("c", 3, "q")}


def test_upsert_keeps_the_last_row_of_equal_stamps(spark):
    """Neither the greatest nor the first: the last one as the batch has it."""
    schema = "epic_key string, at int, v string"
    new = spark.createDataFrame([("a", 1, "z"), ("a", 1, "m"), ("b", 1, "q")], schema).coalesce(1)
    old = spark.createDataFrame([("a", 9, "old"), ("c", 2, "y"), ("c", 2, "b")], schema).coalesce(1)
    for order in ([], ["at"]):
        assert {r.epic_key: r.v for r in ledger.upsert(old, new, order=order).collect()} == {"a": "m", "b": "q", "c": "b"}


def test_upsert_without_keys_drops_full_copies(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    new = spark.createDataFrame([(1, "x"), (3, None), (3, None)], "a int, b string")
    assert sorted(tuple(r) for r in ledger.upsert(old, new).collect()) == [(1, "x"), (2, "y"), (3, None)]


def test_upsert_with_unequal_classes(spark):
    old = spark.createDataFrame([("a", "m", 0.4, 0.6)], "epic_key string, model_name string, proba_1 double, proba_2 double")
    new = spark.createDataFrame([("b", "m", 1.0)], "epic_key string, model_name string, proba_1 double")
    got = {r.epic_key: (r.Proba_Max, r.trust_band) for r in ledger.rescore(ledger.upsert(old, new)).collect()}
    assert got["b"] == (1.0, "Very High") and got["a"][0] == 0.6


def test_quarters_and_cap(spark):
    rows = spark.createDataFrame([(v,) for v in (None, -5, 0, 1, 90, 91, 630, 631, 5000)], "d int")
    got = [(r.q, r.c) for r in rows.select(to_quarters(F.col("d")).alias("q"), cap_label(to_quarters(F.col("d"))).alias("c")).collect()]
    assert got == [(0, "0"), (0, "0"), (0, "0"), (1, "1"), (1, "1"), (2, "2"), (7, "7"), (8, "8+"), (56, "8+")]


def test_histograms_fill_empty_buckets(spark):
    rows = spark.createDataFrame([("a", 0.55), ("b", None)], "epic_key string, trust_score_v2 double")
    assert [r.n for r in summaries.trust_histogram(rows).collect()] == [0, 1, 0, 0, 0, 0]


def test_paris_time(spark):
    rows = spark.createDataFrame([(1,)], "a int")
    assert ledger.stamp(rows, "m", "2024-01-15 23:30:00").first().last_prediction_at == "2024-01-16 00:30:00"
    assert ledger.stamp(rows).first().model_name == "default_model"
