"""Work that must not be repeated: inputs joined once, probabilities counted once, texts that no feature reads, bounded tasks."""

import random
from collections import Counter
from math import log

import pytest
from pyspark.sql import functions as F

from ticketlens import fixtures
from ticketlens.operators import encode, model
from ticketlens.operators import folds as by_fold
from ticketlens.operators.model import FeatureParams


def orders_of(spark, folder):
    spark.createDataFrame(
        [(1, 7, "F", 10.0, "2024-01-02", "5-LOW"), (13, 7, "O", 20.0, "2024-02-02", "2-HIGH"), (17, None, "P", 30.0, None, None), (17, 8, "P", 30.0, "2024-02-03", "5-LOW"), (None, 1, "F", 1.0, None, "x")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string",
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")).write.parquet(f"{folder}/orders.parquet")
    spark.range(1).write.parquet(f"{folder}/customer.parquet")  # the view's text names it
    spark.createDataFrame(
        [(1, 2, 5.0), (1, 3, 40.0), (1, 2, 1.0), (13, 4, None), (13, 9, 7.0), (17, 5, 300.0), (17, None, 2.0), (None, 2, 3.0), (1, 151, 2.0)],
        "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(
        [(2, "PROMO"), (2, "SMALL"), (3, "ECONOMY"), (4, None), (5, "odd"), (151, "LARGE"), (None, "MEDIUM")], "p_partkey long, p_type string").write.parquet(f"{folder}/part.parquet")


def test_items_are_those_of_the_sql_and_lines_are_not_sorted(spark, tmp_path):
    orders_of(spark, tmp_path)
    rows = fixtures.fixture(spark, str(tmp_path), "fx_items")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert Counter(map(tuple, rows.collect())) == Counter(map(tuple, spark.sql(fixtures.VIEWS["fx_items"]).select(*rows.columns).collect()))
    assert rows.count() == 4


def test_a_query_joins_its_items_once(spark, monkeypatch):
    from ticketlens.checks import models

    joined = []
    real = fixtures.fixture
    for place in (fixtures, models):
        monkeypatch.setattr(place, "fixture", lambda *a: (joined.append(a[2]), real(*a))[1])
    assert models.QUERIES["model_io"](spark, "/root/testdata/sf0.001").filter("NOT same").isEmpty()
    assert joined == ["fx_items"]


def test_a_calibration_round_is_one_job_over_distinct_probabilities(spark):
    draw = random.Random(3)
    rows = []
    for i in range(600):
        p = draw.choice([0.1, 0.3, 0.7])
        rows.append((i % 2, "a" if draw.random() < p else "b", [p, 1 - p]))
    held = spark.createDataFrame(rows, "fold int, y string, p array<double>").repartition(5).cache()

    def jobs(rounds):
        spark.sparkContext.setJobGroup(f"rounds {rounds}", "")
        try:
            model.fit_sigmoids(held, [0, 1], ["a", "b"], rounds=rounds, tolerance=0.0)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds {rounds}"))

    jobs(1)
    assert jobs(6) - jobs(2) == 4
    fitted = model.fit_sigmoids(held, [0, 1], ["a", "b"])
    # at the minimum the residuals are 0, summed as they are and times p
    for f in (0, 1):
        own = [r for r in rows if r[0] == f]
        n = Counter(y for _, y, _ in own)
        for c, label in enumerate("ab"):
            high, low = (n[label] + 1) / (n[label] + 2), 1 / (len(own) - n[label] + 2)
            s = fitted[f][c]
            gap = [1 / (1 + 2.718281828459045 ** -(s.slope * p[c] + s.offset)) - (high if y == label else low) for _, y, p in own]
            assert abs(sum(gap)) < 1e-4 and abs(sum(g * p[c] for g, (_, _, p) in zip(gap, own))) < 1e-4


def test_chosen_cells_build_the_map_of_a_row_once(spark):
    rows = spark.sql("SELECT 'k' AS key, 'a' AS y, array(named_struct('j', 0, 'x', 2.5D), named_struct('j', 2, 'x', 1.0D)) AS entries")
    out = model._chosen_vectors(rows, "key", "y", ["p", "q", "r"], ["q", "r", "p"])
    assert "lambda" not in out._jdf.queryExecution().analyzed().toString()
    assert out.first()["features"].toArray().tolist() == [0.0, 1.0, 2.5]
    out.unpersist()


def test_long_texts_without_terms_are_not_counted(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(f"K{i}", draw.choice("ab"), draw.random(), f"a long text about the ticket number {i} of many", f"2024-01-{1 + i % 28:02d} 00:00:00.000000000000{i}", draw.choice("xyz")) for i in range(2200)]
    items = spark.createDataFrame(rows, "key string, y string, n double, said string, day string, kind string")
    folded, used = model._folded(items, "y", "key", 2, 42)
    counted = []
    real = by_fold.ValueCounts.count.__func__
    monkeypatch.setattr(by_fold.ValueCounts, "count", classmethod(lambda cls, df, columns, *a: (counted.append(list(columns)), real(cls, df, columns, *a))[1]))
    found = model.fold_scores(folded, "y", "key", used, items, FeatureParams(k_features=5))
    assert counted == [["n", "day", "kind"]] * 2
    for f, (encoder, scores) in enumerate(found):
        plan, vectors = model.fit_features(folded.filter(F.col("fold") != f).drop("fold"), "y", "key", items, FeatureParams(k_features=5))
        vectors.unpersist()
        assert encoder.state.groups == plan.encoder.state.groups and encoder.state.groups.text == ["said"] and scores.names(5) == plan.names
    counted.clear()
    model.fold_scores(folded, "y", "key", used, None, FeatureParams(k_features=5, text_terms=3))
    assert counted == [["n", "said", "day", "kind"]]
    folded.unpersist()


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_tfidf_counts_so_many_terms_a_task(spark, monkeypatch, limit):
    rows = [("a", "One two two"), ("a", "two three"), (None, "two x"), (None, "x"), ("b", None), ("c", " "), ("d", "one")]
    texts = spark.createDataFrame(rows, "key string, said string")
    monkeypatch.setattr(encode, "TERMS_AT_ONCE", 1)
    monkeypatch.setattr(encode, "HOT_ROWS", limit)
    hot_groups = encode.hot_groups
    monkeypatch.setattr(encode, "hot_groups", lambda df, keys: hot_groups(df, keys, 1) if limit == 2 else hot_groups(df, keys))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        out = encode.text_tfidf(texts, "key", "said")
        assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
        got = {(r.key, r.term): r.tfidf for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    words = [(k, (t or "").lower().split()) for k, t in rows]
    uses = Counter((k, w) for k, ws in words for w in ws)
    having = Counter(w for _, ws in words for w in set(ws))
    assert got == pytest.approx({(k, w): n * log((len(rows) + 1) / (having[w] + 1)) for (k, w), n in uses.items()})




def test_folds_and_units_are_worked_on_side_by_side(spark, monkeypatch, tmp_path):
    from threading import Barrier, BrokenBarrierError

    from ticketlens.plans import jobs

    def meeting(parties):
        """A step that goes on only once so many are at it at a time."""
        barrier, met = Barrier(parties), []

        def meet():
            try:
                barrier.wait(timeout=60)
                met.append(True)
            except BrokenBarrierError:
                met.append(False)

        return meet, met

    items = spark.createDataFrame([(f"K{i}", float(i % 7), "ab"[i % 2], "Open" if i % 3 else "Done") for i in range(120)], "key string, n double, y string, epic_status string")
    real = model.TicketModel.fit.__func__
    meet, met = meeting(2)
    monkeypatch.setattr(model.TicketModel, "fit", classmethod(lambda cls, *a, **b: (meet(), real(cls, *a, **b))[1]))
    fit = {"features": FeatureParams(k_features=2), "forest": model.ForestParams(n_estimators=2, max_depth=2), "cv": 2}
    plain = [(r.key, r.fold) for r in model.cross_predict(items.drop("epic_status"), "y", "key", 2, **fit).collect()]
    assert met == [True, True] and len(plain) == 120 and len(set(plain)) == 120
    assert [s["fold"] for s in model.cross_validate(items.drop("epic_status"), "y", "key", 2, **fit)] == [0, 1]
    meet, met = meeting(6)  # two units, of each two folds and the fit
    monkeypatch.setattr(model.TicketModel, "fit", classmethod(lambda cls, *a, **b: (meet(), real(cls, *a, **b))[1]))
    config = jobs.JobConfig(
        model_dir=f"{tmp_path}/m", metrics_dir=f"{tmp_path}/t", target="y", id_column="key", row_key=("key",), drop=("key",), cv_folds=2,
        calibration_folds=2, features=fit["features"], forest=fit["forest"], groups={"Live": ["Open"], "Past": ["Done"]})
    done = jobs.train(spark, items, items, config).collect()
    assert [r.unit_name for r in done] == [u.name for u in jobs.planned(items, config)] and met == [True] * 6
