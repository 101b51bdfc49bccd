"""Statistics of all folds from one count: the same plans as fitting each training side by itself, in as many jobs for any number of folds."""

import random

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import folds as by_fold
from ticketlens.operators import model, select, units
from ticketlens.operators.model import FeatureParams


@pytest.fixture(scope="module")
def items(spark):
    draw = random.Random(11)
    rows = []
    for i in range(360):
        y = draw.choice(["1", "2", "8+"])
        size = {"1": 1.0, "2": 4.0, "8+": 9.0}[y] + draw.gauss(0, 1.5)
        rows.append((
            f"K{i}", round(size, 3) if i % 11 else (None if i % 2 else float("nan")), draw.randint(0, 6), draw.choice("abc") if i % 13 else None,
            draw.random() < 0.5 if i % 7 else None, f"M{draw.randint(1, 57)}" if i % 5 else "M1", f"customer {i % 250}", "x#y" if y == "8+" else draw.choice(["x#z", "z", "", None]),
            f"2024-0{1 + i % 9}-1{i % 3}" if i % 17 else "odd", 7.0, None, f"T{draw.randint(0, 300)}#T{draw.randint(0, 300)}", y,
        ))
    schema = "key string, size double, level int, kind string, flag boolean, month string, who string, tags string, day string, same double, gone string, many string, y string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="module")
def ref(items):
    return items.filter("y <> '2'").drop("flag").withColumn("kind", F.lit("a"))


def test_plans_equal_those_of_each_training_side(spark, items, ref):
    params = FeatureParams(k_features=9)
    rows, used = model._folded(items, "y", "key", 2, 42)
    found = model.fold_scores(rows, "y", "key", used, ref, params)
    for f, (encoder, scores) in enumerate(found):
        side = rows.filter(F.col("fold") != f).drop("fold")
        plan, vectors = model.fit_features(side, "y", "key", ref, params)
        vectors.unpersist()
        own, alone = encoder.state, plan.encoder.state
        assert own.groups == alone.groups and own.mode == alone.mode and own.categories == alone.categories and own.top_values == alone.top_values
        assert own.tag_vocabulary == alone.tag_vocabulary and own.top_tags == alone.top_tags
        assert own.fill == alone.fill and own.scale.keys() == alone.scale.keys()
        for c in own.scale:
            assert own.scale[c] == pytest.approx(alone.scale[c])
        shares = [sorted(tuple(r) for r in e.shares.select("column", "value", F.round("share", 12)).collect()) for e in (encoder, plan.encoder) if e.shares is not None]
        assert not shares or shares[0] == shares[1]
        assert scores.names(9) == plan.names


def test_statistics_equal_those_of_the_rows(spark, items):
    rows, used = model._folded(items, "y", "key", 2, 42)
    counts = by_fold.ValueCounts.count(rows, [c for c in rows.columns if c not in ("key", "y", "fold")], F.col("y"), F.col("fold"))
    fitted = by_fold.encoders(counts, by_fold.column_groups(counts, [0, 1]), [0, 1], range_rows=40)
    table = by_fold.feature_table(counts, fitted, [0, 1])
    stats = by_fold.feature_stats(counts, table, fitted, [0, 1])
    mi = by_fold.information(counts, table, stats, [0, 1])
    for f in (0, 1):
        side = fitted[f].vectors(rows.filter(F.col("fold") != f), ["key", "y"])
        plain = select.feature_stats(side, fitted[f].names(), "y")
        sparse = fitted[f].sparse(rows.filter(F.col("fold") != f), ["key", "y"])
        for a, b, c in zip(stats[f], plain, select.sparse_stats(sparse, fitted[f].names(), "y"), strict=True):
            for x in (a, c):
                assert (x.name, x.n, x.present, x.class_n, x.class_present) == (b.name, b.n, b.present, b.class_n, b.class_present)
                assert (x.mean, x.variance, x.low, x.high) == pytest.approx((b.mean, b.variance, b.low, b.high), abs=1e-9)
                assert x.class_mean == pytest.approx(b.class_mean, abs=1e-9) and x.class_variance == pytest.approx(b.class_variance, abs=1e-9)
        assert mi[f] == pytest.approx(select.sparse_information(sparse, plain, "y"), abs=1e-9)
        binned = select.mutual_info(side, plain, "y")
        assert by_fold.information(counts, table, stats, [0, 1], bins=10)[f] == pytest.approx(binned, abs=1e-9)
        assert select.sparse_information(sparse, plain, "y", bins=10) == pytest.approx(binned, abs=1e-9)


def test_jobs_do_not_grow_with_the_folds(spark, items, ref):
    def jobs(n):
        rows, used = model._folded(items, "y", "key", n, 42)
        rows.count()
        assert used == n
        spark.sparkContext.setJobGroup(f"folds {n}", "")
        try:
            model.fold_scores(rows, "y", "key", used, ref, FeatureParams(k_features=5))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
            rows.unpersist()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds {n}"))

    two, five = jobs(2), jobs(5)
    # Spark decides a few broadcasts and empty stages by size
    assert two > 20 and five <= 1.1 * two


def test_trials_share_their_encoders(spark, items, monkeypatch):
    from ticketlens.plans import jobs

    calls = {"encoders": 0, "fit": 0}
    real, fit = model.encoders, model.Preprocessor.fit.__func__
    monkeypatch.setattr(model, "encoders", lambda *a, **b: (calls.__setitem__("encoders", calls["encoders"] + 1), real(*a, **b))[1])
    monkeypatch.setattr(model.Preprocessor, "fit", classmethod(lambda cls, *a, **b: (calls.__setitem__("fit", calls["fit"] + 1), fit(cls, *a, **b))[1]))
    space = jobs.SearchSpace(k_features=(2, 6), n_estimators=(2,), max_depth=(2, 4), min_samples_leaf=(1,))
    trials = jobs.search(items, "y", "key", space, 3, 5, 2, cv=2).collect()
    assert len(trials) == 3 and calls == {"encoders": 1, "fit": 0} and max(t.f1w for t in trials) > 0.4
    # a trial is what cross-validation with its settings gives
    t = trials[0]
    forest = model.ForestParams(n_estimators=t.n_estimators, max_depth=t.max_depth, min_samples_leaf=t.min_samples_leaf, max_features=t.max_features, random_state=t.random_state)
    again = model.cross_validate(items, "y", "key", 2, 5, train_scores=False, features=FeatureParams(k_features=t.k_features), forest=forest, cv=2)
    assert t.acc == pytest.approx(sum(s["test_accuracy"] for s in again) / 2, abs=0.06)


def test_a_view_without_values(spark):
    rows = spark.createDataFrame([("a", None, 1.0, "x", 0), ("b", None, 2.0, "y", 1), ("c", "v", 3.0, "x", 1), ("d", "v", 5.0, "y", 0)], "key string, t string, n double, y string, fold int")
    found = model.fold_scores(rows, "y", "key", 2)
    assert [e.state.fill for e, _ in found] == [{"n": 2.5}, {"n": 3.0}]
    assert units.fold_count([2, 2], 5) == 2
