"""Model operators on a planted signal, and the jobs end to end."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ticketlens.operators import model, select, units
from ticketlens.operators.encode import Preprocessor
from ticketlens.operators.model import FeatureParams, ForestParams, TicketModel, model_versions
from ticketlens.operators.profile import ColumnGroups
from ticketlens.plans import jobs

FOREST = ForestParams(n_estimators=8, max_depth=5, min_samples_leaf=1)
FEATURES = FeatureParams(k_features=8)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        y = rng.choice(["1", "2", "8+"])
        size = {"1": 1.0, "2": 4.0, "8+": 9.0}[y] + rng.gauss(0, 1.2)
        rows.append((f"K{i}", size if i % 11 else None, rng.choice("abc"), "x#y" if y == "8+" else "x#z", rng.random(),
                     rng.choice(["Open", "Planned", "Done"]), y))
    return spark.createDataFrame(rows, "key string, size double, kind string, tags string, noise double, epic_status string, needed_lead_time string").repartition(3)


def fit_options():
    return {"features": FEATURES, "forest": FOREST, "cv": 3}


def test_calibrated_model_beats_the_majority_and_survives_saving(spark, items, tmp_path):
    fitted = TicketModel.fit(items, "needed_lead_time", "key", **fit_options())
    assert fitted.classes == ["1", "2", "8+"] and "num__size" in fitted.expected_features
    out = fitted.transform(items, ["key", "needed_lead_time"])
    probabilities = [c for c in out.columns if c.startswith("proba_")]
    assert probabilities == ["proba_1", "proba_2", "proba_8+"]
    rows = out.collect()
    for r in rows:
        p = [r[c] for c in probabilities]
        assert sum(p) == pytest.approx(1) and min(p) >= 0 and r.Proba_Max == max(p)
    assert units.metrics(out, "needed_lead_time", "predicted_lead_time").f1_weighted > 0.7
    fitted.save(f"{tmp_path}/m", spark)
    again = TicketModel.load(spark, f"{tmp_path}/m")
    assert again.expected_features == fitted.expected_features and again.forest == FOREST
    got = {r.key: r.Proba_Max for r in again.transform(items, ["key"]).collect()}
    assert got == pytest.approx({r.key: r.Proba_Max for r in rows})


def test_a_failed_save_leaves_the_model_as_it_was(spark, items, tmp_path, monkeypatch):
    path = f"{tmp_path}/m"
    assert jobs.load_if_there(spark, path) is None
    with pytest.raises(FileNotFoundError):
        TicketModel.load(spark, path)
    old = TicketModel.fit(items, "needed_lead_time", "key", **fit_options())
    old.save(path, spark)
    other = replace(old, features=replace(FEATURES, k_features=FEATURES.k_features + 1), classifier=replace(old.classifier, forests=[*old.classifier.forests[:-1], None]))
    with pytest.raises(AttributeError):  # encoder and first forests are written by then
        other.save(path, spark)
    again = jobs.load_if_there(spark, path)
    assert again.features == FEATURES and len(again.classifier.forests) == 3
    for k in range(2, 5):
        replace(old, features=replace(FEATURES, k_features=k)).save(path, spark)
        assert TicketModel.load(spark, path).features.k_features == k
    assert [r["number"] for r in model_versions(spark, path)] == [1, 2, 3, 4]
    # the newest two versions and what the failed save left
    assert len(list((tmp_path / "m" / "versions").iterdir())) == 3


def test_two_classes_and_fixed_seed(spark, items):
    two = items.filter("needed_lead_time <> '2'")
    runs = [
        {r.key: r.Proba_Max for r in TicketModel.fit(two, "needed_lead_time", "key", **fit_options()).transform(two, ["key"]).collect()}
        for _ in range(2)
    ]
    assert runs[0] == pytest.approx(runs[1])


def test_sigmoids_minimise_the_loss(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    p = rng.random(600)
    y = (rng.random(600) < 1 / (1 + np.exp(-(6 * p - 3)))).astype(int)
    held = spark.createDataFrame([(0, "ab"[c], [1 - float(v), float(v)]) for v, c in zip(p, y)], "fold int, y string, p array<double>")
    fit = model.fit_sigmoids(held, [0], ["a", "b"])[0][1]
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(a, b):
        z = a * p + b
        return np.sum(np.logaddexp(0, z) - target * z)

    here = loss(fit.slope, fit.offset)
    for da, db in [(0.05, 0), (-0.05, 0), (0, 0.05), (0, -0.05)]:
        assert here <= loss(fit.slope + da, fit.offset + db)


def test_regression(spark, items):
    rows = items.withColumn("needed_lead_time", F.regexp_replace("needed_lead_time", "\\+", "").cast("double"))
    fitted = TicketModel.fit(rows, "needed_lead_time", "key", features=FEATURES, forest=FOREST, model_type="regression")
    out = fitted.transform(rows, ["needed_lead_time"])
    assert out.agg(F.corr("needed_lead_time", "predicted_lead_time")).first()[0] > 0.8


def test_regression_on_a_target_without_equal_values(spark, items, monkeypatch):
    """Statistics stay a row per class: every target value is its own, and there are more of them than classes allowed."""
    monkeypatch.setattr(select, "MOST_CLASSES", 20)
    size = F.regexp_replace("needed_lead_time", "\\+", "").cast("double")
    rows = items.withColumn("needed_lead_time", size + F.crc32("key") / 1e11)
    assert rows.select("needed_lead_time").distinct().count() > 20
    fitted = TicketModel.fit(rows, "needed_lead_time", "key", features=FEATURES, forest=FOREST, model_type="regression")
    assert fitted.transform(rows, ["needed_lead_time"]).agg(F.corr("needed_lead_time", "predicted_lead_time")).first()[0] > 0.8
    with pytest.raises(ValueError, match="more than 20 values"):
        model.fit_features(rows, "needed_lead_time", "key")


def test_live_values_beyond_the_training_vocabulary_stay_on_the_executors(spark):
    train = spark.createDataFrame([(f"v{k % 3}", f"a#b{k % 2}") for k in range(30)], "kind string, tags string")
    live = spark.createDataFrame([(f"u{k}", f"t{k}#a") for k in range(500)] + [("v1", "b1")] * 3, "kind string, tags string")
    groups = ColumnGroups(one_hot=["kind"], tag_binarize=["tags"])
    fitted = Preprocessor.fit(train, groups)
    within = Preprocessor.fit(live, groups, within=fitted.state, most_columns=10)
    assert within.names() == ["onehot__kind_v1", "ml_binarize__tags_a", "ml_binarize__tags_b1"]
    with pytest.raises(ValueError, match="would become columns"):
        Preprocessor.fit(live, groups, most_columns=100)


def test_depth_beyond_the_deepest_tree_is_an_error():
    with pytest.raises(ValueError, match="depth 30"):
        ForestParams(max_depth=31).settings()


def test_reference_rows_limit_the_features(spark, items):
    ref = items.drop("noise").withColumn("tags", F.lit("x#z"))
    plan, _ = model.fit_features(items, "needed_lead_time", "key", ref, FeatureParams(k_features=99))
    assert not any(n.startswith(("num__noise", "ml_binarize__tags_y")) for n in plan.names) and "num__size" in plan.names


def test_jobs_end_to_end(spark, items, tmp_path):
    config = jobs.JobConfig(
        model_dir=f"{tmp_path}/models", results_dir=f"{tmp_path}/results", metrics_dir=f"{tmp_path}/metrics", ledger_path=f"{tmp_path}/ledger",
        id_column="key", row_key=("key",), cv_folds=2, calibration_folds=2, features=FEATURES, forest=FOREST,
        groups={"Early": ["Open", "Planned"], "Nobody": ["Funnel"]})
    trained = jobs.train(spark, items, items, config).collect()
    assert [r.unit_name for r in trained] == ["Early"] and trained[0].acc_oof > 0.6 and trained[0].f1w_test > 0.6
    assert trained[0].n_train + trained[0].n_test == items.filter("epic_status <> 'Done'").count()
    assert spark.read.json(f"{tmp_path}/metrics/metrics_group_early").first().cv_folds == 2

    first = jobs.predict(spark, items, config, ["size", "kind"], "2024-01-01 00:00:00")
    live = first.count()
    assert live == items.filter("epic_status <> 'Done'").count()
    assert {r.data_quality for r in first.select("data_quality").distinct().collect()} == {0.5, 1.0}
    jobs.predict(spark, items, config, None, "2024-02-01 00:00:00")
    ledger = jobs.read_ledger(spark, f"{tmp_path}/ledger")
    assert ledger.count() == live and {r[0] for r in ledger.select("last_prediction_at").distinct().collect()} == {"2024-02-01 01:00:00"}

    bands = spark.read.parquet(f"{tmp_path}/results/reports_ledger/bands")
    assert bands.agg(F.sum("n")).first()[0] == live
    trusts = [r.trust_score_v2 for r in spark.read.parquet(f"{tmp_path}/results/predictions_group_early").collect()]
    assert sorted(trusts, reverse=True) == sorted(trusts, reverse=True) and len(trusts) == live

    space = jobs.SearchSpace(k_features=(2, 8), n_estimators=(3,), max_depth=(2, 5), min_samples_leaf=(1,))
    best = jobs.tune(spark, items, items, config, space, 2).collect()
    assert len(best) == 1 and best[0].f1w > 0.5
    unit = jobs.planned(items, config)[0]
    features, forest = jobs.stored_params(spark, unit, config)
    assert features.k_features == best[0].k_features and forest.max_depth == best[0].max_depth
    assert spark.read.parquet(f"{tmp_path}/metrics/search_group_early/trials").count() == 2


def test_search_is_seeded():
    assert jobs.draws(jobs.SearchSpace(), 5, 1) == jobs.draws(jobs.SearchSpace(), 5, 1)
    assert all(f.max_depth <= 30 for _, f in jobs.draws(jobs.SearchSpace(), 50, 2))
