"""Forests as node tables: cutting back and walking against plain Python on the same nodes."""

import random
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ticketlens.checks import models as checks
from ticketlens.operators import model, trees
from ticketlens.operators.model import ForestParams
from ticketlens.session import scratch_folder


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    made = []
    for k in range(400):
        x = [draw.gauss(0, 1) for _ in range(4)]
        made.append((k, "abc"[(x[0] > 0) + (x[1] + draw.gauss(0, 0.7) > 0.4)], x))
    return spark.createDataFrame(made, "key int, y string, cells array<double>").repartition(3).cache()


def nodes_of(spark, forest):
    folder = scratch_folder(spark)
    forest.write().save(folder)
    return trees.saved_nodes(spark, folder)


def tables(nodes):
    out = {}
    for r in trees.node_table(nodes).collect():
        out.setdefault(r["tree"], {})[r["id"]] = r
    return out


def leaf(tree, x, min_rows=0):
    at = tree[0]
    while at["feature"] is not None and at["rows"] >= min_rows:
        at = tree[at["left_child"] if x[at["feature"]] <= at["threshold"] else at["right_child"]]
    return at


def grown(rows, split, **more):
    params = ForestParams(n_estimators=4, max_depth=8, min_samples_split=split, min_samples_leaf=1, **more)
    return model.fit_forest(rows.select("y", array_to_vector("cells").alias("features")), ["a", "b", "c"], params)


@pytest.mark.parametrize("split", [9, 60, 1000])
def test_small_nodes_are_not_split(spark, rows, split):
    full, cut = tables(nodes_of(spark, grown(rows, 2))), tables(nodes_of(spark, grown(rows, split)))
    assert sum(map(len, cut.values())) < sum(map(len, full.values()))
    for t, tree in cut.items():
        assert sorted(tree) == list(range(len(tree)))
        assert all(n["feature"] is None or n["rows"] >= split for n in tree.values())
        for r in rows.collect():
            assert leaf(tree, r["cells"])["stats"] == leaf(full[t], r["cells"], split)["stats"]


def test_the_parameter_changes_predictions(spark, rows):
    inputs = rows.select("key", array_to_vector("cells").alias("features"))
    one, other = (
        {r["key"]: tuple(r["p"]) for r in model.forest_probabilities(grown(rows, split), inputs, "p").collect()} for split in (2, 80)
    )
    assert sum(one[k] != other[k] for k in one) > 100


def test_walking_the_table_gives_the_model_s_probabilities(spark, rows):
    forest = grown(rows, 12)
    scored = forest.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol("v").transform(rows.select("key", array_to_vector("cells").alias("features")))
    expected = {r["key"]: r["p"] for r in scored.select("key", vector_to_array("v").alias("p")).collect()}
    nodes = trees.node_table(nodes_of(spark, forest))
    walked = trees.walked_probabilities(rows.select("key", F.col("cells").alias("features")), nodes, 8)
    assert {r["key"]: r["p"] for r in walked.collect()} == {k: pytest.approx(p) for k, p in expected.items()}


def test_regression_trees(spark, rows):
    numbers = rows.select(F.col("cells")[0].alias("y"), array_to_vector("cells").alias("features"))
    fitted = [model.fit_forest(numbers, None, ForestParams(n_estimators=2, max_depth=6, min_samples_split=s, min_samples_leaf=1)) for s in (2, 90)]
    small = [sum(len(t) for t in tables(nodes_of(spark, f)).values()) for f in fitted]
    assert small[1] < small[0]
    assert fitted[1].transform(numbers).agg(F.corr("y", "prediction")).first()[0] > 0.8


@pytest.mark.parametrize("at_once", [300, 1_000_000])
def test_a_forest_in_groups_is_all_its_trees(spark, rows, monkeypatch, at_once):
    monkeypatch.setattr(model, "NODES_AT_ONCE", at_once)
    inputs = rows.select("key", "y", array_to_vector("cells").alias("features"))
    forest = model.fit_grouped_forest(inputs, ["a", "b", "c"], ForestParams(n_estimators=11, max_depth=7, min_samples_split=12, min_samples_leaf=2))
    own = [list(tables(trees.saved_nodes(spark, p)).values()) for p in forest.paths]
    assert sum(forest.trees) == 11 and forest.trees == [len(g) for g in own] and forest.nodes == [sum(map(len, g)) for g in own]
    assert (len(forest.parts()) > 1) == (at_once < 1_000_000) and sum(forest.parts(), []) == list(range(len(own)))
    every = [t for g in own for t in g]
    assert all(n["feature"] is None or n["rows"] >= 12 for t in every for n in t.values())
    # no tree comes twice
    assert len({tuple((n["feature"], n["threshold"]) for _, n in sorted(t.items())) for t in every}) == 11
    found = {r["key"]: r["p"] for r in model.forest_probabilities(forest, inputs, "p").collect()}
    for r in rows.collect():
        stats = [leaf(t, r["cells"])["stats"] for t in every]
        assert found[r["key"]] == pytest.approx([sum(s[c] / sum(s) for s in stats) / 11 for c in range(3)])


def test_groups_fit_the_nodes_held_at_once():
    params = ForestParams()
    for nodes in (10, 3_000, 25_000, 400_000, 5_000_000):
        groups, most = model.tree_groups(params, nodes)
        assert sum(g.n_estimators for g in groups) == 300 and len({g.random_state for g in groups}) == len(groups)
        assert most * nodes * max(g.n_estimators for g in groups) <= max(model.NODES_AT_ONCE, nodes)
        assert {replace(g, n_estimators=300, random_state=42) for g in groups} == {params}


def test_the_query_grows_the_whole_default_forest(spark, rows, monkeypatch):
    asked, grown = [], []
    inputs = rows.select("key", "y", array_to_vector("cells").alias("features")).cache()
    monkeypatch.setattr(checks, "Once", lambda *_: SimpleNamespace(items=lambda: rows, live=lambda: None))
    monkeypatch.setattr(model, "fit_features", lambda df, y, key, ref, params: (asked.append(params), inputs))
    real = model.RandomForestClassifier
    monkeypatch.setattr(model, "RandomForestClassifier", lambda **p: (grown.append(p), real(**p))[1])
    out = checks.QUERIES["random_forest"](spark, "").collect()
    assert sum(p["numTrees"] for p in grown) == 300 and {(p["maxDepth"], p["minInstancesPerNode"]) for p in grown} == {(30, 2)}
    assert [p.k_features for p in asked] == [140] and len(out) == 400
    assert all(r["sums_to_one"] and r["in_range"] and r["n_classes"] == 3 for r in out)
