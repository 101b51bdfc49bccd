"""Targets by weight, balance of the draw, repeatability."""

from collections import defaultdict

import numpy as np
import pytest
from frames import edge_docs, empty_docs, plain, prose, words

from ticketlens.llm import cube


def expected_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Reshare excesses one after another, as told."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, pool, free = {}, share * sum(sizes.values()), set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if pool * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: pool * weight[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        pool -= sum(target[s] for s in over)
        free -= over
    return target


def check_mix(rows, docs):
    sizes = defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(words(text))
    targets = expected_targets(sizes)
    taken = defaultdict(int)
    assert len(rows) == len(docs)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["times"] <= 2
        taken[r["source"]] += r["times"] * r["size"]
    return targets, taken


def test_edge_rows_and_reruns(spark):
    docs = edge_docs(spark).cache()
    rows = cube.mix(docs).collect()
    check_mix(rows, plain(docs))
    again = cube.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r["doc_id"]), r["size"], r["times"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    docs.unpersist()


@pytest.mark.parametrize("block", [2_000, 40])
def test_totals_come_near_their_targets(spark, monkeypatch, block):
    monkeypatch.setattr(cube, "BLOCK_DOCS", block)
    draw = np.random.default_rng(2)
    data = [(k, prose(k, int(draw.integers(1, 90))), ["a", "b", "c", None][min(k % 7, 3)]) for k in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    targets, taken = check_mix(cube.mix(docs).collect(), data and [(a, b, c) for a, b, c in data])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 30


def test_flight_keeps_totals_and_chances():
    draw = np.random.default_rng(1)
    size = draw.integers(1, 1000, 60).astype(float)
    mean = np.zeros(60)
    for seed in range(400):
        pi = np.full(60, 0.3)
        cube.flight(pi, size, np.random.default_rng(seed))
        assert ((pi > 0) & (pi < 1)).sum() <= 2
        assert pi.sum() == pytest.approx(18) and pi @ size == pytest.approx(0.3 * size.sum())
        mean += pi / 400
    assert abs(mean - 0.3).max() < 0.12


def test_equal_sizes_and_sources_without_words(spark):
    data = [(k, "a b c", "even") for k in range(30)] + [(100 + k, None, "empty") for k in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = cube.mix(docs).collect()
    assert {r["times"] for r in rows if r["source"] == "empty"} == {0}
    assert {r["target"] for r in rows if r["source"] == "empty"} == {0.0}


def test_empty_table(spark):
    assert cube.mix(empty_docs(spark)).count() == 0


def test_small_source_beside_several_blocks(spark, monkeypatch):
    """What one long document leaves over is settled in a source of one block too, whatever the blocks of another."""
    monkeypatch.setattr(cube, "BLOCK_DOCS", 60)
    draw = np.random.default_rng(4)
    data = [(k, prose(k, int(draw.integers(20, 80))), "small") for k in range(50)]
    data += [(50, prose(50, 600), "small")]
    data += [(100 + k, prose(100 + k, int(draw.integers(20, 80))), "large") for k in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    rows = cube.mix(docs, weights=(8.0, 1.0), share=0.5).collect()
    for source in ("small", "large"):
        of = [r for r in rows if r["source"] == source]
        assert abs(sum(r["times"] * r["size"] for r in of) - of[0]["target"]) <= 1
