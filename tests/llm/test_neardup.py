"""Components of near-duplicates against all pairs of full sets."""

from math import ceil, comb

import numpy as np
import pytest
from frames import edge_docs, edge_texts, empty_docs, lower, plain, prose, words

from ticketlens.llm import neardup
from ticketlens.llm.graph import components


def brute_force(rows, percent=85):
    sets = []
    for doc, text, _ in rows:
        w = words(lower(text))
        shingles = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append((doc, shingles))
    root = {doc: doc for doc, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, one) in enumerate(sets):
        for b, two in sets[:k]:
            if one and 100 * len(one & two) >= percent * len(one | two):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((doc, len(s), find(doc), find(doc) == doc) for doc, s in sets)


def found(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def chain(n, length=80):
    """Texts that drift: neighbours are linked, the ends are not."""
    text = prose(7, length).split(" ")
    out = []
    for k in range(n):
        text[k * 3 % len(text)] = f"drift{k}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("part", [neardup.PART_SHINGLES, 300])
def test_components_equal_all_pairs(spark, part):
    from frames import edge_texts

    docs = edge_docs(spark, edge_texts() + chain(30)).cache()
    assert found(neardup.near_duplicates(docs, part_shingles=part)) == brute_force(plain(docs))
    docs.unpersist()


def test_empty_table(spark):
    assert neardup.near_duplicates(empty_docs(spark)).count() == 0


def test_union_sketch_estimates():
    """Equal to the share of common values among the smallest of the union, and near the similarity."""
    draw = np.random.default_rng(3)
    values = draw.integers(1, 1 << 62, 3_000, dtype=np.uint64)
    sets = [np.unique(values[a:b]) for a, b in ((0, 2_700), (300, 3_000), (0, 40), (10, 60), (5, 9), (2_000, 2_001), (0, 2_700))]
    sketched = neardup.Sketches(sets)
    every = np.arange(len(sets))
    for a in every:
        for b, got in zip(every, sketched.estimate(a, every), strict=True):
            one, two = set(sets[a][:64].tolist()), set(sets[b][:64].tolist())
            smallest = sorted(one | two)[:64]
            assert got == pytest.approx(sum(x in one and x in two for x in smallest) / len(smallest))
    assert abs(sketched.estimate(0, every[1:2])[0] - 0.8) < 0.2


def test_components_of_long_paths(spark):
    draw = np.random.default_rng(5)
    names = draw.permutation(400)
    edges = [(int(names[k]), int(names[k + 1])) for k in range(399) if k % 100 != 99] + [(int(names[0]), int(names[7]))]
    rows = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in range(4):
        members = [int(x) for x in names[part * 100 : part * 100 + 100]]
        assert {rows[m] for m in members} == {min(members)}


def test_allowances_follow_the_threshold():
    """At 85 the given ones; elsewhere a link is as unlikely to be missed."""

    def chance(fewer, p):
        return sum(comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(fewer))

    assert neardup.allowances(85) == pytest.approx((neardup.SHARED, neardup.SLACK))
    for percent in (70, 80, 90):
        shared, slack = neardup.allowances(percent)
        assert chance(ceil(64 * shared), percent / 100) < 1e-9
        assert chance(ceil(64 * (percent / 100 - slack)), percent / 100) < 5e-6


@pytest.mark.parametrize("part", [neardup.PART_SHINGLES, 300])
def test_components_at_80(spark, part):
    docs = edge_docs(spark, edge_texts() + chain(30)).cache()
    assert found(neardup.near_duplicates(docs, percent=80, part_shingles=part)) == brute_force(plain(docs), 80)
    docs.unpersist()
