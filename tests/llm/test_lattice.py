"""Lattice probabilities against enumerated segmentations, document scores against counting."""

import math
from collections import Counter

import numpy as np
import pytest
from frames import edge_docs, empty_docs, lower, plain, words
from pyspark.sql import functions as F

from ticketlens.llm import lattice


def segmentations(word, pieces):
    if not word:
        return [[]]
    return [[p, *rest] for p in pieces if word.startswith(p) for rest in segmentations(word[len(p) :], pieces)]


def packed(items):
    data = np.frombuffer(b"".join(items), dtype=np.uint8)
    return data, np.concatenate(([0], np.cumsum([len(x) for x in items])))


def test_forward_sums_all_segmentations():
    pieces = [b" ", b"a", b"b", b"ab", b" a", b"ba", b"aba", b" abab"]
    log_p = np.log(np.array([0.2, 0.1, 0.15, 0.1, 0.05, 0.2, 0.1, 0.1]))
    items = [b" abab", b" a", b" bbbbbb", b" " + b"ab" * 30, b" aabba"]
    found = lattice.Lattice(pieces, log_p).log_probability(*packed(items))
    for item, got in zip(items, found, strict=True):
        if len(item) < 20:
            ways = segmentations(item, pieces)
            assert got == pytest.approx(math.log(sum(math.exp(sum(log_p[pieces.index(p)] for p in way)) for way in ways)))
    assert np.isfinite(found).all()


def test_expected_uses():
    pieces = [b" ", b"a", b"b", b"ab", b" a"]
    log_p = np.log(np.array([0.3, 0.2, 0.2, 0.2, 0.1]))
    uses = lattice.Lattice(pieces, log_p).expected(*packed([b" aab", b" b"]), np.array([2.0, 1.0]))
    total = np.zeros(5)
    for item, n in ((b" aab", 2.0), (b" b", 1.0)):
        ways = segmentations(item, pieces)
        weight = [math.exp(sum(log_p[pieces.index(p)] for p in way)) for way in ways]
        for way, x in zip(ways, weight, strict=True):
            for p in way:
                total[pieces.index(p)] += n * x / sum(weight)
    assert uses == pytest.approx(total)


def test_vocabulary_covers_all_bytes():
    pieces, weight = lattice.read_vocabulary()
    assert {bytes([b]) for b in range(256)} <= set(pieces) and (weight > 0).all()
    assert not any(b"A" <= bytes([b]) <= b"Z" for p in pieces if len(p) > 1 for b in p)


def test_scores(spark):
    docs = edge_docs(spark).cache()
    train = F.col("doc_id") % 3 != 0
    found = lattice.score(docs, train, rounds=1, frequent_words=20).collect()
    counts, rows = Counter(), plain(docs)
    for doc, text, _ in rows:
        if doc % 3:
            counts.update([*words(lower(text)), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc, text, _ in rows:
        tokens = [*words(lower(text)), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected.append((doc, doc % 3 != 0, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    got = [(r["doc_id"], r["train"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got) == sorted(expected)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    # the same figures whichever words are sent to all tasks
    other = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lattice.score(docs, train, rounds=1).collect()}
    assert all(other[r["doc_id"], r["n_tokens"]] == pytest.approx(r["score"]) for r in found)
    docs.unpersist()


def test_word_probabilities_sum_to_one_with_the_end():
    pieces, log_p = [b" a", b" b", b"a", b"b"], np.log([0.25, 0.25, 0.3, 0.2])
    counts = {b"a": 3, b"ba": 1}
    model = lattice.Model(pieces, log_p, tokens=4 + 2, distinct=2, ends=2)
    strings = [bytes(s) for n in range(1, 15) for s in np.array(np.meshgrid(*[[97, 98]] * n)).reshape(n, -1).T.tolist()]
    ways = lattice.Lattice(pieces, log_p).log_probability(*packed([b" " + s for s in strings]))
    p = 10 ** model.log10_word(np.array([counts.get(s, 0) for s in strings], dtype=float), ways)
    assert 0.98 < p.sum() + 10**model.log10_end <= 1 + 1e-9


def test_empty_table(spark):
    assert lattice.score(empty_docs(spark), F.lit(True), rounds=1).count() == 0
