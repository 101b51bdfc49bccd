"""Patterns equal plain regular expressions, messages equal enumeration, links carry labels over a text."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from frames import edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketlens.llm import privacy
from ticketlens.llm.crf import FEATURES, Field, Tokens
from ticketlens.llm.queries import QUERIES

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and privacy.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1290.+-@ ()%_\nñ", max_size=60))
def test_patterns(text):
    assert privacy.base_spans(text) == plain_spans(text)


def test_patterns_on_entities():
    text = "a.b@c.de,4111 1111-1111 1111;+1 (017) 555-7713 x@y @a.b 1.2.3.4.5 256.1.1.1 00000000000255.1.1.1 +49 1 東京 b@c.d@e.f"
    assert privacy.base_spans(text) == plain_spans(text)
    assert [privacy.KINDS[k] for k, _, _ in privacy.base_spans(text)] == ["email", "email", "ip", "ip", "card", "phone"]


@pytest.mark.parametrize("text", ["x" * 400_000 + "@", "@" * 200_000, "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "9" + "#" * 300_000 + "9", "1 " * 20_000])
def test_long_texts_take_linear_time(text):
    privacy.base_spans(text)
    privacy.Labelled(text, [])


def field_with(seed):
    draw = np.random.default_rng(seed)
    f = Field(2)
    for p in f.parts():
        p += draw.normal(0, 0.7, p.shape)
    return f


def enumerated(f, t):
    """Exact marginals of the tokens by summing over all labellings and all values of the links."""
    u = f.unary(t)
    hubs = int(t.links.max(initial=-1)) + 1
    total = np.zeros_like(u)
    for y in itertools.product(range(u.shape[1]), repeat=t.n):
        base = sum(u[i, y[i]] for i in range(t.n)) + sum(f.pair[y[i - 1], y[i]] for i in range(t.n) if t.follows[i])
        weight = 0.0
        for h in itertools.product(range(len(f.link)), repeat=hubs):
            s = sum(f.shared[v] for v in h)
            s += sum(f.link[h[g]] for i, g in enumerate(t.links) if g >= 0 and f.kind[y[i]] == h[g])
            weight += np.exp(base + s)
        for i in range(t.n):
            total[i, y[i]] += weight
    return total / total.sum(axis=1, keepdims=True)


def tokens(follows, groups, seed=0):
    draw = random.Random(seed)
    return Tokens.gather([[draw.randrange(FEATURES) for _ in range(3)] for _ in follows], follows, groups)


@pytest.mark.parametrize("seed", range(4))
def test_messages_are_exact_without_loops(seed):
    f = field_with(seed)
    for follows, groups in (([0, 1, 1, 1], [None] * 4), ([0, 0, 0, 1], ["a", "a", "a", None]), ([0, 1, 0, 1], ["a", None, "a", None])):
        t = tokens(follows, groups, seed)
        assert np.allclose(np.exp(f.messages(t)["belief"]), enumerated(f, t), atol=1e-9)


def test_messages_are_close_with_loops():
    f = field_with(7)
    t = tokens([0, 1, 1, 1], ["a", "b", "a", "b"], 7)
    assert np.abs(np.exp(f.messages(t, 40)["belief"]) - enumerated(f, t)).max() < 0.1


def test_gradient_is_that_of_the_likelihood():
    f, t = field_with(2), tokens([0, 1, 1, 0, 1], [None, "a", None, None, "a"], 3)
    y = np.array([0, 1, 2, 0, 1])

    def likelihood():
        u = f.unary(t)
        size = u.shape[1]
        votes = 1  # both linked tokens are of kind 1, so the link's value is 1

        def joint(y, h):
            s = sum(u[i, y[i]] for i in range(t.n)) + sum(f.pair[y[i - 1], y[i]] for i in range(t.n) if t.follows[i]) + f.shared[h]
            return s + sum(f.link[h] for i in range(t.n) if t.links[i] >= 0 and f.kind[y[i]] == h)

        every = [joint(z, h) for z in itertools.product(range(size), repeat=t.n) for h in range(len(f.link))]
        return joint(y, votes) - np.logaddexp.reduce(every)

    found = f.gradient(t, y)
    for part, g in zip(f.parts(), found, strict=True):
        for place in [(0, 0), (1, 2), (FEATURES, 1)] if part.ndim == 2 and len(part) > 100 else [(0, 1), (1, 2), (2, 0)] if part.ndim == 2 else [(0,), (1,), (2,)]:
            before = part[place]
            part[place] = before + 1e-5
            up = likelihood()
            part[place] = before - 1e-5
            down = likelihood()
            part[place] = before
            assert abs((up - down) / 2e-5 - g[place]) < 1e-4


def phones(n):
    draw = random.Random(n)
    return f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}"


def corpus():
    draw = random.Random(4)
    makers = [
        lambda k: f"x{k}.{draw.randint(10, 99)}@mail{k % 9}.example.com", lambda k: ".".join(str(draw.randint(1, 250)) for _ in range(4)), phones,
        lambda k: next(c for c in (f"{draw.randint(10**15, 10**16 - 1)}" for _ in iter(int, 1)) if privacy.luhn(c)),
    ]
    return [f"Some words stand here {makers[k % 4](k)} and others there.\nVersion {k % 7}.0 of {k} things, number {10**15 + 37 * k}." for k in range(240)]


@pytest.fixture(scope="module")
def field():
    return privacy.learned(corpus())


def spans_of(field, text):
    base, every = next(privacy.labelled([text], field))
    return [(privacy.KINDS[k], text[a:b]) for k, a, b in every if (k, a, b) not in base]


def test_a_similar_occurrence_decides(field):
    assert spans_of(field, "Call +1 (417) 555-7713 soon. Many words later (417) 555-7713 again") == [("phone", "(417) 555-7713")]
    assert spans_of(field, "Some 97.51.17.173 stands here, far from that 97-51-17-173 stands.") == [("ip", "97-51-17-173")]
    assert spans_of(field, "Many words later (417) 555-7713 again, and 97-51-17-173 alone.") == []


def test_held_out_forms(field):
    """Of entities written in another form nearly all are found, and nearly none without their like in the text."""
    fresh = [t.replace("Some", "Other") for t in corpus()[::3]]
    right = wrong = total = 0
    for text in fresh:
        x = privacy.lesson(text)
        labels = np.array(x.labels)
        got = field.labels(Tokens.gather(x.features, x.follows, x.groups))
        total += (labels > 0).sum()
        right += ((got > 0) & (labels > 0)).sum()
        wrong += ((got > 0) & (labels == 0)).sum()
    assert right >= 0.97 * total and wrong <= 0.01 * total


def test_clean_texts_are_left_alone(field):
    assert spans_of(field, "Licensed under the Apache License, Version 2.0. See chapter 3.1, 17 pages, 1999-2004, ISBN 12345.") == []


def test_every_row_comes_out(spark):
    docs = edge_docs(spark)
    out = privacy.find(docs, privacy.fit(docs))
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in docs.collect())
    none = empty_docs(spark)
    assert privacy.find(none, privacy.fit(none)).collect() == []


def test_query_equals_the_patterns(spark, tmp_path):
    texts = [*corpus()[:40], None, "", " \n", "x@y.z " * 50, *corpus()[:3]]
    rows = [(None if k == 5 else k % 45, t, "clash") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in QUERIES["op12_skip_chain_pii"](spark, str(tmp_path)).collect())
    expected = []
    for doc_id, text, _ in rows:
        spans = plain_spans(text or "")
        listed = ",".join(f"{privacy.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        expected.append((str(doc_id), *[sum(s[0] == k for s in spans) for k in range(4)], hashlib.sha256(listed.encode()).hexdigest()))
    assert got == sorted(expected)
    kept = QUERIES["op12_skip_chain_pii"](spark, str(tmp_path)).filter(F.length("spans") > 0).count()
    assert kept >= 40
