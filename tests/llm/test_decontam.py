"""Benchmark matches against sliding windows in plain Python."""

import hashlib
import re
from bisect import bisect_left
from collections import Counter

import pytest
from frames import edge_docs, edge_texts, empty_docs, lower, plain, prose

from ticketlens.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def terms(text):
    return WORD.findall(lower(text))


def items():
    """A passage of the edge texts, its parts, items of few words, empty ones, copies."""
    passage = prose(2, 25)
    long_text = prose(3, 20_000, 5_000).split(" ")
    return [
        (1, passage), (10, passage.upper()), (2, " ".join(passage.split()[3:13])), (3, "größe ñandú"), (4, "1234"), (5, ""), (6, None),
        (7, "-- !"), (8, " ".join(long_text[500:540])), (9, "ab ab ab ab ab ab ab ab ab ab ab ab"), (9, "two words"),
        (11, "ab ab ab ab ab ab ab ab ab ab ab zz"), (12, prose(77, 30)),
    ]


def brute_force(rows, bench):
    windows = []
    for item, text in bench:
        t = terms(text)
        n = min(10, len(t))
        windows += [(item, n, t[k : k + n]) for k in range(len(t) - n + 1 if n else 0)]
    out = []
    for doc, text, _ in rows:
        t, hit, found = terms(text), set(), set()
        at = {}
        for k, w in enumerate(t):
            at.setdefault(w, []).append(k)
        for item, n, window in windows:
            for k in at.get(window[0], []):
                if t[k : k + n] == window:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        out.append((doc, len(t), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def found(df):
    return sorted(
        (r["doc_id"], r["n_words"], r["n_hit"], len(r["item_ids"]), hashlib.sha256(",".join(r["item_ids"]).encode()).hexdigest(), r["contaminated"])
        for r in df.collect()
    )


def bench(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "item_id long, text string, term string")


def test_matches(spark):
    docs = edge_docs(spark, edge_texts() + [prose(77, 9), prose(77, 30) + " end", "two words " * 4]).cache()
    assert found(decontam.decontaminate(docs, bench(spark, items()))) == brute_force(plain(docs), items())
    docs.unpersist()


def test_large_tables_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    docs = edge_docs(spark).cache()
    assert found(decontam.decontaminate(docs, bench(spark, items()))) == brute_force(plain(docs), items())
    docs.unpersist()


def test_empty_tables(spark):
    assert decontam.decontaminate(empty_docs(spark), bench(spark, items())).count() == 0
    rows = decontam.decontaminate(edge_docs(spark), bench(spark, [])).collect()
    assert rows and not any(r["contaminated"] for r in rows)


def test_proximity(spark):
    t = [f"w{k}" for k in range(12)]
    texts = [" ".join(t), " ".join(t[:6] + ["new"] + t[6:]), " ".join(t[:6] + ["new"] * 9 + t[6:]), " ".join(reversed(t)), "w1 w2"]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    index = decontam.build_index(docs, bench(spark, [(1, " ".join(t[1:11]))]))
    keys = {r["row_key"]: r["doc_id"] for r in index.postings.collect()}
    probes = {r["rank"]: r["q"] for r in index.probes.collect()}
    near = {keys[r["row_key"]] for r in decontam.proximity_matches(index, 2).collect()}
    gap = probes[2] - probes[1]
    at = [{w: k for k, w in enumerate(x.split())} for x in texts]
    expected = {
        d for d, a in enumerate(at)
        if f"w{1 + probes[1]}" in a and f"w{1 + probes[2]}" in a
        and abs(a[f"w{1 + probes[2]}"] - a[f"w{1 + probes[1]}"] - gap) <= 2
        and min(a[f"w{1 + probes[1]}"] - probes[1], a[f"w{1 + probes[2]}"] - probes[2]) >= 0
    }
    assert near == expected and 0 in near


def near_items(rows, bench, slop, rarest):
    """Items with a window whose rarest terms stand, in some choice of their postings, within slop of their places to each other."""
    count = Counter(w for _, text, _ in rows for w in terms(text))
    out = []
    for doc, text, _ in rows:
        at, found = {}, set()
        for k, w in enumerate(terms(text)):
            at.setdefault(w, []).append(k)
        for item, passage in bench:
            t = terms(passage)
            n = min(10, len(t))
            for s in range(len(t) - n + 1 if n else 0):
                window = t[s : s + n]
                chosen = sorted(range(n), key=lambda q: (count[window[q]], q))[:rarest]
                starts = [sorted(k - q for k in at.get(window[q], []) if k >= q) for q in chosen]
                if all(starts):
                    # a span of slop words that begins at some start and holds one of each list
                    for low in sorted(set().union(*map(set, starts))):
                        if all(bisect_left(x, low) < len(x) and x[bisect_left(x, low)] <= low + slop for x in starts):
                            found.add(str(item))
                            break
        out.append((doc, sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("rarest", [2, 3])
def test_proximity_against_brute_force(spark, rarest, monkeypatch):
    monkeypatch.setattr(decontam.build_index, "__defaults__", (*decontam.build_index.__defaults__[:-1], rarest))
    passage = terms(prose(2, 25))
    texts = ["ab x ab y ab", " ".join(passage[:12] + ["new", "words"] + passage[12:]), " ".join(reversed(passage)), "two of words", "words two", None, ""]
    docs = edge_docs(spark, [*edge_texts()[:6], *texts, texts[1]]).cache()
    bench_rows = [r for r in items() if r[0] != 8]
    found = decontam.decontaminate(docs, bench(spark, bench_rows), slop=2).collect()
    expected = near_items(plain(docs), bench_rows, 2, rarest)
    assert sorted((r["doc_id"], list(r["near_item_ids"])) for r in found) == expected and any(ids for _, ids in expected)
    assert all(set(r["item_ids"]) <= set(r["near_item_ids"]) for r in found)
    docs.unpersist()
