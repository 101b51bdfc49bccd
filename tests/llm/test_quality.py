"""Figures and verdicts against counting in plain Python."""

import re
from collections import Counter, defaultdict

from frames import edge_docs, edge_texts, empty_docs, plain, prose, words
from pyspark.sql import functions as F

from ticketlens.llm import quality


def normalised(line):
    return " ".join(words(re.sub("[0-9]+", "0", line.lower())))


def brute_force(rows, limits):
    holders = defaultdict(set)
    hosts = Counter(host for _, host in {(doc, host) for doc, _, host in rows})
    for doc, text, host in rows:
        for line in (text or "").split("\n"):
            if words(line):
                holders[host, normalised(line)].add((doc, text))
    out = []
    for doc, text, host in rows:
        text = text or ""
        w = words(text)
        lines = [x for x in text.split("\n") if words(x)]
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        often = Counter(windows)
        again = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(8)}
        gone = 0
        for line in lines:
            n = len({d for d, _ in holders[host, normalised(line)]})
            first = min(d for d, t in holders[host, normalised(line)])
            if n > limits.line_docs and n > limits.line_share * hosts[host] and doc != first:
                gone += len(words(line))
        failed = len(w) < limits.min_words or 100 * len(again) > limits.repeat_percent * len(w)
        out.append((
            doc, len(w), sum(map(len, w)), sum(text.count(s) for s in quality.SYMBOLS), len(lines) - len(set(lines)), len(again), failed, gone,
            not failed and not len(w) - gone < limits.left_share * len(w),
        ))
    return sorted(out)


def found(df):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def test_edge_rows(spark):
    limits = quality.Limits(line_docs=3, line_share=0.1)
    texts = [t for t in edge_texts() if len(t or "") < 20_000] + ["a#b $c\n\na#b $c\nA 1\nA 2\n" + prose(5, 30)] * 3
    footer = "\n".join(prose(400 + k, 11).replace("\n", " ") for k in range(4))
    texts += [f"{prose(200 + k, 6)}\n{footer}\nVisits: {k}" for k in range(12)] + [prose(300 + k, 80) + "\n" + footer for k in range(4)]
    docs = edge_docs(spark, texts).cache()
    rows = found(quality.verdicts(docs, limits=limits))
    assert rows == brute_force(plain(docs), limits)
    assert any(r[7] and r[8] for r in rows) and any(r[7] and not r[6] and not r[8] for r in rows)
    docs.unpersist()


def test_rows_of_one_document_count_once(spark):
    line = "A line that stands in very many rows of one document and in one more"
    rows = [(1, f"{line}\n{prose(700 + k, 40)}", "h") for k in range(30)] + [(2, f"{line}\n{prose(699, 40)}", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality.verdicts(docs, limits=quality.Limits(line_share=0.0)).collect()
    assert len(out) == 31 and not any(r["n_removed_words"] for r in out) and all(r["kept"] for r in out)


def test_any_figure_can_be_filtered(spark):
    docs = edge_docs(spark, [t for t in edge_texts() if len(t or "") < 20_000])
    out = quality.verdicts(docs)
    rows = out.collect()
    for c in out.columns:
        value = rows[0][c]
        assert out.filter(F.col(c) == F.lit(value)).count() == sum(r[c] == value for r in rows)
    assert out.filter("not kept and not base_failed").count() == sum(not r["kept"] and not r["base_failed"] for r in rows)
    base = quality.base_figures(docs, "doc_id", "text", "source")
    assert base.filter("base_failed").count() == sum(r["base_failed"] for r in rows)


def test_long_text(spark):
    text = prose(3, 20_000, 5_000)
    docs = spark.createDataFrame([(1, text, "h"), (2, text + " " + text, "h")], "doc_id long, text string, source string")
    assert found(quality.verdicts(docs)) == brute_force([(1, text, "h"), (2, text + " " + text, "h")], quality.Limits())


def test_empty_table(spark):
    assert quality.verdicts(empty_docs(spark)).count() == 0


def boilerplate(n):
    line = "  Terms OF use,\tas of 20%02d, hold in every place "
    return [(k, f"{prose(900 + k, 60)}\n\n{line % k}\nend {prose(950 + k, 4)}", "h") for k in range(n)] + [(n, None, "h"), (3, None, "g")]


def test_cleaned_texts(spark):
    rows = boilerplate(30) + boilerplate(30)[5:6]
    schema = "doc_id long, text string, source string"
    docs = spark.createDataFrame(rows, schema)
    often = normalised("terms of use, as of 0, hold in every place")
    expected = [
        (d, t and "\n".join(x for x in t.split("\n") if d == 0 or normalised(x) != often), s) for d, t, s in rows
    ]
    assert sorted(plain(quality.cleaned(docs)), key=str) == sorted(expected, key=str)
    lost = {d: len(words(t)) - len(words(c)) for (d, t, _), (_, c, _) in zip(rows, expected, strict=True) if t}
    assert {r["doc_id"]: r["n_removed_words"] for r in quality.verdicts(docs).collect() if r["n_words"]} == lost
    assert lost[0] == 0 and set(list(lost.values())[1:]) == {10}
