"""The stages of the pipeline, each against plain Python on its own input."""

from collections import Counter

import corpus_pipeline
import test_cube
import test_decontam
import test_neardup
import test_quality
import test_sharding
from frames import edge_docs, edge_texts, empty_docs, plain, prose

from ticketlens.llm import neardup, quality
from ticketlens.llm.storage import stored


def bench_dir(spark, tmp_path, rows):
    test_decontam.bench(spark, rows).select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def corpus(spark):
    texts = [t for t in edge_texts() if len(t or "") < 20_000] + [prose(500 + k, 60) for k in range(25)]
    return edge_docs(spark, texts)


def test_each_stage(spark, tmp_path):
    sf_dir = bench_dir(spark, tmp_path, test_decontam.items())
    docs = stored(corpus(spark))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = plain(docs)
        out = stored(stage(spark, docs, sf_dir))
        after = Counter((r[0], r[1]) for r in plain(out)) if name != "sharding" else None
        if name == "quality rules":
            kept = Counter((d, t) for (d, t, _), row in zip(sorted(before, key=str), sorted(before, key=str), strict=True) if verdict(row, before))
            assert after == kept
        elif name == "near-duplicates":
            expected = [d for d, _, component, _ in test_neardup.brute_force(before, 80) if d == component]
            assert sorted(d for d, _ in after.elements()) == sorted(set(expected))
        elif name == "benchmark decontamination":
            clean = {(r[0]) for r in test_decontam.brute_force(before, test_decontam.items()) if not r[5]}
            assert {d for d, _ in after} == clean and sum(after.values()) == len(clean)
        elif name == "mixing sources":
            sizes = Counter()
            for _, text, source in before:
                sizes[source] += len(test_cube.words(text))
            targets = test_cube.expected_targets(sizes)
            taken = Counter()
            for _, text, source in plain(out):
                taken[source] += len(test_cube.words(text))
            assert max(after.values()) <= 2
            assert all(abs(taken[s] - t) <= 40 for s, t in targets.items())
        else:
            rows = out.collect()
            assert len(rows) == len(before)
            test_sharding.check_laws(rows, 16)
            break
        assert out.columns == columns
        docs = out


def verdict(row, rows):
    """Is this row kept? (the limits leave these few documents to the base rule)"""
    figures = test_quality.brute_force([row], quality.Limits(line_docs=len(rows)))
    return figures[0][-1]


def test_empty_documents(spark, tmp_path):
    sf_dir = bench_dir(spark, tmp_path, [])
    docs = empty_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows
    test_sharding.check_laws(rows, 16)


def test_near_duplicates_from_80_on(spark, tmp_path):
    """Of each component at 80 one row stays, also where the links lie below the 85 of op2."""
    docs = stored(corpus(spark))
    before = plain(docs)
    survivors = [{d for d, _, c, _ in test_neardup.brute_force(before, percent) if d == c} for percent in (80, 85)]
    assert survivors[0] < survivors[1]
    after = plain(corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)))
    # texts without words are in no group
    assert sorted(d for d, text, _ in after if test_neardup.words(text)) == sorted(
        {d for d, text, _ in before if d in survivors[0] and test_neardup.words(text)}
    )


def test_quality_stage_hands_on_cleaned_texts(spark, tmp_path):
    docs = stored(spark.createDataFrame(test_quality.boilerplate(30), "doc_id long, text string, source string"))
    after = plain(corpus_pipeline.keep_quality(spark, docs, str(tmp_path)))
    assert len(after) == 30
    assert [d for d, text, _ in after if "Terms OF" in text] == [0]


def test_copies_without_ids_are_linked_and_one_stays(spark, tmp_path):
    base = prose(700, 80)
    near = base.replace(base.split(" ")[3], "other", 1)
    lone, named = prose(701, 40), prose(702, 50)
    rows = [(None, base, "a"), (None, base, "a"), (None, base.upper(), "b"), (None, near, None), (None, lone, "a"), (None, lone, "a"),
            (None, named, "a"), (7, named + " ", "a"), (None, None, "a"), (None, "", "a"), (None, None, None)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    found = neardup.near_duplicates(docs, percent=80).collect()
    assert len(found) == len(rows)
    assert {r["component_id"] for r in found} == {None, 7}
    assert sorted(Counter(r["group_id"] for r in found if r["n_shingles"]).values()) == [2, 2, 4]
    after = plain(corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)))
    assert sum(text is not None and text.lower() in (base, base.lower(), near.lower()) for _, text, _ in after) == 1
    assert [(d, t) for d, t, _ in after if t and t.strip() == named.strip()] == [(7, named + " ")]
    assert sum(t == lone for _, t, _ in after) == 1
    assert len(after) == 3 + 3  # texts without words are in no group


def test_a_hash_below_all_ids_does_not_lead_a_group(spark):
    """Two classes without ids and one with; whatever their hashes, the id names the group."""
    base = prose(710, 80)
    rows = [(2**63 - 1, base)] + [(None, " ".join([*base.split(" ")[:-1], f"end{k}"])) for k in range(12)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string"))
    found = neardup.near_duplicates(docs, percent=80).collect()
    assert {(r["component_id"], r["kept"] == (r["doc_id"] is not None)) for r in found} == {(2**63 - 1, True)}


def test_equal_rows_are_drawn_one_by_one(spark, tmp_path):
    text = prose(720, 30)
    rows = [(None, text, "a", k) for k in range(400)] + [(k, prose(800 + k, 30), "b", k) for k in range(10)]
    docs = stored(spark.createDataFrame(rows, "doc_id long, text string, source string, chunk int").repartition(5))
    out = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    sizes = Counter()
    for _, t, source, _ in rows:
        sizes[source] += len(test_cube.words(t))
    taken = Counter()
    for r in out.collect():
        taken[r["source"]] += len(test_cube.words(r["text"]))
    targets = test_cube.expected_targets(sizes)
    assert all(abs(taken[s] - t) <= 40 for s, t in targets.items())
    assert max(Counter(r["chunk"] for r in out.filter("source = 'a'").collect()).values()) <= 2
