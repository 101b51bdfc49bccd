"""Shards: even sizes, gapless slots, groups kept together as far as they fit."""

import zlib
from collections import Counter, defaultdict

from frames import edge_docs, empty_docs, plain

from ticketlens.llm import sharding


def check_laws(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(shards))
    if len(rows) >= shards:
        assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edge_rows(spark):
    docs = edge_docs(spark).cache()
    rows = sharding.shard(docs, shards=4).collect()
    check_laws(rows, 4)
    texts = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in plain(docs))
    assert texts == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    docs.unpersist()


def test_small_groups_stay_whole(spark):
    docs = spark.createDataFrame([(k, f"group {k // 4}" if k < 400 else f"alone {k}") for k in range(1000)], "doc_id long, text string")
    rows = sharding.shard(docs, shards=8).collect()
    check_laws(rows, 8)
    groups = defaultdict(set)
    for r in rows:
        if r["doc_id"] < 400:
            groups[r["doc_id"] // 4].add(r["shard"])
    assert sum(len(g) == 1 for g in groups.values()) >= 95


def test_a_group_of_half_the_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    docs = spark.createDataFrame([(k, "hot" if k % 2 else f"own {k}") for k in range(800)], "doc_id long, text string").repartition(5)
    rows = sharding.shard(docs, shards=8).collect()
    check_laws(rows, 8)
    hot = Counter(r["shard"] for r in rows if r["doc_id"] % 2)
    # it needs four shards of a hundred rows; its links are cut less than by chance
    assert sum(sorted(hot.values())[-4:]) > 300


def test_empty_table(spark):
    assert sharding.shard(empty_docs(spark), shards=4).count() == 0
