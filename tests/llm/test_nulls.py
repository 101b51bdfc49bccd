"""Rows without an id, or with nothing at all, go through every operator on documents."""

import pytest
from frames import SCHEMA, prose
from pyspark.sql import functions as F

from ticketlens.llm import cube, decontam, langid, lattice, neardup, pfp, quality, sharding


@pytest.fixture(scope="module")
def docs(spark):
    rest = [None] * (len(SCHEMA) - 5)
    big = 2**62 + 12_345  # ids that no double holds
    rows = [
        (None, prose(1, 60), "en", "a", 1, *rest), (None, None, None, None, None, *rest), (None, "", None, "a", None, *rest),
        (big, prose(1, 60), "en", "a", 1, *rest), (big + 1, prose(2, 60), "fr", None, 1, *rest), (big + 1, prose(2, 60), "fr", None, 1, *rest),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(2).cache()


def operators(docs):
    bench = docs.select(F.col("doc_id").alias("item_id"), "text")
    return {
        "neardup": lambda: neardup.near_duplicates(docs),
        "lattice": lambda: lattice.score(docs, F.coalesce(F.col("doc_id") % 3 != 5, F.lit(True)), rounds=1),
        "sharding": lambda: sharding.shard(docs, shards=3),
        "cube": lambda: cube.mix(docs),
        "pfp": lambda: pfp.remove_repeats(docs),
        "decontam": lambda: decontam.decontaminate(docs, bench),
        "quality": lambda: quality.verdicts(docs),
        "langid": lambda: langid.predict(docs, langid.fit(docs)),
    }


@pytest.mark.parametrize("name", ["neardup", "lattice", "sharding", "cube", "pfp", "decontam", "quality", "langid"])
def test_every_row_comes_out_once(docs, name):
    ids = sorted(r["doc_id"] or 0 for r in operators(docs)[name]().collect())
    assert ids == sorted(r["doc_id"] or 0 for r in docs.collect())


def test_a_named_copy_leads_its_class(docs):
    rows = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()}
    named = 2**62 + 12_345
    assert rows[named, 56] == (named, True) and rows[None, 56] == (named, False) and rows[None, 0] == (None, True)
