"""Held-out accuracy, defined cases and rejection."""

import math
from collections import Counter

import numpy as np
from frames import edge_docs, empty_docs, prose

import __spark_entry__ as entry
from ticketlens.llm import langid

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in entry.queries()["op10_language_id"](spark, SF_DIR).collect()}
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()
    held_out = [r for r in truth if found[r["doc_id"]]["held_out"]]
    right = sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held_out)
    assert len(found) == len(truth) and right >= 0.98 * len(held_out) > 100


def grams(text):
    """Features of a text: runs of 1 to 3 bytes of its letters in lower case, all else one blank."""
    clean = []
    for byte in text.encode():
        byte = byte + 32 if 65 <= byte <= 90 else byte
        byte = byte if byte >= 128 or 97 <= byte <= 122 else 32
        if byte != 32 or not clean or clean[-1] != 32:
            clean.append(byte)
    found = Counter()
    for n in (1, 2, 3):
        for k in range(len(clean) - n + 1):
            value = int.from_bytes(bytes(clean[k : k + n]), "big")
            found[((value + n * 0x51ED270B) * 0x9E3779B1) % 2**32 >> (32 - langid.Settings.bits)] += 1
    return found


def test_features_and_nearest_centroid_against_brute_force(spark):
    """Document frequencies, weights, cosines and rejection again, in plain Python."""
    words = {"de": "der die und größe nicht straße".split(), "en": "the and size not street".split(), "fr": "le la et été où rue".split()}
    draw = np.random.default_rng(11)
    train = [(k, " ".join(draw.choice(words[lang], 9)), lang) for k, lang in enumerate(list(words) * 12)]
    taught = train + [(100, None, "de"), (101, "the the the", None), (102, "", "fr"), (102, "", "fr")]
    model = langid.fit(spark.createDataFrame(taught, "doc_id long, text string, lang string"))
    rows = [t for t in taught if t[1] is not None and t[2] is not None]
    frequency = Counter(cell for _, text, _ in rows for cell in grams(text))
    weight = {cell: math.log((1 + len(rows)) / (1 + n)) + 1 for cell, n in frequency.items()}
    asked = [(1, "The size: NOT the street!"), (2, "die Größe und die Straße"), (3, "où et la rue"), (4, "東京都庁"), (5, "12 -- 3"),
             (6, ""), (7, None), (8, prose(5, 3000)), (9, "the die le"), (9, "the die le")]
    found = langid.predict(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    assert len(found) == len(asked)
    got = {r["doc_id"]: r for r in found}
    for doc, text in asked:
        if not any(c.isalpha() for c in text or ""):
            assert (got[doc]["lang_pred"], got[doc]["score"], got[doc]["rejected"]) == ("und", 0.0, True)
            continue
        unseen = math.log(1 + len(rows)) + 1
        vector = {cell: math.log1p(n) * weight.get(cell, unseen) for cell, n in grams(text).items()}
        length = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * float(c[cell]) for cell, v in vector.items()) / length for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert got[doc]["lang_pred"] == model.languages[model.of_centroid[best]]
        assert abs(got[doc]["score"] - max(0, cosines[best])) < 1e-5
        assert got[doc]["rejected"] == (1 - cosines[best] > model.radius[best])
    assert [got[k]["lang_pred"] for k in (1, 2, 3)] == ["en", "de", "fr"] and got[4]["rejected"]


def test_edge_rows(spark):
    docs = edge_docs(spark).cache()
    model = langid.fit(docs)
    rows = langid.predict(docs, model, keep=("doc_id", "text")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] == ("en" if letters else "und") and 0 <= r["score"] <= 1
        assert letters or (r["score"] == 0 and r["rejected"])
    docs.unpersist()


def test_far_texts_are_rejected(spark):
    draw = np.random.default_rng(6)
    some = "the cat sat on a mat and dog or fish then ran home with his old friend under big trees".split()
    train = spark.createDataFrame(
        [(k, " ".join(draw.choice(some, 12)), "en") for k in range(200)], "doc_id long, text string, lang string"
    )
    model = langid.fit(train)
    asked = spark.createDataFrame([(1, "the dog sat on the cat and the mat"), (2, "東京都庁は新宿にある")], "doc_id long, text string")
    rows = {r["doc_id"]: r["rejected"] for r in langid.predict(asked, model).collect()}
    assert rows == {1: False, 2: True}


def test_several_centroids_per_language():
    draw = np.random.default_rng(4)
    centres = np.eye(8, dtype=np.float32)[:3]
    points = np.concatenate([c + 0.05 * draw.normal(size=(50, 8)).astype(np.float32) for c in centres])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    found, radius = langid.fit_centroids(points, langid.Settings(centroids=3))
    assert sorted((found @ centres.T).argmax(axis=1).tolist()) == [0, 1, 2]
    assert ((1 - (points @ found.T).max(axis=1)) < radius.max() + 0.05).mean() > 0.98


def test_nothing_to_learn(spark):
    model = langid.fit(empty_docs(spark))
    rows = langid.predict(edge_docs(spark), model).collect()
    assert {r["lang_pred"] for r in rows} == {"und"}
    assert langid.predict(empty_docs(spark), model).count() == 0
