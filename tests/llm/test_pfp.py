"""Removed passages against a table of all 50-byte strings."""

import hashlib

import numpy as np
import pytest
from frames import edge_docs, edge_texts, empty_docs, plain, prose

from ticketlens.llm import pfp


def brute_force(rows):
    first, out = {}, []
    ordered = sorted(rows, key=lambda r: r[0])
    for doc, text, _ in ordered:
        raw = (text or "").encode()
        for k in range(len(raw) - 49):
            first.setdefault(raw[k : k + 50], doc)
    for doc, text, _ in ordered:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < doc:
                gone[k : k + 50] = True
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(bool(g) and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def passages():
    """Shared stretches of 49 to 52 bytes, at both ends and inside, and periodic texts."""
    part = prose(9, 40).replace("\n", " ")[:52]
    texts = [prose(70 + k, 12) + part[: 49 + k % 4] + prose(90 + k, 12) for k in range(8)]
    texts += [part, part[:50], part[1:51], part + part, "ab" * 60, "ab" * 40 + "c", "a" * 49, "a" * 50, "a" * 51, "ä" * 40, "xä" * 40]
    return texts


@pytest.mark.parametrize(("block", "part"), [(pfp.BLOCK_BYTES, pfp.PART_BYTES), (4_000, 30_000)])
def test_removed_bytes(spark, block, part):
    docs = edge_docs(spark, edge_texts() + passages()).cache()
    assert found(pfp.remove_repeats(docs, block_bytes=block, part_bytes=part)) == brute_force(plain(docs))
    docs.unpersist()


def test_pieces_of_a_block_change_nothing(spark, monkeypatch):
    texts = [t for t in edge_texts() + passages() if t]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    whole = pfp.parse_block(data, bounds)
    monkeypatch.setattr(pfp, "PIECE_BYTES", 700)
    cut = pfp.parse_block(data, bounds)
    for field in ("start", "windows", "trigger", "gram", "phrase", "row"):
        assert (getattr(whole, field) == getattr(cut, field)).all()
    # every window lies in just one phrase
    windows = np.concatenate([np.arange(s, s + n) for s, n in zip(whole.start, whole.windows, strict=True)])
    expected = np.concatenate([np.arange(a, max(a, b - 49)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
    assert (np.sort(windows) == expected).all()


def test_rows_without_ids_and_repeated_ids(spark):
    same = prose(1, 40)
    docs = spark.createDataFrame(
        [(None, same + "x"), (4, same), (4, same + "y"), (None, "own " * 30)], "doc_id long, text string"
    )
    rows = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in pfp.remove_repeats(docs).collect()}
    n = len(same.encode())
    assert rows == {(None, n + 1): n, (4, n): 0, (4, n + 1): 0, (None, 120): 0}


def test_empty_table(spark):
    assert pfp.remove_repeats(empty_docs(spark)).count() == 0
