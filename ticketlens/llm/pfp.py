"""Repeated passages by prefix-free parsing, and their removal.

A 50-byte string is a window. Its trigger is the place in it where the rolling
hash of 16 bytes is smallest: its own bytes decide that, wherever it stands. The
windows of a text that share a trigger make a phrase, from the first byte of the
first of them to the last byte of the last, so every window of the corpus lies in
just one phrase, and equal windows lie in phrases with the same trigger string at
the same distance. The parse of a text is its sequence of phrases; the dictionary
holds each distinct phrase once, with the smallest document that has it.

The dictionary is dealt out by trigger. Each part sorts the windows of its
phrases, as deep as a window, byte group by byte group, within their trigger and
distance, so that equal windows stand side by side; the documents that the parse
gives each phrase tell the first of them. No suffix array of the dictionary or of
the parse is built, and no corpus order results: as phrases overlap, equal windows
never cross a phrase, and the parse need not be sorted. What goes back to a text are runs of
windows whose first document is smaller than its own.

Texts that equal the text of a smaller document are settled by their digest and
not parsed. The others are packed into blocks of some megabytes. A passage of
very many documents is in each block's dictionary once, so parts do not grow with
the number of its occurrences.

Defined cases: a null text is empty. Shorter texts than a window lose nothing and
take nothing. Rows that repeat a doc_id are one document to each other: neither
is smaller. Rows without an id come after all others. Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.lattice import gather
from ticketlens.llm.storage import small, stored
from ticketlens.llm.textblocks import Hasher, blocks, mix

WINDOW = 50
GRAM = 16
#: Places for the trigger in a window.
SPREAD = WINDOW - GRAM + 1
#: Bytes of text in a packed block, and bytes of phrases in a part of the dictionary.
BLOCK_BYTES = 8 << 20
PART_BYTES = 16 << 20
#: Bytes whose hashes are held at once.
PIECE_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).max
HIGH = np.uint64(0xFFFFFFFF00000000)

#: What is shuffled and stored is mostly text; a higher level costs little beside the hashing.
ZSTD_LEVEL = 6


def pack(array: np.ndarray) -> bytes:
    """Compressed bytes after their plain length."""
    raw = np.ascontiguousarray(array).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=ZSTD_LEVEL).compress(raw, asbytes=True)


def unpack(packed: bytes, dtype: type = np.uint8) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True), dtype=dtype)


@dataclass
class Parse:
    """The phrases of a block in text order: where they begin, their windows, the place of the trigger, hashes, row."""

    start: np.ndarray
    windows: np.ndarray
    trigger: np.ndarray
    gram: np.ndarray
    phrase: np.ndarray
    row: np.ndarray


def parse_block(data: np.ndarray, bounds: np.ndarray) -> Parse:
    """Parse texts that stand one after another; worked in pieces, which only whole texts or the window grid divide."""
    parts: list[Parse] = []
    hasher = Hasher()
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE_BYTES, side="right")) - 1)
        parts.append(_parse(data, bounds[at : to + 1], at, hasher))
        at = to
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return Parse(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    return Parse(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("start", "windows", "trigger", "gram", "phrase", "row")))


def _parse(whole: np.ndarray, bounds: np.ndarray, first_row: int, hasher: Hasher) -> Parse:
    base = int(bounds[0])
    data, bounds = whole[base : bounds[-1]], bounds - base
    none = np.zeros(0, dtype=np.int64)
    if len(data) < WINDOW:
        return Parse(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    sums = hasher.prefix(data)
    gram = mix((sums[GRAM:] - sums[:-GRAM]) * hasher._down[: len(sums) - GRAM])
    # the smallest hash of each window and its first place, by doubling the span: the place stands in the low half,
    # so of equal high halves the first one wins
    least = (gram & HIGH) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while span < SPREAD:
        step = min(span, SPREAD - span)
        least = np.minimum(least[step:], least[:-step])
        span += step
    place = (least & ~HIGH).astype(np.int64)
    lengths = np.diff(bounds)
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    long_ = lengths >= WINDOW
    inside[bounds[:-1][long_]] += 1
    inside[bounds[1:][long_] - WINDOW + 1] -= 1
    window = np.flatnonzero(np.cumsum(inside)[: len(place)])
    if not len(window):
        return Parse(none, none, none, none.view(np.uint64), none.view(np.uint64), none)
    trigger = place[window]
    new = np.ones(len(window), dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (window[1:] != window[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(window)))
    start, trigger = window[head], trigger[head]
    phrase = hasher.pieces(sums, start, start + count + WINDOW - 1) ^ mix((trigger - start).astype(np.uint64))
    row = np.searchsorted(bounds, start, side="right") - 1
    return Parse(start + base, count, trigger - start, gram[trigger], phrase, row + first_row)


@dataclass
class Dictionary:
    """Distinct phrases of a block in the order of their first use, by part, and which phrase uses which entry."""

    entry: np.ndarray
    first: np.ndarray
    low: np.ndarray
    high: np.ndarray
    part: np.ndarray


def dictionary(parse: Parse, ids: np.ndarray, parts: int) -> Dictionary:
    _, first, inverse = np.unique(parse.phrase, return_index=True, return_inverse=True)
    part = (parse.gram[first] % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((first, part))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    entry = rank[inverse]
    doc = ids[parse.row]
    low, high = np.full(len(order), NO_ID), np.full(len(order), np.iinfo(np.int64).min)
    np.minimum.at(low, entry, doc)
    np.maximum.at(high, entry, doc)
    return Dictionary(entry, first[order], low, high, part[order])


def unpack_block(ids: pa.Scalar, lengths: pa.Scalar, texts: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, data and bounds of a packed block."""
    own = ids.values.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = lengths.values.to_numpy(zero_copy_only=False).astype(np.int64)
    return own, unpack(texts.as_py()), np.concatenate(([0], np.cumsum(sizes)))


def pack_texts(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, ids, lengths, texts (compressed) and bytes; stored once, so that blocks stay what they are."""

    def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([np.concatenate(ids)], pa.list_(pa.int64())), pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                    pa.array([pack(np.concatenate(parts))], pa.binary()), pa.array([held], pa.int64()),
                ],
                ["ids", "lengths", "texts", "bytes"],
            )
            ids.clear(), parts.clear(), sizes.clear()
            return out

        for batch in batches:
            own = batch.column(0).fill_null(NO_ID).to_numpy()
            for block in blocks(batch.column(1), block_bytes // 4, 1 << 20):
                if held and held + len(block.data) > block_bytes:
                    yield flush()
                    held = 0
                ids.append(own[block.first : block.first + block.rows])
                parts.append(block.data.copy())
                sizes.append(np.diff(block.bounds))
                held += len(block.data)
        if ids:
            yield flush()

    packed = rows.mapInArrow(packer, "ids array<long>, lengths array<long>, texts binary, bytes long")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()))


def dictionary_rows(packed: DataFrame, parts: int) -> DataFrame:
    """part, block and entries: the distinct phrases of each block, dealt by their trigger."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, data, bounds = unpack_block(batch.column(1)[k], batch.column(2)[k], batch.column(3)[k])
                parse = parse_block(data, bounds)
                found = dictionary(parse, ids, parts)
                cuts = np.searchsorted(found.part, np.arange(parts + 1)) if parts <= len(found.part) else None
                which = np.arange(parts) if cuts is not None else np.unique(found.part)
                rows: list[bytes] = []
                used: list[int] = []
                for p in which.tolist():
                    lo, hi = (cuts[p], cuts[p + 1]) if cuts is not None else np.searchsorted(found.part, [p, p + 1])
                    if lo == hi:
                        continue
                    first = found.first[lo:hi]
                    start = parse.start[first]
                    content, _ = gather(data, start, start + parse.windows[first] + WINDOW - 1)
                    pieces = [
                        pack(parse.windows[first].astype(np.uint8)), pack(parse.trigger[first].astype(np.uint8)),
                        pack(np.diff(found.low[lo:hi], prepend=0)), pack(found.high[lo:hi] - found.low[lo:hi]), pack(content),
                    ]
                    rows.append(b"".join(len(x).to_bytes(8, "little") + x for x in pieces))
                    used.append(p)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int64()), pa.array([batch.column(0)[k].as_py()] * len(used), pa.int64()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["part", "block", "entries"],
                )

    return packed.select("block", "ids", "lengths", "texts").mapInArrow(deal, "part long, block long, entries binary")


def _split(packed: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(packed):
        size = int.from_bytes(packed[at : at + 8], "little")
        out.append(packed[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def sort_windows(data: np.ndarray, start: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that equal another one of their group: their index and a class that equal windows share.

    The windows are sorted eight bytes at a time; after each step those that stand
    alone leave, so few are sorted to the end.
    """
    groups = np.ndarray((max(len(data) - 7, 0),), dtype=">u8", buffer=np.ascontiguousarray(data), strides=(1,))
    index, cls = np.arange(len(start), dtype=np.int32), group
    for depth in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        if not len(index):
            break
        key = groups[start[index] + depth].astype(np.uint64)
        order = np.lexsort((key, cls))
        key, cls, index = key[order], cls[order], index[order]
        new = np.ones(len(index), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        cls = np.cumsum(new, dtype=np.int32) - 1
        shared = np.bincount(cls)[cls] > 1
        index, cls = index[shared], cls[shared]
    return index, cls


def first_documents(rows: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """For each block's entries of one part: runs of windows whose first document is below the greatest one of the entry."""
    hasher = Hasher()
    counts, windows, triggers, low, high, contents, phrase, gram = [], [], [], [], [], [], [], []
    for _, packed in rows:
        w, t, lo, span, content = _split(packed)
        w, t = unpack(w).astype(np.int64), unpack(t).astype(np.int64)
        lo, content = np.cumsum(unpack(lo, np.int64)), unpack(content)
        start = np.concatenate(([0], np.cumsum(w + WINDOW - 1)))
        sums = hasher.prefix(content)
        phrase.append(hasher.pieces(sums, start[:-1], start[1:]) ^ mix(t.astype(np.uint64)))
        gram.append(hasher.pieces(sums, start[:-1] + t, start[:-1] + t + GRAM))
        counts.append(len(w)), windows.append(w), triggers.append(t), contents.append(content)
        low.append(lo), high.append(lo + unpack(span, np.int64))
    windows, triggers, low, high = map(np.concatenate, (windows, triggers, low, high))
    data = np.concatenate(contents)
    start = np.concatenate(([0], np.cumsum(windows + WINDOW - 1)))[:-1]
    # the dictionary of the part: distinct phrases with their first document
    _, kept, entry = np.unique(np.concatenate(phrase), return_index=True, return_inverse=True)
    first = np.full(len(kept), NO_ID)
    np.minimum.at(first, entry, low)
    _, group, several = np.unique(np.concatenate(gram)[kept], return_inverse=True, return_counts=True)
    alike = several[group] > 1
    n = np.where(alike, windows[kept], 1)
    ends = np.cumsum(n)
    owner = np.repeat(np.arange(len(kept), dtype=np.int32), n)
    within = (np.arange(ends[-1], dtype=np.int32) - np.repeat((ends - n).astype(np.int32), n)).astype(np.uint8)
    document = first[owner]
    # only phrases that share their trigger with another one are sorted
    sorted_ = np.flatnonzero(alike[owner]).astype(np.int32)
    phrase_of = kept[owner[sorted_]]
    place = start[phrase_of].astype(np.int32) + within[sorted_]
    distance = triggers[phrase_of] - within[sorted_]
    index, cls = sort_windows(data, place, group[owner[sorted_]] * 64 + distance)
    del place, distance, phrase_of
    if len(index):
        least = np.full(cls.max() + 1, NO_ID)
        np.minimum.at(least, cls, document[sorted_[index]])
        document[sorted_[index]] = least[cls]
    # runs of windows with one first document; a phrase that was not sorted is one run
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (document[1:] != document[:-1])
    run = np.flatnonzero(new)
    run_owner, run_from, run_document = owner[run], within[run].astype(np.int64), document[run]
    run_to = np.append(within[run[1:] - 1], within[-1:])[: len(run)].astype(np.int64)
    run_to = np.where(alike[run_owner], run_to, windows[kept[run_owner]] - 1)
    run_first = np.searchsorted(run_owner, np.arange(len(kept) + 1))
    out, at = [], 0
    for (block, _), count in zip(rows, counts, strict=True):
        own = entry[at : at + count]
        many = run_first[own + 1] - run_first[own]
        local = np.repeat(np.arange(count), many)
        which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(run_first[own], many)
        earlier = run_document[which] < high[at : at + count][local]
        local, which = local[earlier], which[earlier]
        if len(local):
            pieces = [
                pack(np.diff(local, prepend=0).astype(np.uint32)), pack(run_from[which].astype(np.uint8)),
                pack(run_to[which].astype(np.uint8)), pack(run_document[which]),
            ]
            out.append((block, b"".join(len(x).to_bytes(8, "little") + x for x in pieces)))
        at += count
    return out


def _sort_part(group: pa.Table) -> pa.Table:
    rows = sorted(zip(group.column("block").to_pylist(), group.column("entries").to_pylist(), strict=True))
    found = first_documents(rows)
    return pa.table({
        "block": pa.array([b for b, _ in found], pa.int64()),
        "part": pa.array([group.column("part")[0].as_py()] * len(found), pa.int64()),
        "runs": pa.array([r for _, r in found], pa.binary()),
    })


def removed_bytes(data: np.ndarray, bounds: np.ndarray, ids: np.ndarray, parts: int, runs: list[tuple[int, bytes]]) -> np.ndarray:
    """True for each byte of a block that is covered by a window of a smaller document."""
    change = np.zeros(len(data) + 1, dtype=np.int32)
    if runs:
        parse = parse_block(data, bounds)
        found = dictionary(parse, ids, parts)
        use = np.argsort(found.entry, kind="stable")
        use_first = np.searchsorted(found.entry[use], np.arange(len(found.part) + 1))
        for part, packed in runs:
            local, low, high, document = _split(packed)
            entry = np.cumsum(unpack(local, np.uint32).astype(np.int64)) + np.searchsorted(found.part, part)
            low, high, document = unpack(low).astype(np.int64), unpack(high).astype(np.int64), unpack(document, np.int64)
            many = use_first[entry + 1] - use_first[entry]
            run = np.repeat(np.arange(len(entry)), many)
            phrase = use[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(use_first[entry], many)]
            later = document[run] < ids[parse.row[phrase]]
            run, phrase = run[later], phrase[later]
            np.add.at(change, parse.start[phrase] + low[run], 1)
            np.add.at(change, parse.start[phrase] + high[run] + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def removals(packed: DataFrame, runs: DataFrame, parts: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of the texts of all blocks."""
    gathered = runs.groupBy("block").agg(F.collect_list(F.struct("part", "runs")).alias("found"))  # at most one per part
    joined = packed.join(gathered.withColumnRenamed("block", "found_block"), F.col("block") == F.col("found_block"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, data, bounds = unpack_block(batch.column(0)[k], batch.column(1)[k], batch.column(2)[k])
                found = batch.column(3)[k].as_py() or []
                gone = removed_bytes(data, bounds, ids, parts, [(x["part"], x["runs"]) for x in found])
                starts = gone.copy()
                starts[1:] &= ~gone[:-1]
                heads = bounds[:-1][np.diff(bounds) > 0]
                starts[heads] = gone[heads]
                sums = [np.concatenate(([0], np.cumsum(x)))[bounds] for x in (gone, starts)]
                rest = data[~gone]
                left = bounds - sums[0]
                kept = [rest[a:b].tobytes() for a, b in zip(left[:-1], left[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, mask=ids == NO_ID), pa.array(np.diff(bounds)), pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])),
                        pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    return joined.select("ids", "lengths", "texts", "found").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) for each row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "*", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    copied = stored(
        rows.filter(F.col("n_bytes") >= WINDOW).groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull()).drop("n").withColumnRenamed("digest", "first_digest")
    )
    marked = rows.join(small(copied), F.col("digest") == F.col("first_digest"), "left")
    copy = F.col("first_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_id"))
    whole = marked.filter(copy).select(
        "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"), F.lit("").cast("binary").alias("kept"),
    )
    packed = pack_texts(marked.filter(~copy).select("doc_id", "text"), block_bytes)
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    # phrases repeat all but one byte of a window at their ends
    parts = max(1, math.ceil(size * (1 + 2 * WINDOW / SPREAD) / part_bytes))
    entries = dictionary_rows(packed, parts)
    runs = entries.groupBy("part").applyInArrow(_sort_part, "block long, part long, runs binary")
    return removals(packed, runs, parts).unionByName(whole)
