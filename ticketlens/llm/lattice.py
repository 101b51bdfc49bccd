"""Language-model scores from a subword lattice.

The pieces of an existing vocabulary, weighted by its scores and fitted to the
distinct training words by expectation maximisation, make a unigram model over
piece sequences. The lattice of a word has an arc for each piece that matches
somewhere and, if training holds the word, one arc for the word as a whole, with
its discounted relative frequency; the discounts are the weight of all ways
through pieces. A word's probability is the sum over all segmentations, by a
forward recursion in log space; a document is its words and one end, so its
marginal log probability is the sum over them. The probabilities of all words
and the end sum to one.

Every distinct word is scored once. Words that are more than one in
`FREQUENT_WORDS` of all tokens are at most that many, so their figures go to
every task; the others are joined by their hash.

Defined cases: a null text is empty and has the end as its only token. White
space only separates words. Rows that repeat a document get its figures each.
Any byte can be written by its own piece, so every text has a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.textblocks import BASE, BYTE_CODE, LOWER, Block, Hasher, blocks, mix, spans, sum_by_row
from ticketlens.session import materialize

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: At most so many words can each be more than 1 / FREQUENT_WORDS of all tokens; they are sent to every task.
FREQUENT_WORDS = 250_000
ROUNDS = 3
#: What each distinct training word gives to the ways through pieces.
DISCOUNT = 0.75
#: Bytes of distinct words that are segmented at once.
LATTICE_BYTES = 1 << 20
WORD_START = 0x20
SLOT_BITS = 19


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, a word start as a blank, all 256 single bytes among them; and their weights.

    Scores that are log probabilities are used as such; scores that only rank the
    pieces give the weight 1 / (rank + 10).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    scores = np.array([model.get_score(i) for i in range(model.get_piece_size())])
    ranks = np.exp(np.minimum(scores, 0)).sum() > 1.5 or scores.min() < -1000
    for i, score in enumerate(scores):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ")
        raw = bytes(LOWER[np.frombuffer(piece.encode(), dtype=np.uint8)])
        # words hold no white space, so only a leading blank can match
        if not raw or b" " in raw[1:] or any(b in raw for b in (b"\t", b"\n", b"\x0b", b"\x0c", b"\r")):
            continue
        found[raw] = found.get(raw, 0.0) + (1 / (10 - score) if ranks else float(np.exp(score)))
    least = min(found.values(), default=1.0)
    for b in range(256):
        found.setdefault(bytes([b]), least)
    return list(found), np.array(list(found.values()))


class Lattice:
    """All segmentations of many words at once, over pieces with log probabilities."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray) -> None:
        self.log_p = log_p
        prefixes: dict[bytes, int] = {}
        for piece in pieces:
            for n in range(1, len(piece)):
                prefixes.setdefault(piece[:n], -1)
        prefixes.update({piece: k for k, piece in enumerate(pieces)})
        self.longest = max(map(len, pieces))
        keys = np.array([_hash(p) for p in prefixes], dtype=np.uint64)
        # open addressing: a slot holds a prefix's hash and its piece, -1 where a prefix is no piece
        self.keys = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.value = np.full(1 << SLOT_BITS, -2, dtype=np.int32)
        for key, piece in zip(keys.tolist(), prefixes.values(), strict=True):
            at = key >> (64 - SLOT_BITS)
            while self.value[at] != -2:
                at = (at + 1) % (1 << SLOT_BITS)
            self.keys[at], self.value[at] = key, piece
        self.hasher = Hasher()

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece, -1 for a mere prefix, -2 for neither."""
        at = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        found = self.value[at]
        open_ = np.flatnonzero((found != -2) & (self.keys[at] != hashes))
        while len(open_):
            at[open_] = (at[open_] + 1) % (1 << SLOT_BITS)
            found[open_] = self.value[at[open_]]
            open_ = open_[(found[open_] != -2) & (self.keys[at[open_]] != hashes[open_])]
        return found

    def edges(self, data: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: start nodes, end offsets in the word, pieces. Word w's nodes are bounds[w] + w and on."""
        lengths = np.diff(bounds)
        word = np.repeat(np.arange(len(lengths)), lengths)
        left = np.repeat(bounds[1:], lengths) - np.arange(len(data))
        sums = self.hasher.prefix(data)
        at, out = np.arange(len(data)), []
        for n in range(1, self.longest + 1):
            at = at[left[at] >= n]
            if not len(at):
                break
            piece = self._find(self.hasher.pieces(sums, at, at + n))
            alive = piece != -2
            at, piece = at[alive], piece[alive]
            real = piece >= 0
            start = at[real]
            end = start + n - bounds[word[start]]
            order = np.argsort(end.astype(np.uint16) if lengths.max() < 65_536 else end, kind="stable")
            out.append((start[order] + word[start[order]], end[order], piece[real][order]))
        return out

    def forward(self, data: np.ndarray, bounds: np.ndarray, edges: list) -> np.ndarray:
        """Log of the summed weight of all ways to each node."""
        nodes = len(data) + len(bounds) - 1
        alpha = np.full(nodes, -np.inf)
        alpha[bounds[:-1] + np.arange(len(bounds) - 1)] = 0.0
        cuts = self._cuts(bounds, edges)
        for t in range(1, len(cuts[0]) - 1 if cuts else 0):
            for n, (start, _, piece) in enumerate(edges):
                lo, hi = cuts[n][t], cuts[n][t + 1]
                if lo < hi:
                    to = start[lo:hi] + n + 1
                    alpha[to] = np.logaddexp(alpha[to], alpha[start[lo:hi]] + self.log_p[piece[lo:hi]])
        return alpha

    @staticmethod
    def _cuts(bounds: np.ndarray, edges: list) -> list[np.ndarray]:
        longest = int(np.diff(bounds).max()) if len(bounds) > 1 else 0
        return [np.searchsorted(end, np.arange(longest + 2)) for _, end, _ in edges]

    def log_probability(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each word."""
        if len(bounds) < 2:
            return np.zeros(0)
        alpha = self.forward(data, bounds, self.edges(data, bounds))
        return alpha[bounds[1:] + np.arange(len(bounds) - 1)]

    def expected(self, data: np.ndarray, bounds: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in `counts` copies of each word."""
        total = np.zeros(len(self.log_p))
        if len(bounds) < 2:
            return total
        edges = self.edges(data, bounds)
        alpha = self.forward(data, bounds, edges)
        beta = np.full(len(alpha), -np.inf)
        last = bounds[1:] + np.arange(len(bounds) - 1)
        beta[last] = 0.0
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) + 1)
        cuts = self._cuts(bounds, edges)
        for t in range(len(cuts[0]) - 2, 0, -1):
            for n, (start, _, piece) in enumerate(edges):
                lo, hi = cuts[n][t], cuts[n][t + 1]
                if lo < hi:
                    begin, way = start[lo:hi], beta[start[lo:hi] + n + 1] + self.log_p[piece[lo:hi]]
                    beta[begin] = np.logaddexp(beta[begin], way)
                    use = np.exp(alpha[begin] + way - alpha[last[owner[begin]]]) * counts[owner[begin]]
                    total += np.bincount(piece[lo:hi], use, minlength=len(total))
        return total


def _hash(piece: bytes) -> int:
    code, up = 0, 1
    for b in piece:
        code, up = (code + int(BYTE_CODE[b]) * up) % (1 << 64), up * BASE % (1 << 64)
    raw = (code + len(piece) * 0x9E3779B97F4A7C15) % (1 << 64)
    return int(mix(np.array([raw], dtype=np.uint64))[0])


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lead: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The pieces [start, end) one after another, each after the byte `lead` if given; and their bounds."""
    extra = 0 if lead is None else 1
    lengths = ends - starts + extra
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - starts + extra, lengths)
    out = data[at] if len(data) else np.zeros(0, dtype=np.uint8)
    if lead is not None:
        out[bounds[:-1]] = lead
    return out, bounds


@dataclass
class Words:
    """The distinct words of a block in lower case, and which word of the block is which."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    inverse: np.ndarray
    per_row: np.ndarray


def distinct_words(block: Block, hasher: Hasher) -> Words:
    data = LOWER[block.data]
    starts, ends, per_row = spans(block)
    hashes, first, inverse = np.unique(hasher.pieces(hasher.prefix(data), starts, ends), return_index=True, return_inverse=True)
    return Words(data, starts[first], ends[first], hashes, inverse, per_row)


def word_types(docs: DataFrame, text: str, train: Column) -> DataFrame:
    """Each distinct word: hash (long), word (binary), n and n_train (occurrences in all and in training documents)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            taught = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for block in blocks(batch.column(0), 4 << 20):
                found = distinct_words(block, hasher)
                n = np.bincount(found.inverse, minlength=len(found.hashes))
                learnt = np.repeat(taught[block.first : block.first + block.rows], found.per_row)
                n_train = np.bincount(found.inverse[learnt], minlength=len(found.hashes))
                raw, bounds = gather(found.data, found.starts, found.ends)
                words = pa.Array.from_buffers(
                    pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.hashes.view(np.int64)), words, pa.array(n), pa.array(n_train)], ["hash", "word", "n", "n_train"]
                )

    rows = docs.select(F.col(text).alias("text"), train.alias("train"))
    types = rows.mapInArrow(count, "hash long, word binary, n long, n_train long")
    return types.groupBy("hash", "word").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train"))


def _word_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for block in blocks(column, LATTICE_BYTES, 1 << 20):
        data, bounds = gather(block.data, block.bounds[:-1], block.bounds[1:], WORD_START)
        yield block.first, data, bounds


@dataclass
class Model:
    """Piece weights, and the training counts: tokens (ends included), distinct words, ends."""

    pieces: list[bytes]
    log_p: np.ndarray
    tokens: int
    distinct: int
    ends: int

    @property
    def log10_end(self) -> float:
        return float(np.log10((self.ends + 1) / (self.tokens + 2)))

    def log10_word(self, n_train: np.ndarray, log_pieces: np.ndarray) -> np.ndarray:
        """The whole-word arc beside all ways through pieces, for the natural log probability of the latter."""
        arc = np.full(len(n_train), -np.inf)
        np.log(n_train - DISCOUNT, out=arc, where=n_train > 0)
        ways = np.log(DISCOUNT * self.distinct + 1) + log_pieces
        return (np.logaddexp(arc, ways) - np.log(self.tokens + 2)) / np.log(10)


def fit(types: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> tuple[list[bytes], np.ndarray]:
    """Fit the piece weights to all distinct training words; one row per piece reaches the driver in each round."""
    pieces, weight = read_vocabulary(vocabulary)
    taught = types.filter(F.col("n_train") > 0).select("word")
    log_p = np.log(weight / weight.sum())
    for _ in range(rounds):
        lattice = Lattice(pieces, log_p)

        def expect(batches: Iterator[pa.RecordBatch], lattice: Lattice = lattice) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(lattice.log_p))
            for batch in batches:
                for _, data, bounds in _word_blocks(batch.column(0)):
                    total += lattice.expected(data, bounds, np.ones(len(bounds) - 1))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["piece", "uses"])

        uses = np.zeros(len(pieces))
        for piece, n in taught.mapInArrow(expect, "piece int, uses double").groupBy("piece").agg(F.sum("uses")).collect():
            uses[piece] = n
        # single bytes keep a part of a use, so that no text is impossible; other unused pieces go
        single = np.array([len(p) == 1 for p in pieces])
        uses = np.where(single, uses + 0.5, uses)
        kept = np.flatnonzero(single | (uses > 1e-3))
        pieces, uses = [pieces[k] for k in kept], uses[kept]
        log_p = np.log(uses / uses.sum())
    return pieces, log_p


def score_types(types: DataFrame, model: Model) -> DataFrame:
    """hash, n_train, log10_p for each distinct word."""
    lattice = Lattice(model.pieces, model.log_p)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, data, bounds in _word_blocks(batch.column(1)):
                out[first : first + len(bounds) - 1] = lattice.log_probability(data, bounds)
            out = model.log10_word(batch.column(2).to_numpy().astype(float), out)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out)], ["hash", "n_train", "log10_p"])

    return types.select("hash", "word", "n_train").mapInArrow(score, "hash long, n_train long, log10_p double")


def score(
    docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, rounds: int = ROUNDS, frequent_words: int = FREQUENT_WORDS,
) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities) for each row."""
    types = materialize(word_types(docs, text, train))
    ends = docs.filter(train).count()
    tokens, taught, known = types.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_train"), F.lit(0)), F.count(F.when(F.col("n_train") > 0, 1))
    ).first()
    train_tokens, distinct = taught + ends, known + (ends > 0)
    base_norm = float(np.log10(train_tokens + distinct + 1))
    model = Model(*fit(types, vocabulary, rounds), train_tokens, known, ends)
    scored = score_types(types, model)

    often = F.col("n") * frequent_words > tokens
    frequent = score_types(types.filter(often), model).toPandas().sort_values("hash")
    f_hash = frequent["hash"].to_numpy(dtype=np.int64)
    f_known = frequent["n_train"].to_numpy() > 0
    f_base = np.log10(frequent["n_train"].to_numpy() + 1.0) - base_norm
    f_score = frequent["log10_p"].to_numpy()
    end_base, end_score = float(np.log10(ends + 1.0)) - base_norm, model.log10_end

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), train.alias("train"), F.xxhash64(F.col(doc_id), F.col(text)).alias("row_key"),
        F.col(text).alias("text"),
    )
    id_type = dict(rows.dtypes)["doc_id"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each row one with the sums over its end and frequent words, and one per other distinct word."""
        hasher = Hasher()
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = distinct_words(block, hasher)
                hashes = found.hashes.view(np.int64)
                at = np.minimum(np.searchsorted(f_hash, hashes), max(len(f_hash) - 1, 0))
                common = f_hash[at] == hashes if len(f_hash) else np.zeros(len(hashes), dtype=bool)
                mine = [np.where(common, x[at], 0) if len(f_hash) else np.zeros(len(hashes)) for x in (f_known, f_base, f_score)]
                sums = [sum_by_row(x[found.inverse], found.per_row) for x in mine]
                part = batch.slice(block.first, block.rows)
                none = np.zeros(block.rows, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("train"), part.column("row_key"),
                        part.column("row_key"), pa.array(none), pa.array(none + 1),
                        pa.array(found.per_row + 1), pa.array(sums[0].astype(np.int64) + (ends > 0)),
                        pa.array(sums[1] + end_base), pa.array(sums[2] + end_score),
                    ],
                    SPLIT,
                )
                row = np.repeat(np.arange(block.rows), found.per_row)
                rare = ~common[found.inverse]
                pairs, uses = np.unique(row[rare] * len(hashes) + found.inverse[rare], return_counts=True)
                owner, word = pairs // max(len(hashes), 1), pairs % max(len(hashes), 1)
                zero, blank = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(owner)), part.column("train").take(pa.array(owner)),
                        part.column("row_key").take(pa.array(owner)), pa.array(hashes[word]), pa.array(uses), pa.array(zero),
                        pa.array(zero), pa.array(zero), pa.array(blank), pa.array(blank),
                    ],
                    SPLIT,
                )

    parts = rows.mapInArrow(
        split,
        f"doc_id {id_type}, train boolean, row_key long, hash long, uses long, heads long, tokens long, known long, "
        "base double, lm double",
    )
    joined = parts.join(scored, "hash", "left")
    uses, n_train = F.col("uses"), F.coalesce("n_train", F.lit(0))
    asked = uses > 0
    summed = joined.groupBy("row_key", "doc_id", "train").agg(
        F.sum("heads").alias("heads"), F.sum("tokens").alias("tokens"),
        F.sum(F.col("known") + F.when(asked & (n_train > 0), uses).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.when(asked, uses * (F.log10(n_train + 1.0) - base_norm)).otherwise(0.0)).alias("base"),
        F.sum(F.col("lm") + F.when(asked, uses * F.col("log10_p")).otherwise(0.0)).alias("lm"),
    )
    # rows that repeat a document were added up; each gets its share
    return summed.select(
        "doc_id", "train", F.expr("tokens div heads").alias("n_tokens"), F.expr("known div heads").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("base") / F.col("heads")).alias("base_score"),
        (F.col("lm") / F.col("heads")).alias("score"), F.explode(F.array_repeat(F.lit(0), F.col("heads").cast("int"))).alias("copy"),
    ).drop("copy")


#: Columns of the rows that `score` splits documents into.
SPLIT = ["doc_id", "train", "row_key", "hash", "uses", "heads", "tokens", "known", "base", "lm"]
