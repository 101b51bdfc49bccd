"""Mixing sources to target weights by the cube method of balanced sampling.

A source's target divided by its size says how often each of its documents is
taken: the whole part for certain, the fraction as an inclusion probability.
The flight phase moves these probabilities along the null space of the
constraints (document count and token total of the source), three documents at a
time, until at most two per block are still fractional. Those of many blocks
meet in the next, smaller round, until each source is one block; what is left
there, at most two documents per source, is landed on the combination nearest to
the token total. What a long document left over is settled by swaps within the
first block of each source, whatever rounds the other sources take.

Blocks are cut by a hash of the id, so a source of any size is many tasks, and
every block is worked in hash order with its own seed: reruns agree.

Defined cases: a null text has size 0. A null source is a source of its own, the
last. A source without words has target 0 and its documents are taken 0 times.
Repeated rows are drawn each. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.quality import word_array
from ticketlens.session import materialize

#: Documents of a block; fractional ones of so many blocks that they fill one meet in the next round.
BLOCK_DOCS = 2_000
LEFT_PER_BLOCK = 2
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Source tables up to this many rows are broadcast, larger ones joined by shuffle.
BROADCAST_SOURCES = 10_000


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, source_docs, target: `share` of all sizes by weight, no source above `most` times its size.

    Weights repeat over the sources in code-point order, null last. Resharing an
    excess by weight leaves every uncapped source with the same multiple of its
    weight, so only that multiple is sought, one aggregate per round.
    """
    totals = materialize(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    )
    # one row per source, after the aggregate
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1)
    weighed = totals.withColumn("weight", weight)
    limit = most * F.col("source_size")
    pool = (totals.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * level >= limit if capped >= 0 else F.lit(False)
        full, free, n = weighed.agg(
            F.sum(F.when(above, limit)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))), F.sum(above.cast("int"))
        ).first()
        if not free or n == capped:
            break
        level, capped = (pool - (full or 0.0)) / free, n
    return weighed.withColumn("target", F.least(limit, F.col("weight") * level)).drop("weight")


def flight(pi: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> None:
    """Move probabilities in place along the null space of (count, size) until at most two are fractional."""
    waiting = [k for k in range(len(pi) - 1, -1, -1) if 0 < pi[k] < 1]
    p, z = pi.tolist(), size.astype(float).tolist()
    coins = iter(draw.random(len(waiting) + 1).tolist())
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            break
        a, b, c = active
        step = (z[c] - z[b], z[a] - z[c], z[b] - z[a])
        if not any(step):
            step = (1.0, -1.0, 0.0)
        up = min(((1 - p[k]) if u > 0 else p[k]) / abs(u) for k, u in zip(active, step, strict=True) if u)
        down = min((p[k] if u > 0 else (1 - p[k])) / abs(u) for k, u in zip(active, step, strict=True) if u)
        move = up if next(coins, 0.5) * (up + down) < down else -down
        for k, u in zip(active, step, strict=True):
            moved = p[k] + move * u
            p[k] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved
        active = [k for k in active if 0 < p[k] < 1]
    pi[:] = p


def land(pi: np.ndarray, size: np.ndarray) -> None:
    """Round the last fractional ones together, nearest to their expected size, then to their expected number."""
    left = np.flatnonzero((pi > 0) & (pi < 1))
    choices = [np.array([(c >> k) & 1 for k in range(len(left))], dtype=float) for c in range(1 << len(left))]
    wanted, many = float(pi[left] @ size[left]), float(pi[left].sum())
    pi[left] = min(choices, key=lambda s: (abs(s @ size[left] - wanted), abs(s.sum() - many), tuple(s)))


def settle(pi: np.ndarray, free: np.ndarray, size: np.ndarray, wanted: float) -> None:
    """Swap a taken for an untaken one of the `free` documents while that brings the size nearer to `wanted`."""
    for _ in range(len(free)):
        error = float(pi @ size) - wanted
        taken, spare = free[pi[free] == 1], free[pi[free] == 0]
        if abs(error) < 0.5 or not len(taken) or not len(spare):
            return
        spare = spare[np.argsort(size[spare], kind="stable")]
        at = np.searchsorted(size[spare], size[taken] - error)
        near = np.concatenate([np.clip(at - 1, 0, len(spare) - 1), np.clip(at, 0, len(spare) - 1)])
        out = np.concatenate([taken, taken])
        rest = np.abs(error - size[out] + size[spare[near]])
        best = int(rest.argmin())
        if rest[best] >= abs(error):
            return
        pi[out[best]], pi[spare[near[best]]] = 0.0, 1.0


def _in_order(block: pa.Table, size: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests, sizes and the order of the rows; rows alike in both are interchangeable."""
    digest, weight = block.column("digest").to_numpy(), block.column(size).to_numpy().astype(float)
    return digest, weight, np.lexsort((weight, digest))


def _with_drawn(block: pa.Table, pi: str, chance: np.ndarray, order: np.ndarray) -> pa.Table:
    drawn = np.empty(len(order))
    drawn[order] = chance
    return block.set_column(block.schema.get_field_index(pi), pi, pa.array(drawn))


def _player(pi: str, size: str, landing: bool) -> Callable[[pa.Table], pa.Table]:
    def play(block: pa.Table) -> pa.Table:
        digest, weight, order = _in_order(block, size)
        chance, weight = block.column(pi).to_numpy()[order], weight[order]
        seed = int(np.bitwise_xor.reduce(digest) & 0x7FFFFFFFFFFFFFFF)
        flight(chance, weight, np.random.default_rng([seed, len(order)]))
        if landing:
            land(chance, weight)
        return _with_drawn(block, pi, chance, order)

    return play


def _settler(pi: str, size: str) -> Callable[[pa.Table], pa.Table]:
    def swap(block: pa.Table) -> pa.Table:
        _, weight, order = _in_order(block, size)
        chance, weight = block.column(pi).to_numpy()[order], weight[order]
        error = block.column("error")[0].as_py()
        settle(chance, np.arange(len(order)), weight, float(chance @ weight) - error)
        return _with_drawn(block, pi, chance, order)

    return swap


def draw_balanced(rows: DataFrame, group: str, pi: str, size: str, groups_blocks: str) -> DataFrame:
    """Replace the inclusion probabilities `pi` by 0 or 1, balanced per `group` on count and `size`.

    `groups_blocks` is the column with the first number of blocks of the row's
    group. Needs a hash column `digest`; all other columns are carried along.
    """
    blocks = rows.agg(F.max(groups_blocks)).first()[0] or 1
    done, now = [], rows.withColumn("block", F.pmod("digest", F.col(groups_blocks)).cast("long"))
    # the fractional documents of its first block settle a source
    own = (F.col("block") == 0) & (F.col(pi) > 0) & (F.col(pi) < 1)
    now = now.withColumn("own", own).withColumn("expected", F.col(pi) * F.col(size))
    schema = now.schema
    while True:
        last = blocks <= 1
        moved = materialize(now.groupBy(group, "block").applyInArrow(_player(pi, size, last), schema))
        if last:
            done.append(moved)
            break
        done.append(moved.filter((F.col(pi) == 0) | (F.col(pi) == 1)))
        merge = max(2, BLOCK_DOCS // LEFT_PER_BLOCK)
        now = moved.filter((F.col(pi) > 0) & (F.col(pi) < 1)).withColumn("block", F.floor(F.col("block") / merge))
        blocks = math.ceil(blocks / merge)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # sums in any order agree to far less than a word
    errors = out.groupBy(F.col(group).alias("error_group")).agg(
        F.round(F.sum(F.col(pi) * F.col(size)) - F.sum("expected"), 3).alias("error")
    )
    first = out.filter("own").join(errors, F.col(group).eqNullSafe(F.col("error_group"))).drop("error_group")
    settled = first.groupBy(group).applyInArrow(_settler(pi, size), first.schema).drop("error")
    return out.filter(~F.col("own")).unionByName(settled).drop("block", "own", "expected")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
) -> DataFrame:
    """One row per row: doc_id, row_key, source, size, source_size, target (of its source) and times (how often it is taken)."""
    sizes = materialize(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
            F.coalesce(F.size(word_array(F.col(text))), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.col(doc_id), F.col(text)).alias("digest"),
        ).withColumn("size", F.greatest("size", F.lit(0).cast("long")))
    )
    targets = source_targets(sizes, weights, share, most).select(
        F.col("source").alias("target_source"), "source_size", "target",
        F.ceil(F.col("source_docs") / BLOCK_DOCS).cast("long").alias("blocks"),
        F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0).alias("rate"),
    )
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    rated = sizes.join(targets, F.col("source").eqNullSafe(F.col("target_source"))).drop("target_source")
    parted = rated.withColumn("whole", F.floor("rate").cast("long")).withColumn("pi", F.col("rate") - F.col("whole"))
    drawn = draw_balanced(parted.drop("rate"), "source", "pi", "size", "blocks")
    return drawn.select(
        "doc_id", F.col("digest").alias("row_key"), "source", "size", "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("whole") + F.col("pi").cast("long")).otherwise(0).cast("long").alias("times"),
    )
