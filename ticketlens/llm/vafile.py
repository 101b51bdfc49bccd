"""Centroid clustering of vectors over a VA-file.

Each component of a vector becomes an integer, and its place among a few cells of
its dimension a code of some bits: the approximation, an eighth of the vector or
less. Per centroid, dimension and cell a lookup table holds the least and the
greatest squared difference; their sums over the dimensions enclose the distance.
A vector whose interval for one centroid lies below all others belongs there;
only where intervals overlap are full vectors fetched and compared exactly.

The first round adds up all vectors. A later one scans the approximations alone,
under the centroids of the round before and the present ones, and fetches what
overlaps under either or has moved; the sums of the clusters change by those. The
last pass reads all vectors once, as each needs its exact distance. All numbers
are integers, so results don't depend on partitions, and the cells only decide
how much is fetched.

Defined cases: a row without a vector, with another number of components, with a
null or non-finite one, or with one beyond `REACH` (its squared distance would not
fit in a long) is left out. A null vec_id counts as the empty text in the order of
the start and stays null. Repeated rows count each. With fewer vectors than
centroids there are as many centroids as vectors; without any, no rows. Ties go to
the centroid with the smaller number. An inertia beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.storage import small, stored

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
BITS = 4
#: Integers up to this size: squared distances over 64 dimensions stay within a long.
REACH = 1 << 27
#: Vectors that are compared exactly at once.
BLOCK = 1024


def integers(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """row_id, vec_id and vector (integers) of the rows that have a whole vector."""
    e = F.col("embedding")
    x = F.transform(e, lambda v: v.cast("double") * scale)
    fits = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < REACH), F.lit(False)))
    kept = rows.select("vec_id", "embedding").filter((F.size(e) == dimensions) & fits)
    return kept.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", F.transform(x, lambda v: F.floor(v).cast("int")).alias("vector"))


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimensions)


@dataclass
class Grid:
    """The cells: `edges` between those of a dimension, `low` and `high` their smallest and greatest integer."""

    bits: int
    edges: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, vectors: DataFrame, bits: int = BITS, dimensions: int = DIMENSIONS) -> Grid:
        """Cells that would hold equally many values of a normal distribution, from the moments and limits of all vectors."""

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                if batch.num_rows:
                    v = matrix(batch.column(0), dimensions)
                    f = v.astype(np.float64)
                    now = [np.full(dimensions, float(len(v))), f.sum(axis=0), (f * f).sum(axis=0), v.min(axis=0), v.max(axis=0)]
                    sums = now if sums is None else [*map(np.add, sums[:3], now[:3]), np.minimum(sums[3], now[3]), np.maximum(sums[4], now[4])]
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), *map(pa.array, sums)], ["d", "n", "s", "q", "low", "high"])

        parts = vectors.select("vector").mapInArrow(moments, "d int, n double, s double, q double, low long, high long")
        rows = parts.groupBy("d").agg(F.sum("n"), F.sum("s"), F.sum("q"), F.min("low"), F.max("high")).orderBy("d").collect()  # a row per dimension
        n, s, q, low, high = (np.array([r[i] for r in rows]) for i in range(1, 6))
        mean = s / n
        deviation = np.sqrt(np.maximum(q / n - mean * mean, 0))
        steps = np.array([NormalDist().inv_cdf(j / (1 << bits)) for j in range(1, 1 << bits)])
        edges = np.floor(mean[:, None] + deviation[:, None] * steps).astype(np.int64)
        first, last = low.astype(np.int64)[:, None], high.astype(np.int64)[:, None]
        return cls(bits, edges, np.hstack([first, np.maximum(edges + 1, first)]), np.hstack([np.minimum(edges, last), last]))

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each component."""
        return np.stack([np.searchsorted(e, vectors[:, d], side="left") for d, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def pack(self, codes: np.ndarray) -> list[bytes]:
        per = 8 // self.bits
        padded = np.zeros((len(codes), -(-codes.shape[1] // per) * per), dtype=np.uint8)
        padded[:, : codes.shape[1]] = codes
        packed = np.zeros((len(codes), padded.shape[1] // per), dtype=np.uint8)
        for i in range(per):
            packed |= padded[:, i::per] << np.uint8(i * self.bits)
        return [row.tobytes() for row in packed]

    def unpack(self, column: pa.Array) -> np.ndarray:
        per, n = 8 // self.bits, len(column)
        packed = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(n, -1)
        codes = np.empty((n, packed.shape[1] * per), dtype=np.uint8)
        for i in range(per):
            codes[:, i::per] = (packed >> np.uint8(i * self.bits)) & np.uint8((1 << self.bits) - 1)
        return codes[:, : len(self.edges)]


class Bounds:
    """The lookup tables of some centroids."""

    def __init__(self, grid: Grid, centroids: np.ndarray):
        self.centroids = centroids
        c = centroids.T[:, None, :]
        below, above = c - grid.low[:, :, None], c - grid.high[:, :, None]
        self.least = np.maximum(np.maximum(-below, above), 0) ** 2
        self.most = np.maximum(np.abs(below), np.abs(above)) ** 2

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """Per row and centroid: may it be the nearest one?"""
        least = np.zeros((len(codes), len(self.centroids)), dtype=np.int64)
        most = np.zeros_like(least)
        for d in range(codes.shape[1]):
            least += self.least[d][codes[:, d]]
            most += self.most[d][codes[:, d]]
        return least <= most.min(axis=1, keepdims=True)

    def nearest(self, codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid; vectors are looked at only where several may be it."""
        possible = self.candidates(codes)
        out = possible.argmax(axis=1)
        several = np.flatnonzero(possible.sum(axis=1) > 1)
        for at in range(0, len(several), BLOCK):
            rows = several[at : at + BLOCK]
            distance = ((vectors[rows][:, None, :] - self.centroids) ** 2).sum(axis=2)
            out[rows] = np.where(possible[rows], distance, np.iinfo(np.int64).max).argmin(axis=1)
        return out


def approximated(vectors: DataFrame, grid: Grid) -> DataFrame:
    """The vectors with `cells`, their approximation; written, so that later passes read the columns they need."""
    dimensions = len(grid.edges)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = grid.pack(grid.codes(matrix(batch.column(2), dimensions)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.binary())], ["row_id", "vec_id", "vector", "cells"])

    kind = dict(vectors.dtypes)["vec_id"]
    return stored(vectors.select("row_id", "vec_id", "vector").mapInArrow(coded, f"row_id long, vec_id {kind}, vector array<int>, cells binary"))


def to_fetch(table: DataFrame, grid: Grid, before: np.ndarray, now: np.ndarray) -> DataFrame:
    """row_id of the vectors that the approximation can't place under both sets of centroids, or that have moved."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new = Bounds(grid, before), Bounds(grid, now)
        for batch in batches:
            if batch.num_rows:
                codes = grid.unpack(batch.column(1))
                a, b = old.candidates(codes), new.candidates(codes)
                stays = (a.sum(axis=1) == 1) & (b.sum(axis=1) == 1) & (a.argmax(axis=1) == b.argmax(axis=1))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(~stays))], ["row_id"])

    return table.select("row_id", "cells").mapInArrow(scan, "row_id long")


def cluster_sums(rows: DataFrame, grid: Grid, before: np.ndarray | None, now: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Count and sum of each cluster under `now`, less those under `before` if there are any; rows have cells and vector."""
    k, dimensions = len(now), len(grid.edges)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [(1, Bounds(grid, now))] + ([] if before is None else [(-1, Bounds(grid, before))])
        counts, sums, seen = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64), False
        for batch in batches:
            if batch.num_rows:
                seen = True
                codes, vectors = grid.unpack(batch.column(0)), matrix(batch.column(1), dimensions)
                for sign, bounds in sides:
                    own = bounds.nearest(codes, vectors)
                    for c in np.unique(own):
                        sums[c] += sign * vectors[own == c].sum(axis=0)
                    counts += sign * np.bincount(own, minlength=k)
        if seen:
            c, d = np.divmod(np.arange(k * dimensions), dimensions)
            columns = [pa.array(c, pa.int32()), pa.array(d, pa.int32()), pa.array(counts[c]), pa.array(sums.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "d", "n", "total"])

    parts = rows.select("cells", "vector").mapInArrow(add, "cluster int, d int, n long, total long")
    wide = [F.sum(F.col(x).cast("decimal(20,0)")).alias(x) for x in ("n", "total")]
    counts, sums = np.zeros(k, dtype=np.int64), [[0] * dimensions for _ in range(k)]
    for r in parts.groupBy("cluster", "d").agg(*wide).collect():  # centroids x dimensions
        counts[r["cluster"]], sums[r["cluster"]][r["d"]] = int(r["n"]), int(r["total"])
    return counts, sums


def placed(table: DataFrame, grid: Grid, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance of every vector."""
    dimensions = len(grid.edges)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(grid, centroids)
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column(2), dimensions)
                own = bounds.nearest(grid.unpack(batch.column(1)), vectors)
                distance = ((vectors - centroids[own]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    kind = dict(table.dtypes)["vec_id"]
    return table.select("vec_id", "cells", "vector").mapInArrow(measure, f"vec_id {kind}, cluster int, distance long")


def starts(vectors: DataFrame, k: int) -> np.ndarray:
    """The vectors with the smallest digests of `1:<vec_id>`, in that order; equal digests by vector."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["vector"] for r in vectors.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k).collect()], dtype=np.int64)


def _by_cluster(values: Sequence, kind: str) -> Column:
    """A value per cluster as a column over `cluster`."""
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)


def cluster(
    rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, bits: int = BITS
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every whole vector (vec_id, embedding)."""
    vectors = stored(integers(rows, dimensions, scale))
    now = starts(vectors, k)
    if not len(now):
        empty = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    grid = Grid.fit(vectors, bits, dimensions)
    table = approximated(vectors, grid)
    before, counts, sums = None, None, None
    for _ in range(rounds):
        if before is None:
            counts, sums = cluster_sums(table, grid, None, now)
        else:
            fetched = stored(to_fetch(table, grid, before, now))
            full = table.select("row_id", "cells", "vector").join(small(fetched), "row_id", "left_semi")
            more, change = cluster_sums(full, grid, before, now)
            counts = counts + more
            sums = [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(sums, change, strict=True)]
        before = now
        now = np.array([[s // int(n) for s in total] if n else old for total, n, old in zip(sums, counts, now.tolist(), strict=True)], dtype=np.int64)
    found = stored(placed(table, grid, now))
    inertia = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(F.try_sum("distance").alias("n")).collect()}  # a row per cluster
    whole = None if None in inertia.values() else sum(inertia.values())
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    return found.select(
        "vec_id", "cluster", "distance", _by_cluster([inertia.get(c) for c in range(len(now))], "long").alias("cluster_inertia"),
        F.lit(whole if whole is not None and whole < 1 << 63 else None).cast("long").alias("inertia"),
        _by_cluster(digests, "string").alias("centroid_sha256"),
    )
