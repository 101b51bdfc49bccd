"""Clusters over the VA-file equal a plain computation, whatever the cells."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketlens.llm import vafile


def plain(rows, k=16, rounds=3, dims=64, scale=64):
    kept = []
    for vec_id, e in rows:
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) and abs(x * scale) < vafile.REACH for x in e):
            kept.append((vec_id, [math.floor(scale * x) for x in e]))
    name = lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            members = [v for (_, v), (_, o) in zip(kept, own) if o == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    total = sum(d for d, _ in own)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (str(i), c, d, sum(x for x, o in own if o == c), total, digests[c]) for (i, _), (d, c) in zip(kept, own)
    )


def found(df):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((str(r[0]), *r[1:]) for r in df.select(*columns).collect())


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return made.select("*", *[F.lit("clash").alias(c) for c in ("row_id", "cells", "vector", "cluster", "d", "digest")]).repartition(3)


@pytest.mark.parametrize("bits", [1, 4, 8])
def test_equals_the_plain_rounds(spark, bits):
    draw = random.Random(bits)
    middles = [[draw.gauss(0, 0.3) for _ in range(64)] for _ in range(5)]
    rows = [(n, [float(np.float32(draw.choice(middles)[d] + draw.gauss(0, 0.1))) for d in range(64)]) for n in range(150)]
    rows += [(3, rows[3][1]), (900, rows[3][1]), (None, rows[4][1]), (901, [0.0] * 64), (902, [0.0] * 64), (903, [100.0, *[0.0] * 63])]
    assert found(vafile.cluster(frame(spark, rows), bits=bits)) == plain(rows)


def test_rows_without_a_whole_vector_are_left_out(spark):
    good = [0.25] * 64
    rows = [(1, good), (2, None), (3, []), (4, good[:63]), (5, good + [0.0]), (6, [None, *good[1:]]), (7, [math.nan, *good[1:]]),
            (8, [math.inf, *good[1:]]), (9, [-0.001, *good[1:]]), (10, [3e30, *good[1:]]), (11, [2.0e6, *good[1:]])]
    assert found(vafile.cluster(frame(spark, rows))) == plain(rows)
    assert {r[0] for r in found(vafile.cluster(frame(spark, rows)))} == {"1", "9", "11"}


def test_empty_tables(spark):
    out = vafile.cluster(frame(spark, [(1, None)]).limit(0))
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert vafile.cluster(frame(spark, [(1, None)])).collect() == []


def test_intervals_hold_the_distance():
    draw = np.random.default_rng(3)
    vectors = draw.integers(-40, 40, (300, 8))
    edges = np.sort(draw.integers(-30, 30, (8, 15)), axis=1)
    first, last = vectors.min(axis=0)[:, None], vectors.max(axis=0)[:, None]
    grid = vafile.Grid(4, edges, np.hstack([first, np.maximum(edges + 1, first)]), np.hstack([np.minimum(edges, last), last]))
    codes = grid.codes(vectors)
    import pyarrow as pa
    assert (grid.unpack(pa.array(grid.pack(codes), pa.binary())) == codes).all()
    centroids = draw.integers(-40, 40, (6, 8))
    bounds = vafile.Bounds(grid, centroids)
    exact = ((vectors[:, None, :] - centroids) ** 2).sum(axis=2)
    least = sum(bounds.least[d][codes[:, d]] for d in range(8))
    most = sum(bounds.most[d][codes[:, d]] for d in range(8))
    assert (least <= exact).all() and (exact <= most).all()
    assert (bounds.nearest(codes, vectors) == exact.argmin(axis=1)).all()


def test_later_rounds_fetch_a_part(spark):
    """On separated clusters the approximations place nearly all vectors."""
    draw = random.Random(5)
    middles = [[draw.gauss(0, 1) for _ in range(64)] for _ in range(16)]
    rows = [(n, [x + draw.gauss(0, 0.05) for x in middles[n % 16]]) for n in range(800)]
    vectors = vafile.integers(frame(spark, rows)).cache()
    grid = vafile.Grid.fit(vectors)
    centroids = np.floor(np.array(middles) * 64).astype(np.int64)
    table = vafile.approximated(vectors, grid)
    assert vafile.to_fetch(table, grid, centroids, centroids).count() < 80
