"""Exact order statistics with bounded memory, the same at every size."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.skew import q

# rank error of one approximate pass is at most rows / ACCURACY
ACCURACY = 10_000
# values between two bounds that one array may hold; more are narrowed by another pass
GATHERED = 50_000
# values per rank that may come to the driver with the counts
AT_ONCE = 1_000


def number(c: Column) -> Column:
    """The value as a double; NaN is no value."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


@dataclass
class Moments:
    """Rows, values among them, their mean and population variance (None without values)."""

    rows: int
    n: int
    mean: float | None
    variance: float | None


def order_statistics(
    df: DataFrame, values: dict[str, Column], shares: Sequence[float], ranks_of, accuracy: int = ACCURACY, gathered: int = GATHERED,
    moments: dict[str, Moments] | None = None,
) -> dict[str, list[float]]:
    """Exact values at certain ranks of the sorted (non-null, non-NaN) values, per name; none for an empty column.

    `shares` say roughly where the ranks lie; `ranks_of(n)` gives the 0-based ranks
    once the number of values is known. A first pass counts and finds, around each
    share, two bounds that enclose its rank. A second pass counts the values below,
    at and between the bounds and gathers those between, which are few. Values equal
    to a bound are only counted, so no number of equal values is ever gathered, and
    each further pass narrows what lies strictly between. `moments`, if given, is
    filled from the first pass.
    """
    if not values:
        return {}
    slack = 2.0 / accuracy
    around = sorted({min(1.0, max(0.0, p + d)) for p in shares for d in (-slack, slack)})
    names = list(values)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), number(values[n]).alias("x")) for i, n in enumerate(names)
    ])).alias("v")).select("v.i", "v.x")
    first = long.groupBy("i").agg(
        F.count(F.lit(1)).alias("rows"), F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("variance"),
        F.percentile_approx("x", around, accuracy).alias("bounds"),
    ).collect()
    if moments is not None:
        moments.update({names[r["i"]]: Moments(r["rows"], r["n"], r["mean"], r["variance"]) for r in first})
    long = long.filter("x IS NOT NULL")
    first = [r for r in first if r["n"]]
    wanted = {r["i"]: ranks_of(r["n"]) for r in first}
    bounds = {r["i"]: sorted(set(r["bounds"])) for r in first}
    # between the bounds around one share lie few values; if they are very few they come along with the counts
    near: dict[int, set[int]] = {}
    for r in first:
        at = dict(zip(around, r["bounds"], strict=True))
        pairs = [(at[min(1.0, max(0.0, p - slack))], at[min(1.0, max(0.0, p + slack))]) for p in shares]
        if 4 * r["n"] / accuracy + 4 <= min(AT_ONCE, gathered):
            b = bounds[r["i"]]
            near[r["i"]] = {2 * k for k in range(1, len(b)) if any(low <= b[k - 1] and b[k] <= high for low, high in pairs)}
    out: dict[int, list[float]] = {}
    while bounds:
        cells, parts = _cells(long, bounds), {i: len(b) + 1 for i, b in bounds.items()}
        sizes: dict[int, dict[int, int]] = {i: {} for i in bounds}
        held: dict[tuple[int, int], list[float]] = {}
        asked_now = [(i, cell) for i, wished in near.items() for cell in wished]
        few = F.struct("i", "cell").isin([F.struct(F.lit(i), F.lit(c)) for i, c in asked_now]) if asked_now else F.lit(False)
        for r in cells.groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.when(few, F.col("x"))).alias("xs")).collect():
            sizes[r["i"]][r["cell"]] = r["n"]
            if r["xs"]:
                held[r["i"], r["cell"]] = sorted(r["xs"])
        near = {}
        found: dict[tuple[int, int], float] = {}
        inside: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i in bounds:
            below = 0
            for cell in range(2 * parts[i] - 1):
                n = sizes[i].get(cell, 0)
                for rank in wanted[i]:
                    if below <= rank < below + n:
                        if cell % 2:
                            found[i, rank] = bounds[i][cell // 2]
                        else:
                            inside.setdefault((i, cell), []).append((rank, rank - below))
                below += n
        for c in [c for c in inside if c in held]:
            for rank, place in inside.pop(c):
                found[c[0], rank] = held[c][place]
        small = [c for c in inside if sizes[c[0]][c[1]] <= gathered]
        if small:
            asked = F.struct("i", "cell").isin([F.struct(F.lit(i), F.lit(cell)) for i, cell in small])
            lists = cells.filter(asked).groupBy("i", "cell").agg(F.sort_array(F.collect_list("x")).alias("xs"))
            places = F
            for i, cell in small:
                picked = F.array(*[F.col("xs")[place] for _, place in inside[i, cell]])
                places = places.when((F.col("i") == i) & (F.col("cell") == cell), picked)
            for r in lists.select("i", "cell", places.alias("at")).collect():
                for (rank, _), x in zip(inside[r["i"], r["cell"]], r["at"], strict=True):
                    found[r["i"], rank] = x
        # where too much lies between two bounds, new ones are sought there
        large = [c for c in inside if c not in small]
        more: dict[int, list[float]] = {}
        if large:
            asked = F.struct("i", "cell").isin([F.struct(F.lit(i), F.lit(cell)) for i, cell in large])
            steps = [k / 16 for k in range(17)]
            for r in cells.filter(asked).groupBy("i", "cell").agg(F.percentile_approx("x", steps, accuracy).alias("b")).collect():
                more.setdefault(r["i"], []).extend(r["b"])
        for i in list(bounds):
            if i in more:
                bounds[i] = sorted({*bounds[i], *more[i]})
            else:
                out[i] = [found[i, rank] for rank in wanted[i]]
                del bounds[i]
    return {n: out.get(i, []) for i, n in enumerate(names)}


def _cells(long: DataFrame, bounds: dict[int, list[float]]) -> DataFrame:
    """Adds `cell` to (i, x): 2 k strictly between bounds k - 1 and k, 2 k + 1 at bound k. Other columns' rows go."""
    cell = F
    for i, b in bounds.items():
        edges = F.array(*[F.lit(float(x)) for x in b])
        # each bound below counts two, the one that is met counts one
        place = F.aggregate(edges, F.lit(0), lambda n, e: n + F.when(e < F.col("x"), 2).when(e == F.col("x"), 1).otherwise(0))
        cell = cell.when(F.col("i") == i, place)
    return long.filter(F.col("i").isin(list(bounds))).withColumn("cell", cell)


def medians(
    df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY, gathered: int = GATHERED, moments: dict[str, Moments] | None = None
) -> dict[str, float | None]:
    """Exact median per column, the mean of the two middle values of an even count; null for a column without values."""
    found = order_statistics(
        df, {c: q(c) for c in columns}, [0.5], lambda n: sorted({(n - 1) // 2, n // 2}), accuracy, gathered, moments
    )
    return {c: (found[c][0] + found[c][-1]) / 2 if found[c] else None for c in columns}


def bin_edges(df: DataFrame, values: dict[str, Column], shares: Sequence[float]) -> dict[str, list[float]]:
    """Distinct exact values at the given shares of the sorted values, per name."""
    found = order_statistics(
        df, values, shares, lambda n: [max(1, math.ceil(n * p - 1e-9)) - 1 for p in shares]
    )
    return {n: sorted(set(xs)) for n, xs in found.items()}
