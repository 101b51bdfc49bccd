"""The neighbour estimate against plain Python, with ranges of any length."""

import math
import random

import pytest

from ticketlens.operators import neighbours
from ticketlens.operators.neighbours import neighbour_information

EULER = 0.5772156649015329


def digamma(n):
    return -EULER + sum(1 / j for j in range(1, n))


def plain(points, k=3):
    """points: (x, label)."""
    sizes = {}
    for _, c in points:
        sizes[c] = sizes.get(c, 0) + 1
    points = [(x, c) for x, c in points if sizes[c] > 1]
    if not points:
        return 0.0
    total = 0.0
    for i, (x, c) in enumerate(points):
        wanted = min(k, sizes[c] - 1)
        radius = sorted(abs(v - x) for j, (v, d) in enumerate(points) if d == c and j != i)[wanted - 1]
        if radius == 0:
            near, m = sum(v == x and d == c for v, d in points), sum(v == x for v, _ in points)
        else:
            near, m = wanted, sum(abs(v - x) <= radius * (1 - 1e-9) for v, _ in points)
        total += digamma(near) - digamma(sizes[c]) - digamma(m)
    return max(0.0, digamma(len(points)) + total / len(points))


def columns():
    draw = random.Random(3)
    labels = [draw.choice("aabc") for _ in range(160)]
    shift = {"a": 0, "b": 2, "c": 5}
    out = [
        [(float(draw.randint(0, 40) + 3 * shift[c]), c) for c in labels],  # whole numbers with ties
        [(draw.randrange(2**20) / 2**10, c) for c in labels],  # independent, nearly no ties
        [(float(draw.random() < 0.3 + 0.2 * (c == "b")), c) for c in labels],  # a flag
        [(7.0, c) for c in labels],  # a constant
        [(float(k), "a" if k < 30 else "b") for k in range(60)] + [(90.0, "alone")],  # a class with one row
        [(1.0, "a"), (2.0, "b")],  # nothing but such classes
        [(float(v), "a") for v in (0, 0, 0, 0, 1, 1, 5, 9)] + [(0.0, "b"), (4.0, "b"), (6.0, "b")],
        [(-2.0**60, "a"), (2.0**60, "a"), (0.0, "a"), (1.0, "b"), (2.0, "b")],
    ]
    return out


@pytest.mark.parametrize("range_rows", [1_000_000, 40, 7])
def test_equals_the_plain_estimate(spark, range_rows):
    made = columns()
    rows = [(i, c, x, 1) for i, points in enumerate(made) for x, c in points] + [(0, "a", float("nan"), 4), (0, "a", None, 2)]
    table = spark.createDataFrame(rows, "i int, label string, x double, n long").repartition(4)
    found = neighbour_information(table, range_rows=range_rows)
    for i, points in enumerate(made):
        assert math.isclose(found[i], plain(points), abs_tol=1e-9), i
    assert found[0] > 0.3 and found[1] < 0.15


def test_counts_stand_for_rows(spark):
    one = spark.createDataFrame([(0, c, x, 1) for x, c in columns()[0]], "i int, label string, x double, n long")
    counted = one.groupBy("i", "label", "x").count().withColumnRenamed("count", "n")
    assert neighbour_information(one) == pytest.approx(neighbour_information(counted))


def test_no_rows(spark):
    assert neighbour_information(spark.createDataFrame([], "i int, label string, x double, n long")) == {}


def test_values_are_cut_into_ranges_once(spark, monkeypatch):
    """Ends of intervals meet the ranges of the values; they are not cut into ranges of their own."""
    cut, real = [], neighbours.ranges
    monkeypatch.setattr(neighbours, "ranges", lambda rows, order, size, most: (cut.append(order), real(rows, order, size, most))[1])
    one = spark.createDataFrame([(0, c, x, 1) for x, c in columns()[0]], "i int, label string, x double, n long")
    assert math.isclose(neighbour_information(one, range_rows=20)[0], plain(columns()[0]), abs_tol=1e-9)
    assert cut == [["i", "x"]]


@pytest.mark.parametrize("range_rows", [9, 1_000_000])
def test_intervals_through_several_ranges(spark, range_rows):
    draw = random.Random(8)
    # a class with few rows, far apart: its intervals take in whole ranges of the other
    points = [(draw.random(), "often") for _ in range(120)] + [(v, "rare") for v in (-3.0, 0.01, 0.5, 0.51, 0.99, 4.0)]
    counted = [(x, c, draw.randint(1, 5)) for x, c in points]
    table = spark.createDataFrame([(3, c, x, n) for x, c, n in counted], "i int, label string, x double, n long")
    assert math.isclose(neighbour_information(table, range_rows=range_rows)[3], plain([(x, c) for x, c, n in counted for _ in range(n)]), abs_tol=1e-9)
