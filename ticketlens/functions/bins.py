"""Right-closed binning, lowest edge included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (low, high] that holds the value; null outside."""
    out = F.when((c >= edges[0]) & (c <= edges[1]), F.lit(labels[0]))
    for low, high, label in zip(edges[1:-1], edges[2:], labels[1:]):
        out = out.when((c > low) & (c <= high), F.lit(label))
    return out
