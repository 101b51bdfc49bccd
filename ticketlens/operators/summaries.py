"""Report tables over scored predictions; each is one pre-aggregated pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.bins import cut
from ticketlens.operators.score import BAND_LABELS, class_labels, entropy_bits, largest_two
from ticketlens.skew import q

# Report buckets
TRUST_EDGES = (0, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
TRUST_LABELS = ("0–50%", "50–60%", "60–70%", "70–80%", "80–90%", "90–100%")
MARGIN_EDGES = (0, 0.05, 0.10, 0.20, 0.30, 1.00)
MARGIN_LABELS = ("<5pp", "5–10pp", "10–20pp", "20–30pp", "≥30pp")
ENTROPY_BUCKETS = 6


def count_labels(df: DataFrame, label: Column, labels: Sequence[str], name: str = "bucket") -> DataFrame:
    """Rows per label in the given order, 0 where there is none."""
    counts = df.agg(*[F.count(F.when(label == F.lit(v), 1)).alias(f"n{i}") for i, v in enumerate(labels)])
    rows = F.array(
        *[F.struct(F.lit(i).alias("ord"), F.lit(v).alias(name), F.col(f"n{i}").alias("n")) for i, v in enumerate(labels)]
    )
    return counts.select(F.inline(rows))


def class_histogram(df: DataFrame, column: str = "predicted_lead_time") -> DataFrame:
    """Rows per predicted class, null counted, sorted by class."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(q(column).asc_nulls_last())


def trust_histogram(df: DataFrame) -> DataFrame:
    return count_labels(df, cut(F.col("trust_score_v2"), TRUST_EDGES, TRUST_LABELS), TRUST_LABELS)


def margin_histogram(df: DataFrame) -> DataFrame:
    first, second = largest_two(class_labels(df))
    return count_labels(df, cut(first - second, MARGIN_EDGES, MARGIN_LABELS), MARGIN_LABELS)


def entropy_edges(classes: int) -> list[float]:
    top = math.log2(max(1, classes))
    return [top * i / ENTROPY_BUCKETS for i in range(ENTROPY_BUCKETS + 1)]


def entropy_histogram(df: DataFrame) -> DataFrame:
    """Rows per sixth of the entropy range; a rounding excess counts in the last one."""
    labels = class_labels(df)
    edges = entropy_edges(len(labels))
    names = [f"{low:.2f}–{high:.2f}" for low, high in zip(edges, edges[1:])]
    bits = F.least(entropy_bits(labels), F.lit(edges[-1]))
    return count_labels(df, cut(bits, edges, names), names)


def status_trust(df: DataFrame, status: str = "epic_status") -> DataFrame:
    """Mean trust per status, null status kept, best first."""
    means = df.groupBy(status).agg(F.avg("trust_score_v2").alias("mean_trust"))
    return means.orderBy(F.col("mean_trust").desc_nulls_last(), q(status))


def band_counts(df: DataFrame) -> DataFrame:
    return count_labels(df, F.col("trust_band"), BAND_LABELS, "trust_band")
