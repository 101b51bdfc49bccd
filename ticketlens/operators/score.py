"""How far each predicted class distribution can be trusted.

All measures are plain column arithmetic over the probability columns, so the
whole chain is one narrow stage.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.bins import cut
from ticketlens.functions.labels import label_position, ordered_labels
from ticketlens.skew import q

PREFIX = "proba_"

# Weights of the trust score and its bands
TRUST_WEIGHTS = {
    "Proba_Max": 0.30,
    "top2_margin": 0.20,
    "proximity_score": 0.20,
    "local_mass_pm1": 0.15,
    "dispersion_score": 0.10,
    "data_quality": 0.05,
}
BAND_EDGES = (0, 0.5, 0.75, 0.90, 1.0)
BAND_LABELS = ("Low", "Med", "High", "Very High")

# Columns of predictions that are read as numbers
NUMERIC_COLUMNS = (
    "Proba_Max", "top2_proba", "top2_margin", "proximity_score", "local_mass_pm1",
    "dispersion_score", "data_quality", "trust_score_v2", "entropy_norm",
)


def class_labels(df: DataFrame) -> list[str]:
    """Class labels of the probability columns in label order."""
    return ordered_labels([c[len(PREFIX):] for c in df.columns if c.startswith(PREFIX)])


def mass(label: str) -> Column:
    """Probability of a class; a class the row does not know has none."""
    return F.coalesce(q(PREFIX + label), F.lit(0.0))


def total(terms: Sequence[Column]) -> Column:
    return functools.reduce(add, terms, F.lit(0.0))


def largest_two(labels: Sequence[str]) -> tuple[Column, Column]:
    ranked = F.sort_array(F.array(*[mass(c) for c in labels]), asc=False)
    return ranked[0], (ranked[1] if len(labels) > 1 else F.lit(0.0))


def entropy_bits(labels: Sequence[str]) -> Column:
    return total([F.when(mass(c) > 0, -mass(c) * F.log2(mass(c))).otherwise(0.0) for c in labels])


def top2(df: DataFrame) -> DataFrame:
    """Largest and second largest probability and their gap; a given Proba_Max is kept."""
    labels = class_labels(df)
    if not labels:
        return df
    first, second = largest_two(labels)
    added = {"top2_proba": second, "top2_margin": first - second}
    if "Proba_Max" not in df.columns:
        added = {"Proba_Max": first, **added}
    return df.withColumns(added)


def _numeric(df: DataFrame) -> list[tuple[str, float]]:
    return [(c, label_position(c)) for c in class_labels(df) if label_position(c) is not None]


def _spread(numeric: Sequence[tuple[str, float]]) -> float:
    width = max(x for _, x in numeric) - min(x for _, x in numeric)
    return width if width > 0 else 1.0


def _top_value(numeric: Sequence[tuple[str, float]], values: Sequence[float]) -> Column:
    """The value that belongs to the most probable class, first one on ties."""
    best = F.greatest(*[mass(c) for c, _ in numeric])
    out = F
    for (label, _), value in zip(numeric, values):
        out = out.when(mass(label) == best, F.lit(value))
    return out


def proximity(df: DataFrame) -> DataFrame:
    """1 minus the mean distance of the mass to the top class, in units of the label range."""
    numeric = _numeric(df)
    if len(numeric) < 2:
        return df.withColumn("proximity_score", F.lit(None).cast("double"))
    width = _spread(numeric)
    placed = df.withColumn("top_at", _top_value(numeric, [x for _, x in numeric]))
    away = total([mass(c) * F.abs(F.lit(x) - F.col("top_at")) / F.lit(width) for c, x in numeric])
    return placed.withColumn("proximity_score", F.lit(1.0) - away).drop("top_at")


def local_mass(df: DataFrame, radius: int = 1) -> DataFrame:
    """Mass of the top class and its neighbours in label order."""
    numeric = _numeric(df)
    if len(numeric) < 2:
        return df.withColumn("local_mass_pm1", F.lit(None).cast("double"))
    placed = df.withColumn("top_rank", _top_value(numeric, list(range(len(numeric)))))
    near = total(
        [F.when(F.abs(F.col("top_rank") - i) <= radius, mass(c)).otherwise(0.0) for i, (c, _) in enumerate(numeric)]
    )
    return placed.withColumn("local_mass_pm1", near).drop("top_rank")


def dispersion(df: DataFrame) -> DataFrame:
    """1 minus the variance of the label position over its largest possible value."""
    numeric = _numeric(df)
    if len(numeric) < 2:
        return df.withColumn("dispersion_score", F.lit(None).cast("double"))
    largest = _spread(numeric) ** 2 / 4.0
    centred = df.withColumn("label_mean", total([mass(c) * F.lit(x) for c, x in numeric]))
    variance = total([mass(c) * F.pow(F.lit(x) - F.col("label_mean"), 2) for c, x in numeric])
    return centred.withColumn("dispersion_score", F.lit(1.0) - variance / F.lit(largest)).drop("label_mean")


def entropy_norm(df: DataFrame) -> DataFrame:
    """Entropy of all classes over the largest entropy of the numeric ones, within [0, 1]."""
    labels = class_labels(df)
    if not labels:
        return df
    known = len(_numeric(df))
    top = math.log2(known) if known > 1 else 1.0
    share = entropy_bits(labels) / F.lit(top)
    return df.withColumn("entropy_norm", F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def data_quality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of the given columns that hold a value; 1 without columns."""
    if not columns:
        return df.withColumn("data_quality", F.lit(1.0))
    filled = total([F.when(q(c).isNotNull(), 1.0).otherwise(0.0) for c in columns])
    return df.withColumn("data_quality", filled / F.lit(float(len(columns))))


def trust_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted sum of the clipped measures; a missing measure counts 0."""
    weights = weights or TRUST_WEIGHTS
    present = [(c, w) for c, w in weights.items() if c in df.columns]
    parts = [
        F.lit(w) * F.when(q(c).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), q(c).cast("double"))))
        for c, w in present
    ]
    return df.withColumn("trust_score_v2", total(parts))


def trust_band(score: Column) -> Column:
    """Band of a trust score; a rounding excess over 1 is cut first."""
    return cut(F.when((score > 1) & (score < 1 + 1e-9), F.lit(1.0)).otherwise(score), BAND_EDGES, BAND_LABELS)


def coerce(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns to double, unreadable values to null."""
    return df.withColumns({c: q(c).try_cast("double") for c in columns if c in df.columns})


def rank_rows(df: DataFrame, tie: str = "epic_key") -> DataFrame:
    """Most trusted rows first."""
    order = [q(c).desc_nulls_last() for c in ("trust_score_v2", "Proba_Max", "top2_margin") if c in df.columns]
    return df.orderBy(*order, q(tie))


def score(df: DataFrame, quality_columns: Sequence[str] | None = None) -> DataFrame:
    """All measures, the trust score and its band, without sorting."""
    numeric = [c for c in df.columns if c.startswith(PREFIX)] + [c for c in NUMERIC_COLUMNS if c in df.columns]
    out = top2(coerce(df, numeric))
    if class_labels(df):
        out = entropy_norm(dispersion(local_mass(proximity(out))))
    out = trust_score(data_quality(out, quality_columns))
    return out.withColumn("trust_band", trust_band(F.col("trust_score_v2")))
