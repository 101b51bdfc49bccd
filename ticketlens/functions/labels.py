"""Lead-time label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_quarters(days: Column, length: int = 90) -> Column:
    """Started quarters of a positive day count; 0 for null, zero or negative."""
    return F.when(days > 0, F.greatest(F.ceil(days / F.lit(length)), F.lit(1))).otherwise(F.lit(0)).cast("int")


def cap_label(quarters: Column, top: int = 8) -> Column:
    """Quarter count as text, with everything from `top` on in one open class."""
    return F.when(quarters >= top, F.lit(f"{top}+")).otherwise(quarters.cast("int").cast("string"))


def label_position(label: str) -> float | None:
    """Numeric position of a class label; an open class such as 8+ sits at its number."""
    text = label[:-1] if label.endswith("+") else label
    return float(text) if text.lstrip("-").isdigit() else None


def ordered_labels(labels: list[str]) -> list[str]:
    """By number, an open class after its closed one, others last."""
    def rank(label: str) -> tuple[float, bool]:
        position = label_position(label)
        return (float("inf") if position is None else position, label.endswith("+"))

    return sorted(labels, key=rank)
