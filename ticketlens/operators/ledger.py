"""Prediction ledger: stamping, upsert and the report column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.operators.score import PREFIX, class_labels, score
from ticketlens.skew import q, same_keys

# Ledger keys, default model name, report column groups
LEDGER_KEYS = ("epic_key", "model_name")
DEFAULT_MODEL = "default_model"
REPORT_HEAD = (
    "epic_key", "epic_status", "model_name", "last_prediction_at",
    "predicted_lead_time", "trust_score_v2", "trust_band",
)
REPORT_TOP = ("Proba_Max", "top2_proba", "top2_margin")
REPORT_TAIL = ("data_quality", "proximity_score", "local_mass_pm1", "dispersion_score", "entropy_norm")


def stamp(df: DataFrame, model: str | None = None, at: str | None = None, zone: str = "Europe/Paris") -> DataFrame:
    """Model name and local time of the prediction; `at` is a UTC time text, default now."""
    if at is None:
        moment = F.convert_timezone(None, F.lit(zone), F.current_timestamp().cast("timestamp_ntz"))
    else:
        moment = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit(at).cast("timestamp_ntz"))
    return df.withColumns(
        {
            "model_name": F.lit(model or DEFAULT_MODEL),
            "last_prediction_at": F.date_format(moment, "yyyy-MM-dd HH:mm:ss"),
        }
    )


def pick_keys(columns: Sequence[str], wanted: Sequence[str] | None = None) -> list[str]:
    """Wanted keys that exist, else the ledger keys that exist."""
    return [k for k in (wanted or LEDGER_KEYS) if k in columns]


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest order values per key; nulls in a key are equal.

    An aggregate with map-side combine, so copies of a key never meet in one task.
    Of rows equal in `order` the last one in the table's own order stays.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[q(c).alias(f"order_{i}") for i, c in enumerate(order)], F.col("row number"), *[q(c) for c in rest])
    best = df.withColumn("row number", F.monotonically_increasing_id()).groupBy(*[q(k).alias(k) for k in keys]).agg(F.max(ranked).alias("best"))
    return best.select(*[q(k) if k in keys else F.col("best")[k].alias(k) for k in df.columns])


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str] | None = None, order: Sequence[str] = (),
    old_unique: bool = False,
) -> DataFrame:
    """New rows replace old ones of the same key; the last row of a key stays.

    Without a usable key the rows are appended and full copies dropped. With
    `old_unique` (a ledger written by this function) only the new batch is
    aggregated and the ledger is filtered by an anti join, which Spark
    broadcasts when the batch is small, so that the ledger is not shuffled.
    """
    found = pick_keys(sorted({*old.columns, *new.columns}), keys)
    if not found or not all(k in old.columns and k in new.columns for k in found):
        return old.unionByName(new, allowMissingColumns=True).dropDuplicates()
    if old_unique:
        latest = last_per_key(new, found, order)
        replaced = latest.select(*[q(k) for k in found])
        kept = old.join(replaced, same_keys(old, replaced, found), "left_anti")
        return kept.unionByName(latest, allowMissingColumns=True)
    both = old.withColumn("batch", F.lit(0)).unionByName(new.withColumn("batch", F.lit(1)), allowMissingColumns=True)
    return last_per_key(both, found, ["batch", *order]).drop("batch")


def rescore(ledger: DataFrame) -> DataFrame:
    """All measures again over the whole ledger, with full data quality."""
    return score(ledger)


def report_columns(df: DataFrame) -> DataFrame:
    """Report column order; absent columns are skipped."""
    wanted = [*REPORT_HEAD, *REPORT_TOP, *[PREFIX + c for c in class_labels(df)], *REPORT_TAIL]
    return df.select(*[q(c) for c in wanted if c in df.columns])
