"""Reading and writing tables, metrics and stored parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticketlens.skew import q

FORMATS = ("csv", "parquet", "json", "orc")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    """A table file or folder, NaN as null. CSV has a header; without a schema its types are inferred (a second pass)."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, use one of {FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=False, escape='"')
        reader = reader if schema else reader.option("inferSchema", True)
    return nan_as_null((reader.schema(schema) if schema else reader).load(path))


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN in a number column is no value."""
    floats = [c for c, t in df.dtypes if t in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(q(c)), q(c)) for c in floats}) if floats else df


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Distributed write; parent folders are made."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, use one of {FORMATS}")
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metrics rows as JSON lines."""
    df.write.mode("overwrite").json(path)


PARAMS_SCHEMA = (
    "k_features int, rf_params struct<n_estimators:int, max_depth:int, min_samples_split:int, "
    "min_samples_leaf:int, max_features:string, random_state:int, class_weight:string>"
)


def read_params(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stored best parameters, whether wrapped in `best_params` or flat; one JSON document per file or per line."""
    raw = spark.read.option("multiLine", multi_line).schema(f"best_params struct<{_inner()}>, {PARAMS_SCHEMA}").json(path)
    return raw.select(
        F.coalesce("best_params.k_features", "k_features").alias("k_features"),
        F.coalesce("best_params.rf_params", "rf_params").alias("rf_params"),
    )


def _inner() -> str:
    return PARAMS_SCHEMA.replace("k_features int", "k_features:int").replace("rf_params struct", "rf_params:struct")
