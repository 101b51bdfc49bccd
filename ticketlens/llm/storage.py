"""Intermediate tables in the shared folder, and joins that broadcast only what was measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.session import scratch_folder

#: Slim tables (keys and a few numbers) of at most this many rows may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once as Parquet in the folder that all executors share, and read back column by column."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The table with a broadcast hint if its counted rows are few, without one otherwise."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df
