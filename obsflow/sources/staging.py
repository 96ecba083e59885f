"""Columnar stage between cleaning and the many passes that follow it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = (), compact: bool = False, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as Parquet and return it as read back.

    Text files are parsed once; later passes read only the columns and
    partitions they need, and a lost executor recomputes from these files.
    Nothing is shuffled unless ``compact``, which lets adaptive execution even
    out file sizes (splitting a hot partition value over many files).
    """
    if compact:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
