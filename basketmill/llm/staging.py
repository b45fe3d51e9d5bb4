"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketmill.session import new_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once, compressed, to the folder all executors share, and return a scan of it."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
