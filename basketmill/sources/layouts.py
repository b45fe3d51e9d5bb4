"""Tables laid out for lookups: sorted by a key with Bloom filters, or in buckets that join without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

# Rows that one row group of a sorted table holds, and rows that Parquet checks before it may end one.
GROUP_ROWS = 20_000


def write_sorted(df: DataFrame, path: str, key: str, files: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The table in ``files`` ranges of ``key``, sorted in each, with a Bloom filter of the key per row group.

    A lookup of one key then reads the row groups whose range may hold it and whose filter does not rule it out; equal
    keys lie together, so that is one as a rule. The files' number is given, as a table of any size has its own; with ranges
    of equal rows a crowded key fills a file, and row groups inside it still end after ``group_rows`` rows.
    """
    (
        df.repartitionByRange(files, key)
        .sortWithinPartitions(key)
        .write.options(
            **{
                f"parquet.bloom.filter.enabled#{key}": "true",
                f"parquet.bloom.filter.expected.ndv#{key}": str(group_rows),
                "parquet.block.row.count.limit": str(group_rows),
            }
        )
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """The table in ``buckets`` files by the hash of ``key``, sorted in each, as Spark's planner knows it.

    Two tables with the same number of buckets join on their keys bucket by bucket, without an exchange or a sort. A
    crowded key makes its bucket large; where that is likely, an exchange that Spark can split is the better way.
    """
    spark, name = df.sparkSession, f"buckets_{uuid.uuid4().hex}"
    # The exchange deals rows as the buckets do, so that each task writes one file.
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path)
    writer.saveAsTable(name)
    try:
        # The frame keeps the layout; its files stay when the name goes.
        return spark.table(name).select("*")
    finally:
        spark.sql(f"DROP TABLE {name}")
