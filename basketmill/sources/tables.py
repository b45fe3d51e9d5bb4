"""Named tables: queries over them, loading, reloading and creation from a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from basketmill.session import new_path


def query(
    spark: SparkSession,
    sql: str,
    tables: Mapping[str, DataFrame] | None = None,
    parameters: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run ``sql`` over ``tables`` (written ``{name}`` in the text) with bound ``:parameters``."""
    return spark.sql(sql, args=dict(parameters or {}), **(tables or {}))


def read_database(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, **options
) -> DataFrame:
    """A database table read in ``parts`` ranges of ``column``, one connection per task."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
        .load()
    )


def publish(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Temporary views over ``tables``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def create_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """An empty Parquet table at ``path``, unless a table of that name exists already."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def append_rows(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT``: columns are matched by name, not by position."""
    target = df.sparkSession.table(table)
    df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in target.schema.fields]).write.insertInto(table)


def reload(df: DataFrame, name: str) -> str:
    """Truncate and load: write a fresh copy beside the old one, then point the view at it.

    Readers of the old copy are never cut off, and ``df`` may itself read the old copy.
    Returns the new path.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
    return path
