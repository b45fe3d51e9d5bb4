"""Row numbers, ranks and previous values that hold when one group has a third of the rows.

A window over a group runs in one task. Here all rows, whatever the size of their group, go one way:
they are sorted across the cluster, and the range exchange cuts on the whole sort key, so it also
cuts inside a group. The sorted rows are written to the shared folder once. A row's place is its place
in its own part plus the rows of its group in the parts before; only a group that reaches over a border has
any, so what is carried from part to part is one row per part.

``order_by`` must name a total order, as it must for any repeatable row number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketmill.session import stage

_PART, _SEQ = "_part", "_seq"


def _place(df: DataFrame, order_by: Sequence, name: str, stored: bool = False) -> DataFrame:
    # Sorting reads its input twice, once for the borders: compute it once.
    return stage(
        (df if stored else stage(df, f"{name}_rows"))
        .orderBy(*order_by)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_SEQ, F.monotonically_increasing_id()),
        name,
    )


def number_rows(df: DataFrame, order_by: Sequence, name: str = "id") -> DataFrame:
    """Dense numbers 1..n over all rows in the given order."""
    placed = _place(df, order_by, "numbered")
    # One row per sorted part, however many rows there are: small enough for one window.
    parts = placed.groupBy(_PART).agg(F.min(_SEQ).alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(_PART, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(parts), _PART)
        .withColumn(name, F.col("_before") + F.col(_SEQ) - F.col("_first") + 1)
        .select(name, *df.columns)
    )


def _at_borders(placed: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Per part, as one row: its first group, how many rows of that group lie in parts before, and the last ``value`` among them.

    A part whose last group is also its first holds nothing else, so its rows add to those before.
    """
    key = F.struct(*[F.col(k) for k in keys])
    rows = placed.select(_PART, _SEQ, key.alias("_key"), value.alias("_value"))
    ends = rows.groupBy(_PART).agg(
        F.min_by("_key", _SEQ).alias("_head"),
        F.max_by("_key", _SEQ).alias("_tail"),
        F.max_by(F.struct("_value"), _SEQ).alias("_last"),
    )
    # How many rows the last group of each part has in it: a count per part, combined before the exchange.
    of_tail = rows.join(F.broadcast(ends.select(_PART, "_tail")), _PART).where(F.col("_key").eqNullSafe(F.col("_tail")))
    ends = ends.join(of_tail.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n")), _PART)
    # One row per sorted part: small enough for one window.
    before = Window.partitionBy("_tail").orderBy(_PART)
    running = ends.withColumn("_upto", F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    in_order = Window.orderBy(_PART)
    return running.select(
        F.col(_PART).alias("_of"),
        F.col("_head"),
        F.lag("_tail").over(in_order).alias("_tail_before"),
        F.lag("_upto").over(in_order).alias("_rows_before"),
        F.lag("_last").over(in_order).alias("_last_before"),
    )


def _with_borders(
    df: DataFrame, keys: Sequence[str], order_by: Sequence, value: Column, name: str, stored: bool = False
) -> tuple[DataFrame, Column]:
    """Sorted rows beside what lies before their part, and whether a row's group reaches back over the border."""
    placed = _place(df, [*keys, *order_by], name, stored)
    borders = _at_borders(placed, keys, value)
    joined = placed.join(F.broadcast(borders), placed[_PART] == borders["_of"])
    own = F.struct(*[F.col(k) for k in keys])
    reaches = F.col("_tail_before").isNotNull() & own.eqNullSafe(F.col("_tail_before"))
    return joined, reaches


def rank_in_group(df: DataFrame, keys: Sequence[str], order_by: Sequence, name: str, stored: bool = False) -> DataFrame:
    """``row_number()`` per group. ``stored`` says that ``df`` is a scan, which need not be written first."""
    joined, reaches = _with_borders(df, keys, order_by, F.lit(None).cast("int"), "ranked", stored)
    # A window inside one part: no group is ever larger than a part here.
    place = F.row_number().over(Window.partitionBy(_PART, *keys).orderBy(_SEQ)).cast("long")
    before = F.when(reaches, F.col("_rows_before")).otherwise(F.lit(0))
    return joined.withColumn(name, place + before).select(*df.columns, name)


def previous_in_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence, value: str, name: str, default: Column
) -> DataFrame:
    """``lag(value)`` per group, ``default`` on each group's first row."""
    joined, reaches = _with_borders(df, keys, order_by, F.col(value), "previous")
    in_part = Window.partitionBy(_PART, *keys).orderBy(_SEQ)
    first = F.when(reaches, F.col("_last_before")["_value"]).otherwise(default)
    found = F.when(F.row_number().over(in_part) == 1, first).otherwise(F.lag(value).over(in_part))
    return joined.withColumn(name, found).select(*df.columns, name)
