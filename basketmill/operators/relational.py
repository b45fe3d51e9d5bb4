"""Joins and lookups that are not plain one-liners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every left row with every right row.

    Spark sends a side to every task if its size in bytes is under the session's broadcast limit, and the
    other side is then never moved. Beyond it rows are paired partition by partition; nothing is cut off.
    """
    return left.crossJoin(right)


def theta_join(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """Pairs that meet a condition other than equality; sides are sent as in ``product``."""
    return left.join(right, on, "inner")


def range_join(
    left: DataFrame, right: DataFrame, point: Column, low: Column, high: Column, width: float, *near: tuple[Column, Column, Column, float]
) -> DataFrame:
    """Pairs with ``low <= point <= high``, where ``point`` is of ``left`` and the bounds are of ``right``, all numbers.

    Both tables may grow: the line is cut into bins of ``width``, a right row is entered into every bin its range touches and a left
    row into the one it lies in, so that a pair meets once, by equality, and is then tested exactly. A width near that of the
    ranges makes a few entries per right row. Nulls and ranges whose bounds are the wrong way round meet nothing.

    Where a pair must also be near in other numbers, each of ``near`` names another point, low, high and width. They are not
    tested, but pairs meet only if their bins there are the same too: a bin then holds few pairs that a later test drops.
    """

    def bin_of(value: Column, width: float = width) -> Column:
        return F.floor(value.cast("double") / width)

    bounded = (F.col("_low") <= F.col("_high")) & (F.abs("_low") < F.lit(float("inf"))) & (F.abs("_high") < F.lit(float("inf")))
    entered = right.withColumns({"_low": low, "_high": high}).where(bounded)
    entered = entered.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_low")), bin_of(F.col("_high")))))
    placed = left.withColumn("_point", point).withColumn("_bin", bin_of(F.col("_point")))
    bins = ["_bin"]
    for at, least, most, wide in near:
        bins.append(f"_bin{len(bins)}")
        entered = entered.where(least <= most).withColumn(bins[-1], F.explode(F.sequence(bin_of(least, wide), bin_of(most, wide))))
        placed = placed.withColumn(bins[-1], bin_of(at, wide))
    inside = (F.col("_point") >= F.col("_low")) & (F.col("_point") <= F.col("_high"))
    # Spark's sizes do not know of the entries, so it might send them whole.
    return placed.join(entered.hint("merge"), bins).where(inside).drop(*bins, "_point", "_low", "_high")


def present_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """EXISTS: rows whose key occurs in ``other``, where it may occur very often.

    The copies of ``other`` are merged before the exchange.
    """
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def owned_by(facts: DataFrame, owners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for many facts per key and about one owner row per key.

    Owners are not merged by the key: an exchange then feeds the join on both sides, which lets Spark
    split a crowded key of the facts over several tasks.
    """
    return facts.join(owners.select(*keys), list(keys), "left_semi")


def absent_from(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NOT EXISTS: rows whose key does not occur in ``other``; a null key occurs nowhere."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; each task keeps ``n`` of its own and only those are merged."""
    return df.orderBy(*order).limit(n)
