"""Categories, labels and safe arithmetic used by the analyst queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def group_label(column: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """The name of the first group that lists the value, null outside every group."""
    label = F.lit(None).cast("string")
    for name, members in reversed(list(groups.items())):
        label = F.when(column.isin(*members), F.lit(name)).otherwise(label)
    return label


def in_years(column: Column, first: int, last: int) -> Column:
    """Whole calendar years as a range on the column itself, so that the scan can prune on it."""
    start = F.lit(f"{first:04d}-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (column >= start) & (column < end)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null when ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def quarter_label(quarter: Column) -> Column:
    return F.concat(F.lit("Q"), quarter.cast("string"))


def stock_label(product: Column, category: Column, stock: Column, default_category: str) -> Column:
    """``id | category | stock: n`` with readable defaults for missing parts."""
    return F.concat_ws(
        " | ",
        product.cast("string"),
        F.coalesce(category, F.lit(default_category)),
        F.concat(F.lit("stock: "), F.coalesce(stock.cast("string"), F.lit("not initialised"))),
    )
