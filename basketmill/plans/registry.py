"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketmill.plans import files, live, marts, model, oracle, relational, stock, stored

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for group in (relational, model, marts, stock, files, live, stored):
        found.update(group.QUERIES)
    return found


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
