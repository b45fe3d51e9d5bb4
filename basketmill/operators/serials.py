"""Numbers that go on from load to load: a stored key map and the highest number ever given."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketmill.operators.ordering import number_rows
from basketmill.session import stage
from basketmill.sources import versions
from basketmill.sources.versions import WHOLE, VersionConflict

ATTEMPTS = 5
_HIGHEST = "highest"


def _same(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in key])


def key_map(rows: DataFrame, path: str) -> DataFrame:
    """Keys and their numbers as last stored at ``path``."""
    return versions.read(rows.sparkSession, path)


def _extend(keys: DataFrame, path: str, name: str) -> int:
    """Numbers for keys that have none, after the highest given so far, in the order of the keys."""
    spark, key = keys.sparkSession, keys.columns
    last = versions.version(spark, path)
    highest = last.properties[_HIGHEST] if last else 0
    new = keys
    if last:
        known = versions.rows(spark, path, last).select(*key)
        new = keys.join(known, _same(keys, known, key), "left_anti")
    numbered = number_rows(new, [F.asc_nulls_first(c) for c in key], name)
    numbered = stage(numbered.withColumn(name, F.col(name) + F.lit(highest)).select(*key, name), "numbered_keys")
    given = numbered.count()
    folders = dict(last.folders) if last else {}
    folders[WHOLE] = (*folders.get(WHOLE, ()), *versions.write_data(numbered, path)[WHOLE])
    schema = last.schema if last else numbered.schema
    return versions.publish(spark, path, schema, folders, last.number if last else 0, {_HIGHEST: highest + given})


def extend(keys: DataFrame, path: str, name: str = "id") -> int:
    """Give numbers to the keys that have none; returns the version of the map that holds them all."""
    distinct = stage(keys.distinct(), "keys")
    for attempt in range(ATTEMPTS):
        try:
            return _extend(distinct, path, name)
        except VersionConflict:
            if attempt + 1 == ATTEMPTS:
                raise
    raise AssertionError("not reached")


def forget(keys: DataFrame, path: str) -> int:
    """A version without these keys. Their numbers are not given again: the highest stays."""
    spark = keys.sparkSession
    last = versions.version(spark, path)
    known = versions.rows(spark, path, last)
    left = known.join(keys, _same(known, keys, keys.columns), "left_anti")
    return versions.replace(left, path, last.number, last.properties)


def with_serial(rows: DataFrame, key: Sequence[str], path: str, name: str = "id") -> DataFrame:
    """Rows with the number of their key; keys seen for the first time get the next ones, in their order.

    The map lies at ``path`` in versions that other sessions see; a load appends its new keys to it and changes nothing that
    is there. Of two loads at once one starts again from the other's version. A null is a value of its own in a key.
    """
    known = versions.read(rows.sparkSession, path, extend(rows.select(*key), path, name))
    return rows.join(known, _same(rows, known, key), "left").select(*[rows[c] for c in rows.columns], known[name])
