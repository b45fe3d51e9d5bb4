"""Key and reference rules on rows that are about to be written, as if they came one after another.

A row is refused for a broken rule, a key with a null in it, or a reference to a row that does not exist; among the others
the first of each key is admitted and later ones are duplicates. A refused row does not use up its key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketmill.operators.gate import REASON, broken_rules
from basketmill.operators.ordering import rank_in_group
from basketmill.operators.relational import absent_from
from basketmill.schemas import Reference
from basketmill.session import stage

DUPLICATE, NULL_KEY = "duplicate_key", "null_key"
_PLACE = "_place"


def missing(reference: Reference) -> str:
    """The reason given for a reference to nothing."""
    return f"{reference.column}_not_in_{reference.parent}"


def _flagged(rows: DataFrame, reference: Reference, parents: Mapping[str, DataFrame], flag: str) -> DataFrame:
    """Rows with ``flag`` set where the reference is to nothing. A null refers to nothing and is allowed.

    Values are merged before they meet the parents; only those that are missing meet the rows again.
    """
    values = rows.select(reference.column).where(F.col(reference.column).isNotNull()).distinct()
    absent = stage(absent_from(values, parents[reference.parent], [reference.column]).withColumn(flag, F.lit(True)), "missing")
    return rows.join(absent, reference.column, "left")


def judged(
    rows: DataFrame,
    rules: Mapping[str, str],
    key: Sequence[str],
    references: Sequence[Reference],
    parents: Mapping[str, DataFrame],
    stored: bool = False,
) -> DataFrame:
    """Every row with the reason it is refused by itself, null if there is none. ``stored`` says that ``rows`` is a scan."""
    found = rows if stored else stage(rows, "arrived")
    flags = {f"_missing{i}": reference for i, reference in enumerate(references)}
    for flag, reference in flags.items():
        found = _flagged(found, reference, parents, flag)
    gaps = [F.when(F.col(flag), F.lit(missing(reference))) for flag, reference in flags.items()]
    null_key = F.exists(F.array(*[F.col(c).isNull() for c in key]), lambda gap: gap)
    whole = F.concat_ws(",", F.nullif(broken_rules(rules), F.lit("")), F.when(null_key, F.lit(NULL_KEY)), *gaps)
    return found.select(*rows.columns, F.nullif(whole, F.lit("")).alias(REASON))


def placed(judged_rows: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The rows not refused by themselves, with their place among those of the same key.

    ``order_by`` is the order of arrival; of rows equal in it any is the first.
    """
    return rank_in_group(judged_rows.where(F.col(REASON).isNull()), list(key), list(order_by), _PLACE)


def with_duplicates(place: Column, seen: Column) -> Column:
    """The reason of rows that are in order but for their key."""
    return F.when((place > 1) | seen, F.lit(DUPLICATE)).alias(REASON)


def admit(
    rows: DataFrame,
    rules: Mapping[str, str],
    key: Sequence[str],
    order_by: Sequence[str],
    references: Sequence[Reference] = (),
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Every row with its reason, null for those admitted into an empty table."""
    alone = stage(judged(rows, rules, key, references, parents or {}), "judged")
    in_order = placed(alone, key, order_by)
    kept = in_order.select(*rows.columns, with_duplicates(F.col(_PLACE), F.lit(False)))
    return alone.where(F.col(REASON).isNotNull()).unionByName(kept)
