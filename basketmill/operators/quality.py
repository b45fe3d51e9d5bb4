"""Checks on stored tables. Each returns rows that say what was checked and how often it failed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketmill.operators.relational import absent_from
from basketmill.schemas import Dependency, Reference


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def kept(rule: str) -> Column:
    """A rule as a column; a null outcome counts as kept."""
    return F.coalesce(F.expr(rule), F.lit(True))


def _counted(df: DataFrame, table: str, label: str, failures: Mapping[str, Column]) -> DataFrame:
    """All counts of one table in a single scan, as (table_name, label, violations) rows."""
    names = list(failures)
    counts = df.agg(*[F.count_if(failures[n]).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias(label), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)]
    )
    return counts.select(F.lit(table).alias("table_name"), F.explode(pairs).alias("p")).select(
        "table_name", f"p.{label}", "p.violations"
    )


def not_null(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Nulls per column; all columns of a table unless ``columns`` names some."""
    return union_all(
        _counted(df, name, "column_name", {c: F.col(c).isNull() for c in (columns or {}).get(name, df.columns)})
        for name, df in tables.items()
    )


def check_rules(tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Rows that break each rule, all rules of a table in one scan."""
    return union_all(
        _counted(tables[name], name, "rule_name", {r: ~kept(sql) for r, sql in table_rules.items()})
        for name, table_rules in rules.items()
    )


def duplicate_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Key values that occur more than once."""
    return union_all(
        tables[name]
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("duplicated_keys"))
        .select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "duplicated_keys")
        for name, key in keys.items()
    )


def orphans(tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """Child rows without a parent, one row per reference.

    Children are counted per key before the join, so a key with a third of the rows crosses the
    network as one count per task.
    """

    def edge(ref: Reference) -> DataFrame:
        per_key = tables[ref.child].groupBy(ref.column).agg(F.count(F.lit(1)).alias("n"))
        return absent_from(per_key, tables[ref.parent], [ref.column]).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")
        ).select(
            F.lit(ref.child).alias("child_table"),
            F.lit(ref.column).alias("child_column"),
            F.lit(ref.parent).alias("parent_table"),
            "orphans",
        )

    return union_all(edge(r) for r in references)


def broken_dependencies(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """Values of ``left`` with more than one combination in ``right``.

    Smallest and largest value per column decide it in one exchange with fixed-size partial
    results. Null is a value of its own here: null beside a value is a violation.
    """
    spread = [F.min(c).alias(f"_lo_{c}") for c in right] + [F.max(c).alias(f"_hi_{c}") for c in right]
    filled = [F.count(c).alias(f"_n_{c}") for c in right]
    per_left = df.groupBy(*left).agg(F.count(F.lit(1)).alias("_n"), *spread, *filled)
    differs = [
        ~F.col(f"_lo_{c}").eqNullSafe(F.col(f"_hi_{c}"))
        | ((F.col(f"_n_{c}") > 0) & (F.col(f"_n_{c}") < F.col("_n")))
        for c in right
    ]
    return per_left.withColumn("broken", reduce(Column.__or__, differs))


def dependency_check(tables: Mapping[str, DataFrame], dependencies: Sequence[Dependency]) -> DataFrame:
    """Per dependency: determining values seen, and how many of them determine nothing."""
    return union_all(
        broken_dependencies(tables[d.table], d.left, d.right)
        .agg(F.count(F.lit(1)).alias("determinants"), F.count_if(F.col("broken")).alias("violations"))
        .select(
            F.lit(d.name).alias("dependency"),
            F.lit(",".join(d.left)).alias("left_columns"),
            F.lit(",".join(d.right)).alias("right_columns"),
            "determinants",
            "violations",
        )
        for d in dependencies
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def readiness(counts: DataFrame, required: Sequence[str]) -> DataFrame:
    """One verdict row: every required table is there and has rows."""
    filled = F.count_if(F.col("table_name").isin(*required) & (F.col("row_count") > 0))
    return counts.agg(
        F.when(filled == len(required), F.lit("ready")).otherwise(F.lit("required data is missing")).alias("status")
    )


def grain(source: DataFrame, tables: Mapping[str, DataFrame], grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct values expected from the source beside the rows each table really has.

    The source is a stored table: each grain reads just its own columns and merges equal rows before they
    are exchanged. A null part of a key still counts.
    """
    expected = union_all(
        source.select(*cols).distinct().agg(F.count(F.lit(1)).alias("expected")).select(F.lit(name).alias("table_name"), "expected")
        for name, cols in grains.items()
    )
    actual = row_counts({n: tables[n] for n in grains}).withColumnRenamed("row_count", "actual")
    return expected.join(actual, "table_name").withColumn("matches", F.col("expected") == F.col("actual"))


def range_profile(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Smallest and largest value of numeric columns."""

    def profile(name: str) -> DataFrame:
        bounds = [f(F.col(c)).cast("double").alias(f"{p}_{c}") for c in columns[name] for f, p in ((F.min, "lo"), (F.max, "hi"))]
        pairs = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"), F.col(f"lo_{c}").alias("min_value"), F.col(f"hi_{c}").alias("max_value")
                )
                for c in columns[name]
            ]
        )
        return tables[name].agg(*bounds).select(F.lit(name).alias("table_name"), F.explode(pairs).alias("p")).select(
            "table_name", "p.column_name", "p.min_value", "p.max_value"
        )

    return union_all(profile(name) for name in columns)


def redundancy(wide_rows: DataFrame, tables: Mapping[str, DataFrame], dependencies: Sequence[Dependency]) -> DataFrame:
    """How often the wide table repeats each fact: its rows against the distinct determining values.

    ``wide_rows`` is one row with that column.
    """
    facts = union_all(
        tables[d.table]
        .agg(F.count_distinct(F.struct(*d.left)).alias("distinct_facts"))
        .select(F.lit(d.name).alias("dependency"), F.lit(",".join(d.left)).alias("left_columns"), "distinct_facts")
        for d in dependencies
    )
    named = F.explode(F.array(*[F.lit(d.name) for d in dependencies])).alias("dependency")
    return facts.join(wide_rows.select(named, "wide_rows"), "dependency").select(
        "dependency",
        "left_columns",
        "wide_rows",
        "distinct_facts",
        (F.col("wide_rows") - F.col("distinct_facts")).alias("repeated_rows"),
    )
