"""Rules on rows that are about to be written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from basketmill.operators.quality import kept

REASON = "reason"


def broken_rules(rules: Mapping[str, str]) -> Column:
    """The names of the rules a row breaks, joined by commas; empty for a good row."""
    return F.concat_ws(",", *[F.when(~kept(sql), F.lit(name)) for name, sql in rules.items()])


def judged(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Every row with its reason, in one pass; null for a good row."""
    return df.withColumn(REASON, F.nullif(broken_rules(rules), F.lit("")))


def split(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the reason. Together they are the input."""
    rows = judged(df, rules)
    return rows.filter(F.col(REASON).isNull()).drop(REASON), rows.filter(F.col(REASON).isNotNull())


def enforce(df: DataFrame, rule: str, message: Column) -> DataFrame:
    """The same rows, but the job fails with ``message`` at the first row that breaks the rule.

    The check is a filter, so column pruning cannot drop it.
    """
    return df.filter(F.when(kept(rule), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def freight_message() -> Column:
    return F.concat(
        F.lit("freight_value "),
        F.col("freight_value").cast("string"),
        F.lit(" exceeds price "),
        F.col("price").cast("string"),
    )


def audit(items: DataFrame, products: DataFrame, rule: str) -> DataFrame:
    """The rule on rows already stored: violations and their share per category.

    Items are counted per product before they meet the products.
    """
    per_product = items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(~kept(rule)).alias("violations")
    )
    return (
        per_product.join(products, "product_id")
        .groupBy("product_category_name")
        .agg(F.sum("items").alias("items"), F.sum("violations").alias("violations"))
        .withColumn("violation_share", F.round(F.col("violations") * 100.0 / F.col("items"), 2).cast("double"))
    )
