"""Cleaning, the normal form and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketmill.operators import cleaning, gate, modelling, ordering, quality
from basketmill.schemas import (
    DEPENDENCIES,
    FREIGHT_RULE,
    ITEM_RULES,
    NORMAL_FORM,
    PRODUCT_RULES,
    REFERENCES,
    REVIEW_RULES,
    STOCK_RULES,
    WIDE_KEY,
    WIDE_ORDER,
    Reference,
    id_rules,
)
from basketmill.session import stage
from basketmill.sources.roles import inventory, retail

DEPENDENT = tuple(dict.fromkeys(d.table for d in DEPENDENCIES))
PROFILED = {"order_items": ("price", "freight_value"), "order_reviews": ("review_score",)}
# Tables that must have rows before later jobs start.
REQUIRED = ("products", "orders", "order_items", "order_reviews")


def clean_wide(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_wide(retail(spark, folder))


def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaning_report(retail(spark, folder))


def model(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The normal form, or the named tables of it."""
    return modelling.normal_form(retail(spark, folder), names or tuple(NORMAL_FORM))


def kept_orders(spark: SparkSession, folder: str) -> DataFrame:
    return modelling.kept_orders(retail(spark, folder))


def normalize_customers(spark: SparkSession, folder: str) -> DataFrame:
    return modelling.project(kept_orders(spark, folder), NORMAL_FORM["customers"])


def _projection(name: str):
    def plan(spark: SparkSession, folder: str) -> DataFrame:
        return model(spark, folder, name)[name]

    return plan


def decompose_products(spark: SparkSession, folder: str) -> DataFrame:
    """One projection taken from the wide rows themselves, as a stored wide table would give it."""
    return modelling.decompose(clean_wide(spark, folder))["products"]


def not_null_check(spark: SparkSession, folder: str) -> DataFrame:
    """Raw tables, where gaps are expected, and the normal form, where none may be left."""
    raw = {f"raw_{name}": df for name, df in retail(spark, folder).items()}
    return quality.not_null({**raw, **model(spark, folder)})


def check_rules(spark: SparkSession, folder: str) -> DataFrame:
    tables = model(spark, folder)
    return quality.check_rules(
        {**tables, "product_inventory": inventory(spark, folder)},
        {
            "customers": id_rules("customer_unique_id"),
            "products": {**id_rules("product_id"), **PRODUCT_RULES},
            "orders": id_rules("order_id", "customer_unique_id"),
            "order_items": {**id_rules("order_id", "product_id"), **ITEM_RULES, **FREIGHT_RULE},
            "order_reviews": {**id_rules("review_id", "order_id"), **REVIEW_RULES},
            "product_inventory": STOCK_RULES,
        },
    )


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    tables = {**model(spark, folder), "cleaned_flat_table": clean_wide(spark, folder)}
    keys = {name: spec.key for name, spec in NORMAL_FORM.items()}
    return quality.duplicate_keys(tables, {**keys, "cleaned_flat_table": WIDE_KEY})


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """The declared references, and raw orders against the orders that survived cleaning."""
    tables = {**model(spark, folder), "raw_orders": retail(spark, folder)["orders"]}
    return quality.orphans(tables, (*REFERENCES, Reference("raw_orders", "order_id", "orders")))


def fd_check(spark: SparkSession, folder: str) -> DataFrame:
    """Dependencies of the wide table, read off its projections: the distinct pairs are the same."""
    return quality.dependency_check(model(spark, folder, *DEPENDENT), DEPENDENCIES)


def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_counts(model(spark, folder))


def readiness(spark: SparkSession, folder: str) -> DataFrame:
    return quality.readiness(row_counts(spark, folder), REQUIRED)


def grain_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Counts expected from the stored wide rows against tables built without widening."""
    grains = {name: spec.key for name, spec in NORMAL_FORM.items()}
    grains["order_items"] = NORMAL_FORM["order_items"].columns
    return quality.grain(stage(clean_wide(spark, folder), "wide"), model(spark, folder), grains)


def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.number_rows(clean_wide(spark, folder), list(WIDE_ORDER), "id")


def range_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.range_profile(model(spark, folder, *PROFILED), PROFILED)


def redundancy_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.redundancy(cleaning.wide_counts(cleaning.order_tally(retail(spark, folder))), model(spark, folder, *DEPENDENT), DEPENDENCIES)


def rule_gate_valid(spark: SparkSession, folder: str) -> DataFrame:
    return gate.split(retail(spark, folder)["order_items"], FREIGHT_RULE)[0]


def rule_gate_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return gate.split(retail(spark, folder)["order_items"], FREIGHT_RULE)[1]


def rule_audit(spark: SparkSession, folder: str) -> DataFrame:
    raw = retail(spark, folder)
    return gate.audit(
        raw["order_items"], cleaning.filled_products(raw["products"]), FREIGHT_RULE["freight_not_above_price"]
    )


def format_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.with_time_text(clean_wide(spark, folder))
    return rows.select("order_id", "order_item_id", "review_id", *[F.col(c) for c in cleaning.ORDER_TIMES])


QUERIES = {
    f.__name__: f
    for f in (
        clean_wide,
        cleaning_report,
        not_null_check,
        check_rules,
        duplicate_keys,
        fk_orphans,
        fd_check,
        decompose_products,
        row_counts,
        readiness,
        grain_reconcile,
        surrogate_key,
        range_profile,
        redundancy_report,
        rule_gate_valid,
        rule_gate_rejected,
        rule_audit,
        format_timestamps,
    )
}
QUERIES.update(
    {
        "normalize_customers": normalize_customers,
        "normalize_products": _projection("products"),
        "normalize_orders": kept_orders,
        "normalize_items": _projection("order_items"),
        "normalize_reviews": _projection("order_reviews"),
    }
)
