"""Analyst queries over the normal form of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketmill.operators import marts
from basketmill.plans.model import model
from basketmill.sources.roles import retail

# Category groups and periods of the analysis (fixed values of the role tables).
GROUPS = {"home": ("SMALL", "MEDIUM", "LARGE"), "beauty": ("PROMO", "ECONOMY")}
FIRST_YEAR, LAST_YEAR = 1997, 1998
FREIGHT_YEAR = 1997


def headline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return marts.headline_metrics(model(spark, folder, "customers", "orders", "order_reviews"))


def delivery_satisfaction(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delivery_satisfaction(retail(spark, folder), FIRST_YEAR, LAST_YEAR)


def delivery_satisfaction_by_order(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delivery_satisfaction_by_order(retail(spark, folder), FIRST_YEAR, LAST_YEAR)


def score_gap(spark: SparkSession, folder: str) -> DataFrame:
    return marts.score_gap(delivery_satisfaction(spark, folder))


def category_repurchase(spark: SparkSession, folder: str) -> DataFrame:
    return marts.category_repurchase(retail(spark, folder), GROUPS, FIRST_YEAR, LAST_YEAR)


def freight_by_quarter(spark: SparkSession, folder: str) -> DataFrame:
    return marts.freight_by_quarter(retail(spark, folder), FREIGHT_YEAR)


def freight_by_quarter_by_order(spark: SparkSession, folder: str) -> DataFrame:
    return marts.freight_by_quarter_by_order(retail(spark, folder), FREIGHT_YEAR)


def q4_freight_gap(spark: SparkSession, folder: str) -> DataFrame:
    return marts.q4_freight_gap(freight_by_quarter(spark, folder))


def wide_sample(spark: SparkSession, folder: str) -> DataFrame:
    return marts.wide_sample(retail(spark, folder))


def latest_rows(spark: SparkSession, folder: str) -> DataFrame:
    return marts.latest_rows(retail(spark, folder))


def admin_listing(spark: SparkSession, folder: str) -> DataFrame:
    return marts.item_listing(retail(spark, folder), "admin")


def public_listing(spark: SparkSession, folder: str) -> DataFrame:
    return marts.item_listing(retail(spark, folder), "analyst")


def next_item_id(spark: SparkSession, folder: str) -> DataFrame:
    return marts.next_item_id(model(spark, folder, "order_items", "products"))


QUERIES = {
    f.__name__: f
    for f in (
        headline_metrics,
        delivery_satisfaction,
        delivery_satisfaction_by_order,
        score_gap,
        category_repurchase,
        freight_by_quarter,
        freight_by_quarter_by_order,
        q4_freight_gap,
        wide_sample,
        latest_rows,
        admin_listing,
        public_listing,
        next_item_id,
    )
}
