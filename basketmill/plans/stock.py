"""Stock queries: seeding, resets, listing, allocation and its verdict."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketmill.operators import stock
from basketmill.operators.cleaning import filled_products
from basketmill.sources import roles
from basketmill.sources.roles import inventory, requests, resets

ALLOCATED_STOCK = 10
# The time of the run, where a query needs one that does not change.
RUN_TIME = datetime(2024, 6, 1)


def products(spark: SparkSession, folder: str) -> DataFrame:
    return filled_products(roles.products(spark, folder))


def full_stock(spark: SparkSession, folder: str, count: int) -> DataFrame:
    """The same stock for every product."""
    return products(spark, folder).select("product_id", F.lit(count).alias("stock_count"))


def stock_seed(spark: SparkSession, folder: str) -> DataFrame:
    return stock.seed(products(spark, folder), inventory(spark, folder), RUN_TIME)


def stock_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return stock.upsert(inventory(spark, folder), products(spark, folder), resets(spark, folder))


def stock_refused(spark: SparkSession, folder: str) -> DataFrame:
    return stock.refused(products(spark, folder), resets(spark, folder))


def stock_listing(spark: SparkSession, folder: str) -> DataFrame:
    return stock.listing(products(spark, folder), inventory(spark, folder))


def stock_allocation(spark: SparkSession, folder: str) -> DataFrame:
    return stock.allocate(requests(spark, folder), full_stock(spark, folder, ALLOCATED_STOCK))


def stock_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """What the requests, served one by one, should have sold and did."""
    return stock.verdict(stock_allocation(spark, folder), full_stock(spark, folder, ALLOCATED_STOCK))


QUERIES = {
    f.__name__: f
    for f in (
        stock_seed,
        stock_upsert,
        stock_refused,
        stock_listing,
        stock_allocation,
        stock_verdict,
    )
}
