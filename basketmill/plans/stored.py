"""Stored tables: versions, layouts for lookups, numbers that go on, and a normal form that grows by batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketmill.operators import merging, serials, stock
from basketmill.operators.quality import union_all
from basketmill.plans.model import clean_wide
from basketmill.plans.relational import POINT
from basketmill.plans.stock import products
from basketmill.session import new_path, stage
from basketmill.sources import layouts, roles, versions
from basketmill.sources.roles import table

# A file of the sorted layout holds about so many rows.
ROWS_A_FILE = 1_000_000
BUCKETS = 32
# What was bought from then on comes with the second load.
SECOND_LOAD = datetime(1997, 1, 1)


def stock_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The inventory and, after the resets, its next version, both as another session sees them."""
    path = new_path(spark, "stock")
    known, resets = products(spark, folder), roles.resets(spark, folder)
    versions.replace(roles.inventory(spark, folder), path)
    versions.change(spark, path, lambda old: stock.upsert(old, known, resets).drop("action"))
    other = spark.newSession()
    both = [versions.read(other, path, n).withColumn("version", F.lit(n).cast("bigint")) for n in versions.numbers(other, path)]
    return union_all(both)


def point_lookup_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The point lookup on orders that are sorted by customer, with Bloom filters."""
    orders = table(spark, folder, "orders")
    files = max(1, round(orders.count() / ROWS_A_FILE))
    return layouts.write_sorted(orders, new_path(spark, "sorted"), "o_custkey", files).where(F.col("o_custkey") == POINT)


def bucket_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customers, both in buckets of the customer: nothing is exchanged."""
    path = new_path(spark, "buckets")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    left = layouts.write_buckets(orders, f"{path}/orders", "o_custkey", BUCKETS)
    right = layouts.write_buckets(customers, f"{path}/customers", "c_custkey", BUCKETS)
    met = left.join(right.hint("merge"), left["o_custkey"] == right["c_custkey"])
    return met.select("o_orderkey", "o_totalprice", "c_custkey", "c_name", "c_mktsegment")


def serial_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Orders numbered in two loads; the second has all orders, and those of the first keep their numbers."""
    path = new_path(spark, "serials")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"), "o_orderdate")
    serials.extend(orders.where(F.col("o_orderdate") < F.lit(SECOND_LOAD)).select("order_id"), path)
    return serials.with_serial(orders, ["order_id"], path)


def _merged(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the normal form after two batches of wide rows; some orders are in both."""
    path = new_path(spark, "merged")
    wide, spec = stage(clean_wide(spark, folder), "wide"), {name: merging.NORMAL_FORM[name]}
    bought = F.col("order_purchase_timestamp")
    merging.merge_wide(wide.where(bought < F.lit(SECOND_LOAD)), path, spec)
    merging.merge_wide(wide.where(bought >= F.lit(SECOND_LOAD) - F.expr("INTERVAL 30 DAYS")), path, spec)
    return merging.merged(spark, path, name)


def merged_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _merged(spark, folder, "orders")


def merged_items(spark: SparkSession, folder: str) -> DataFrame:
    return _merged(spark, folder, "order_items")


QUERIES = {
    f.__name__: f for f in (stock_versions, point_lookup_stored, bucket_join, serial_loads, merged_orders, merged_items)
}
