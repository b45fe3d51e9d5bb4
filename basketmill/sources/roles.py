"""The given tables in the roles of the retail tables.

Each role reads its whole source table. The definitions leave every cleaning branch something to
do: orders never delivered, products without a category, orders with no, one or two reviews, and
reviews without a score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketmill.schemas import MONEY

# Orders below the first amount were never reviewed; orders from the second on were reviewed twice.
REVIEWED_FROM = 50_000
REVIEWED_TWICE_FROM = 490_000
PROMISED_DAYS = 730
LARGE_SIZE = 40
FIRST_STOCK_TIME = "2024-01-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_custkey").alias("customer_unique_id")
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.nullif(F.col("p_type"), F.lit("STANDARD")).alias("product_category_name"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.max("l_shipdate").alias("order_delivered_customer_date"))
    )
    placed = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        (F.col("o_orderdate") + F.expr(f"INTERVAL {PROMISED_DAYS} DAYS")).alias("order_estimated_delivery_date"),
    )
    return placed.join(shipped, "order_id", "left")


def item_roles(lineitem: DataFrame) -> DataFrame:
    """Order items from line items; also used on a stream of line items."""
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        (F.col("l_quantity") * 100).cast(MONEY).alias("freight_value"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return item_roles(table(spark, folder, "lineitem"))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One scan of orders; an order that was reviewed twice gives two rows."""
    first = F.struct(
        F.col("o_orderkey").alias("review_id"),
        F.nullif(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(4)).alias("review_score"),
    )
    second = F.struct((-1 - F.col("o_orderkey")).alias("review_id"), F.lit(1).alias("review_score"))
    given = F.when(F.col("o_totalprice") >= REVIEWED_TWICE_FROM, F.array(first, second)).otherwise(F.array(first))
    return (
        table(spark, folder, "orders")
        .filter(F.col("o_totalprice") >= REVIEWED_FROM)
        .select(F.col("o_orderkey").alias("order_id"), F.explode(given).alias("review"))
        .select("review.review_id", "order_id", "review.review_score")
    )


def retail(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five raw tables."""
    return {
        "customers": customers(spark, folder),
        "orders": orders(spark, folder),
        "order_items": items(spark, folder),
        "products": products(spark, folder),
        "order_reviews": reviews(spark, folder),
    }


def request_roles(events: DataFrame) -> DataFrame:
    """Stock requests from purchase events; also used on a stream of events."""
    return events.filter(F.col("event_type") == "purchase").select(
        "event_id", "ts", F.get_json_object("props", "$.k").cast("bigint").alias("product_id")
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return request_roles(table(spark, folder, "events"))


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Stock on hand: large parts have as many pieces as their size number."""
    return (
        table(spark, folder, "part")
        .filter(F.col("p_size") > LARGE_SIZE)
        .select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_size").cast("int").alias("stock_count"),
            F.lit(FIRST_STOCK_TIME).cast("timestamp_ntz").alias("updated_at"),
        )
    )


def resets(spark: SparkSession, folder: str) -> DataFrame:
    """Stock resets: view events name a product by event number; numbers past the catalogue are unknown."""
    return (
        table(spark, folder, "events")
        .filter(F.col("event_type") == "view")
        .select(
            F.col("event_id").alias("product_id"),
            F.floor("value").cast("int").alias("stock_count"),
            F.col("ts").alias("updated_at"),
        )
    )
