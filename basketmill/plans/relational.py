"""Projection, filter, join and lookup queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketmill.operators import relational
from basketmill.sources.roles import items, products, table
from basketmill.sources.tables import query


# The customer that is looked up.
POINT = 10
# How far above an order's total an item's price may be, and how many days may lie between them.
ABOVE, DAYS = 5.0, 30


def filter_project(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .filter(F.col("l_quantity") > 45)
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )


def compare_ops(spark: SparkSession, folder: str) -> DataFrame:
    """Every comparison in one scan."""
    quantity = F.col("l_quantity")
    tests = {
        "eq": quantity == 25,
        "neq": quantity != 25,
        "gt": quantity > 25,
        "lt": quantity < 25,
        "gte": quantity >= 25,
        "lte": quantity <= 25,
    }
    counts = table(spark, folder, "lineitem").agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("operator"), F.col(n).alias("matches")) for n in tests])
    return counts.select(F.explode(pairs).alias("p")).select("p.operator", "p.matches")


def bool_ops(spark: SparkSession, folder: str) -> DataFrame:
    dear = (F.col("o_totalprice") > 400000) & (F.col("o_orderstatus") == "O")
    urgent = (F.col("o_orderpriority") == "1-URGENT") & ~(F.col("o_totalprice") > 20000)
    return table(spark, folder, "orders").filter(dear | urgent).select("o_orderkey", "o_orderstatus", "o_totalprice")


def point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return query(
        spark,
        "SELECT * FROM {orders} WHERE o_custkey = :customer",
        {"orders": table(spark, folder, "orders")},
        {"customer": POINT},
    )


def cross_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer with each nation; the nation table's size is checked before it is sent around."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return relational.product(customers, table(spark, folder, "nation").select("n_nationkey", "n_name"))


def equi_join(spark: SparkSession, folder: str) -> DataFrame:
    """Comma join with the key in WHERE; the constant on one key reaches both scans."""
    return query(
        spark,
        """SELECT c.c_name, o.o_orderkey, o.o_totalprice
           FROM {customer} AS c, {orders} AS o
           WHERE o.o_custkey = c.c_custkey AND o.o_custkey = 10""",
        {"customer": table(spark, folder, "customer"), "orders": table(spark, folder, "orders")},
    )


def lookup_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer. No hint: Spark broadcasts customers only below its size limit."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        "o_orderkey", "o_totalprice", "c_custkey", "c_name", "c_mktsegment"
    )


def three_way_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem")
    customers = table(spark, folder, "customer")
    parts = table(spark, folder, "part").filter(F.col("p_size") > 30)
    return (
        lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
        .join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(customers, orders["o_custkey"] == customers["c_custkey"])
        .select("c_name", "p_name", "p_size", "l_orderkey", "l_linenumber", "l_quantity")
    )


def theta_join(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with every region whose key lies below their nation's."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    regions = table(spark, folder, "region").select("r_regionkey", "r_name")
    return relational.theta_join(customers, regions, customers["c_nationkey"] > regions["r_regionkey"])


def price_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Items that cost as much as a whole order, or little more, and were shipped within days of it; both tables grow."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    total = F.col("o_totalprice")
    shipped, ordered = (F.unix_date(F.col(c).cast("date")) for c in ("l_shipdate", "o_orderdate"))
    # A day more on either side than is tested below, as the hours of a day may shift in the session's time zone.
    days = (shipped, ordered - (DAYS + 1), ordered + (DAYS + 1), DAYS + 2)
    near = relational.range_join(lines, orders, F.col("l_extendedprice"), total, total + ABOVE, ABOVE, days)
    within = F.expr(f"INTERVAL {DAYS} DAYS")
    return near.where(F.col("l_shipdate").between(F.col("o_orderdate") - within, F.col("o_orderdate") + within)).select(
        "o_orderkey", "o_totalprice", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )


def semi_join(spark: SparkSession, folder: str) -> DataFrame:
    return relational.present_in(products(spark, folder), items(spark, folder), ["product_id"])


def anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without a line."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.absent_from(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), lines, ["o_orderkey"]
    )


QUERIES = {
    f.__name__: f
    for f in (
        filter_project,
        compare_ops,
        bool_ops,
        point_lookup,
        cross_join,
        equi_join,
        lookup_join,
        three_way_join,
        theta_join,
        price_matches,
        semi_join,
        anti_join,
    )
}
