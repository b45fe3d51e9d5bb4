"""Limited stock against an ordered log of requests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from basketmill.functions.labels import stock_label
from basketmill.operators.ordering import previous_in_group, rank_in_group
from basketmill.operators.relational import absent_from, present_in, top
from basketmill.schemas import UNKNOWN_CATEGORY

REQUEST_ORDER = ("ts", "event_id")


def seed(products: DataFrame, inventory: DataFrame, now: datetime, n: int = 5, stock: int = 100) -> DataFrame:
    """Starting stock for the first ``n`` products that have no stock row, stamped with the run's time ``now``."""
    missing = absent_from(products.select("product_id"), inventory, ["product_id"])
    return top(missing, n, F.col("product_id")).withColumns(
        {"stock_count": F.lit(stock), "updated_at": F.lit(now).cast("timestamp_ntz")}
    )


def stamped(incoming: DataFrame, now: datetime) -> DataFrame:
    """Incoming stock with the run's time as its time of change, for ``upsert``."""
    return incoming.withColumn("updated_at", F.lit(now).cast("timestamp_ntz"))


def upsert(inventory: DataFrame, products: DataFrame, incoming: DataFrame) -> DataFrame:
    """Inventory after setting the incoming stock of known products; the last value of a product wins.

    The result is a new version of the table, for ``reload``; nothing is changed in place.
    """
    last = incoming.groupBy("product_id").agg(F.max(F.struct("updated_at", "stock_count")).alias("new"))
    known = present_in(last, products, ["product_id"])
    old = inventory.select("product_id", F.struct("updated_at", "stock_count").alias("old"))
    now = F.coalesce("new", "old")
    return old.join(known, "product_id", "full").select(
        "product_id",
        now["stock_count"].alias("stock_count"),
        now["updated_at"].alias("updated_at"),
        F.when(F.col("new").isNull(), F.lit("kept"))
        .when(F.col("old").isNull(), F.lit("inserted"))
        .otherwise(F.lit("reset"))
        .alias("action"),
    )


def refused(products: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows for products that do not exist."""
    return absent_from(incoming, products, ["product_id"])


def listing(products: DataFrame, inventory: DataFrame, n: int = 200) -> DataFrame:
    """Products with their stock, those with a stock row first."""
    stock = inventory.select("product_id", "stock_count", F.lit(True).alias("stocked"))
    rows = products.join(stock, "product_id", "left")
    return top(
        rows,
        n,
        F.when(F.col("stocked"), F.lit(0)).otherwise(F.lit(1)),
        F.col("product_category_name"),
        F.col("product_id"),
    ).select(
        "product_id",
        "product_category_name",
        "stock_count",
        stock_label(
            F.col("product_id"), F.col("product_category_name"), F.col("stock_count"), UNKNOWN_CATEGORY
        ).alias("label"),
    )


def settle(ranked: DataFrame, stock: DataFrame) -> DataFrame:
    """Outcome of requests whose place in line, ``position``, is known."""
    available = stock.select("product_id", F.col("stock_count").cast("long").alias("available"))
    seen = F.greatest(F.col("available") - F.col("position") + 1, F.lit(0))
    return (
        ranked.join(available, "product_id", "left")
        .withColumn("seen", F.when(F.col("available").isNotNull(), seen))
        .withColumn("written", F.when(F.col("seen") > 0, F.col("seen") - 1))
        .withColumn(
            "outcome",
            F.when(F.col("available").isNull(), F.lit("no stock row"))
            .when(F.col("seen") > 0, F.lit("accepted"))
            .otherwise(F.lit("sold out")),
        )
        .drop("available")
    )


def allocate(requests: DataFrame, stock: DataFrame, order_by: Sequence[str] = REQUEST_ORDER) -> DataFrame:
    """One piece per request, first come first served, as if every request held the stock row's lock."""
    return settle(rank_in_group(requests, ["product_id"], list(order_by), "position"), stock)


def lost_updates(log: DataFrame, stock: Column, order_by: Sequence[str] = REQUEST_ORDER) -> DataFrame:
    """Per product: writes, and those that started from a value that was no longer the last one committed."""
    writes = log.filter(F.col("written").isNotNull())
    judged = previous_in_group(writes, ["product_id"], list(order_by), "written", "committed", stock.cast("long"))
    return judged.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("writes"),
        F.count_if(~F.col("read").eqNullSafe(F.col("committed"))).alias("stale_writes"),
    )


def verdict(log: DataFrame, stock: DataFrame, order_by: Sequence[str] = REQUEST_ORDER) -> DataFrame:
    """Per product: what should have been sold, what was, and whether updates were lost.

    ``log`` has one row per request, with the value it wrote or null. The last value per product is
    a grouped maximum, so no product's log is gathered.
    """
    last = F.max(F.when(F.col("written").isNotNull(), F.struct(*order_by, "written")))
    per_product = log.groupBy("product_id").agg(F.count(F.lit(1)).alias("requests"), last["written"].alias("left"))
    initial = stock.select("product_id", F.col("stock_count").cast("long").alias("initial_stock"))
    final = F.coalesce(F.col("left"), F.col("initial_stock"))
    sold = F.least(F.col("initial_stock"), F.col("requests"))
    return (
        per_product.join(initial, "product_id")
        .select(
            "product_id",
            "requests",
            sold.alias("expected_sold"),
            (F.col("initial_stock") - sold).alias("expected_stock"),
            (F.col("initial_stock") - final).alias("actual_sold"),
            final.alias("final_stock"),
        )
        .withColumn(
            "outcome",
            F.when(F.col("final_stock") == F.col("expected_stock"), F.lit("as expected"))
            .when(F.col("final_stock") > F.col("expected_stock"), F.lit("lost update"))
            .otherwise(F.lit("below expected")),
        )
    )
