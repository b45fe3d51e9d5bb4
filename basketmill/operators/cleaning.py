"""From five raw tables to the clean wide table, and the report that goes with it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, functions as F

from basketmill.functions.parsing import parse_time, time_text
from basketmill.schemas import DEFAULT_SCORE, ORDER_TIMES, UNKNOWN_CATEGORY, WIDE_COLUMNS
from basketmill.session import stage

Tables = Mapping[str, DataFrame]
_UNSCORED = "_unscored"


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Orders with parsed times; those never delivered, or with an unreadable delivery time, drop out."""
    parsed = orders.withColumns({c: parse_time(F.col(c)) for c in ORDER_TIMES})
    return parsed.dropna(subset=["order_delivered_customer_date"])


def filled_products(products: DataFrame) -> DataFrame:
    return products.fillna({"product_category_name": UNKNOWN_CATEGORY})


def filled_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.fillna({"review_score": DEFAULT_SCORE})


def owned_orders(tables: Tables) -> DataFrame:
    """Delivered orders of known customers, under the customer's lasting id."""
    return delivered_orders(tables["orders"]).join(tables["customers"], "customer_id")


def clean_wide(tables: Tables, seen: Observation | None = None) -> DataFrame:
    """One row per delivered order, item and review.

    Items meet products before orders and reviews multiply them, so the wider rows are never exchanged
    again. Reviewed orders are written in between: as a scan they come to the last join by an exchange of
    their own, as the items do, so that Spark can split an order, or a product, with very many rows.
    ``seen`` gets the counts for ``observed_report`` while the rows are written.
    """
    described = tables["order_items"].join(filled_products(tables["products"]), "product_id")
    reviews = tables["order_reviews"]
    if seen is not None:
        reviews = reviews.withColumn(_UNSCORED, F.col("review_score").isNull())
    reviewed = owned_orders(tables).join(filled_reviews(reviews), "order_id").drop("customer_id")
    wide = described.join(stage(reviewed, "reviewed_orders"), "order_id")
    if seen is not None:
        wide = wide.observe(seen, F.count_if(_UNSCORED).alias("scores_filled"), F.count(F.lit(1)).alias("wide_rows"))
    return wide.select(*WIDE_COLUMNS)


def order_tally(tables: Tables) -> DataFrame:
    """Per raw order: whether it was delivered and how many partners it has in each other table.

    Everything is counted per key before it crosses the network, so an order or product with very
    many rows arrives as one count per task.
    """
    customers = tables["customers"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("customers"))
    items = (
        tables["order_items"]
        .groupBy("order_id", "product_id")
        .agg(F.count(F.lit(1)).alias("items"))
        .join(tables["products"].groupBy("product_id").agg(F.count(F.lit(1)).alias("products")), "product_id")
        .groupBy("order_id")
        .agg(F.sum(F.col("items") * F.col("products")).alias("items"))
    )
    reviews = (
        tables["order_reviews"]
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("reviews"), F.count_if(F.col("review_score").isNull()).alias("unscored"))
    )
    return (
        tables["orders"]
        .select(
            "order_id",
            "customer_id",
            parse_time(F.col("order_delivered_customer_date")).isNotNull().alias("delivered"),
        )
        .join(customers, "customer_id", "left")
        .join(items, "order_id", "left")
        .join(reviews, "order_id", "left")
        .select("order_id", "delivered", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("customers", "items", "reviews", "unscored")])
    )


def wide_counts(tally: DataFrame) -> DataFrame:
    """Orders read, dropped and kept, and the size of the wide table, as one row.

    The wide rows are never formed: an order contributes the product of its counts.
    """
    delivered = F.col("delivered")
    pairs = F.when(delivered, F.col("customers") * F.col("items")).otherwise(F.lit(0))
    return tally.agg(
        F.count(F.lit(1)).alias("orders_in"),
        F.count_if(~delivered).alias("orders_undelivered"),
        F.count_if(delivered).alias("orders_kept"),
        F.count_if(delivered & (F.col("reviews") == 0)).alias("orders_without_review"),
        F.coalesce(F.sum(pairs * F.col("unscored")), F.lit(0)).alias("scores_filled"),
        F.coalesce(F.sum(pairs * F.col("reviews")), F.lit(0)).alias("wide_rows"),
    )


def observed_report(tables: Tables, seen: Observation) -> DataFrame:
    """The rows of ``cleaning_report`` after the wide rows were written: their counts were taken on the way.

    Only orders, products and reviews are read, in the few columns counted; the items are not read again.
    """
    reviewed = tables["order_reviews"].select("order_id", F.lit(True).alias("reviewed")).distinct()
    delivered = parse_time(F.col("order_delivered_customer_date")).isNotNull()
    orders = tables["orders"].select("order_id", delivered.alias("delivered")).join(reviewed, "order_id", "left")
    counts = orders.agg(
        F.count(F.lit(1)).alias("orders_in"),
        F.count_if(~F.col("delivered")).alias("orders_undelivered"),
        F.count_if("delivered").alias("orders_kept"),
        F.count_if(F.col("delivered") & F.col("reviewed").isNull()).alias("orders_without_review"),
    )
    found = seen.get
    return _report(counts.withColumns({name: F.lit(found[name]) for name in ("scores_filled", "wide_rows")}), tables)


def cleaning_report(tables: Tables) -> DataFrame:
    """What cleaning read, dropped, filled and kept, as (metric, value) rows."""
    return _report(wide_counts(order_tally(tables)), tables)


def _report(counts: DataFrame, tables: Tables) -> DataFrame:
    unfilled = tables["products"].agg(
        F.count_if(F.col("product_category_name").isNull()).alias("categories_filled")
    )
    unscored = tables["order_reviews"].agg(F.count_if(F.col("review_score").isNull()).alias("reviews_unscored"))
    return (
        metric_rows(counts)
        .unionByName(metric_rows(unfilled))
        .unionByName(metric_rows(unscored))
    )


def metric_rows(one_row: DataFrame) -> DataFrame:
    """A one-row frame of counts turned into (metric, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in one_row.columns])
    return one_row.select(F.explode(pairs).alias("pair")).select("pair.metric", "pair.value")


def with_time_text(df: DataFrame, columns=ORDER_TIMES) -> DataFrame:
    """Times as ``yyyy-MM-dd HH:mm:ss`` text, for export."""
    return df.withColumns({c: time_text(F.col(c)) for c in columns})
