"""Analyst tables over the normal form."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketmill.functions.labels import group_label, in_years, quarter_label, safe_ratio
from basketmill.functions.parsing import parse_time
from basketmill.operators.cleaning import Tables, clean_wide, filled_reviews, owned_orders
from basketmill.operators.modelling import kept_orders, known_products, listed_items, project
from basketmill.operators.policy import visible, with_category
from basketmill.operators.relational import owned_by, present_in, top
from basketmill.schemas import NORMAL_FORM, WIDE_COLUMNS
from basketmill.session import stage

LATE, ON_TIME = "late", "on_time"


def headline_metrics(model: Tables) -> DataFrame:
    """Orders, customers and the mean score, as one row."""
    parts = [
        model["orders"].agg(F.count(F.lit(1)).alias("total_orders")),
        model["customers"].agg(F.count(F.lit(1)).alias("total_customers")),
        model["order_reviews"].agg(F.round(F.avg("review_score"), 2).alias("avg_score")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in ("total_orders", "total_customers", "avg_score")])


def period_orders(tables: Tables, first_year: int, last_year: int) -> DataFrame:
    """Delivered orders of known customers bought in the period, without copies."""
    owned = owned_orders({**tables, "orders": tables["orders"].filter(_in_period(first_year, last_year))})
    return project(owned, NORMAL_FORM["orders"])


def _in_period(first_year: int, last_year: int) -> Column:
    return in_years(parse_time(F.col("order_purchase_timestamp")), first_year, last_year)


def period_items(tables: Tables, orders: DataFrame) -> DataFrame:
    """The distinct items of ``orders`` whose product is known: the period is cut before items meet products."""
    items = owned_by(tables["order_items"], orders, ["order_id"])
    return project(owned_by(items, known_products(tables), ["product_id"]), NORMAL_FORM["order_items"])


def _reviewed_orders(tables: Tables, first_year: int, last_year: int) -> DataFrame:
    """Orders of the period with their delivery status and their scores already summed per order.

    The join with the scores drops orders without a review; orders without a listed item are dropped by key.
    """
    reviews = project(filled_reviews(tables["order_reviews"]), NORMAL_FORM["order_reviews"])
    scores = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("score_count")
    )
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    orders = stage(period_orders(tables, first_year, last_year), "period_orders")
    items = owned_by(tables["order_items"].select("order_id", "product_id"), orders, ["order_id"])
    listed = owned_by(items, known_products(tables), ["product_id"])
    return (
        present_in(orders, listed, ["order_id"])
        .join(scores, "order_id")
        .withColumn("delivery_status", F.when(late, F.lit(LATE)).otherwise(F.lit(ON_TIME)))
    )


def delivery_satisfaction(tables: Tables, first_year: int, last_year: int) -> DataFrame:
    """Mean score per review and number of orders, late against on time."""
    return (
        _reviewed_orders(tables, first_year, last_year)
        .groupBy("delivery_status")
        .agg(
            F.round(F.try_divide(F.sum("score_sum"), F.sum("score_count")), 2).alias("avg_score"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )


def delivery_satisfaction_by_order(tables: Tables, first_year: int, last_year: int) -> DataFrame:
    """The same with every order weighing one, whatever its number of reviews."""
    return (
        _reviewed_orders(tables, first_year, last_year)
        .groupBy("delivery_status")
        .agg(
            F.round(F.avg(F.try_divide(F.col("score_sum"), F.col("score_count"))), 2).alias("avg_score"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )


def score_gap(satisfaction: DataFrame, threshold: float = 1.0) -> DataFrame:
    """On time minus late, and whether it exceeds the threshold; no row unless both are there."""

    def score(status: str):
        return F.max(F.when(F.col("delivery_status") == status, F.col("avg_score")))

    return (
        satisfaction.agg(score(ON_TIME).alias("on_time_score"), score(LATE).alias("late_score"))
        .filter(F.col("on_time_score").isNotNull() & F.col("late_score").isNotNull())
        .withColumn("score_gap", F.round(F.col("on_time_score") - F.col("late_score"), 2))
        .withColumn(
            "verdict",
            F.when(F.col("score_gap") > threshold, F.lit("above threshold")).otherwise(F.lit("not above threshold")),
        )
    )


def category_repurchase(
    tables: Tables, groups: Mapping[str, Sequence[str]], first_year: int, last_year: int
) -> DataFrame:
    """Per category group: mean spend of a customer, share with two or more orders, customers."""
    members = [name for names in groups.values() for name in names]
    wanted = known_products(tables).filter(F.col("product_category_name").isin(*members)).select(
        "product_id", group_label(F.col("product_category_name"), groups).alias("category_group")
    )
    orders = stage(present_in(period_orders(tables, first_year, last_year), tables["order_reviews"], ["order_id"]), "period_orders")
    # Spend per order and group first: a product sold a million times shrinks before orders join. An order
    # with such spend has a listed item, so no other lookup of its items is needed.
    items = project(owned_by(tables["order_items"], orders, ["order_id"]), NORMAL_FORM["order_items"])
    spend = (
        items.join(wanted, "product_id")
        .groupBy("order_id", "category_group")
        .agg(F.sum(F.col("price") + F.col("freight_value")).alias("amount"))
    )
    per_customer = (
        orders.join(spend, "order_id")
        .groupBy("category_group", "customer_unique_id")
        .agg(F.count_distinct("order_id").alias("order_count"), F.sum("amount").alias("total_amount"))
    )
    return per_customer.groupBy("category_group").agg(
        F.round(F.avg(F.col("total_amount").cast("double")), 2).alias("avg_amount"),
        F.round(F.count_if(F.col("order_count") >= 2) * F.lit(100.0) / F.count(F.lit(1)), 2).alias("repurchase_rate"),
        F.count(F.lit(1)).alias("customer_count"),
    )


def _priced_orders(tables: Tables, year: int, per_order: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Quarter and ``per_order`` of its priced items for every kept order of the year that has one."""
    orders = stage(present_in(period_orders(tables, year, year), tables["order_reviews"], ["order_id"]), "period_orders")
    values = per_order(period_items(tables, orders).filter(F.col("price") > 0).groupBy("order_id"))
    return orders.select("order_id", F.quarter("order_purchase_timestamp").alias("quarter")).join(values, "order_id")


def freight_by_quarter(tables: Tables, year: int) -> DataFrame:
    """Mean freight share of the price per item, by quarter of purchase."""
    ratio = safe_ratio(F.col("freight_value"), F.col("price"))
    sums = (F.sum(ratio).alias("ratio_sum"), F.count(ratio).alias("ratio_count"), F.count(F.lit(1)).alias("items"))
    return (
        _priced_orders(tables, year, lambda items: items.agg(*sums))
        .groupBy("quarter")
        .agg(
            F.round(F.try_divide(F.sum("ratio_sum"), F.sum("ratio_count")) * 100, 2).alias("freight_ratio"),
            F.sum("items").alias("item_count"),
        )
        .withColumn("quarter_label", quarter_label(F.col("quarter")))
        .orderBy("quarter")
    )


def freight_by_quarter_by_order(tables: Tables, year: int) -> DataFrame:
    """The same with the share taken per order, each order weighing one."""
    sums = (F.sum("freight_value").alias("freight"), F.sum("price").alias("price"))
    return (
        _priced_orders(tables, year, lambda items: items.agg(*sums))
        .groupBy("quarter")
        .agg(
            F.round(F.avg(safe_ratio(F.col("freight"), F.col("price"))) * 100, 2).alias("freight_ratio"),
            F.count(F.lit(1)).alias("order_count"),
        )
        .withColumn("quarter_label", quarter_label(F.col("quarter")))
        .orderBy("quarter")
    )


def q4_freight_gap(by_quarter: DataFrame) -> DataFrame:
    """The fourth quarter against the plain mean of the first three; no row without a fourth quarter."""
    ratio = F.col("freight_ratio")
    return (
        by_quarter.agg(
            F.max(F.when(F.col("quarter") == 4, ratio)).alias("q4_ratio"),
            F.avg(F.when(F.col("quarter") < 4, ratio)).alias("q123"),
        )
        .filter(F.col("q4_ratio").isNotNull())
        .select(
            "q4_ratio",
            F.round("q123", 4).alias("q123_ratio"),
            F.round(F.col("q4_ratio") - F.col("q123"), 4).alias("difference"),
            F.when(F.col("q4_ratio") > F.col("q123"), F.lit("higher")).otherwise(F.lit("not higher")).alias("verdict"),
        )
    )


def _first_ids(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The order ids of the first rows, ``n`` different ones or all, as a stored table."""
    firsts = rows.groupBy("order_id").agg(F.min(F.struct(*order)).alias("_place"))
    return stage(top(firsts, n, F.col("_place"), F.col("order_id")).select("order_id"), "first_ids")


def wide_sample(tables: Tables, n: int = 50) -> DataFrame:
    """The first ``n`` rows of orders, items, products and reviews together, by order id.

    Every kept order has at least one row, so only the first ``n`` order ids are joined, with all order rows
    under them.
    """
    ids = _first_ids(kept_orders(tables), n, F.col("order_id"))
    narrowed = dict(tables)
    for name in ("orders", "order_items", "order_reviews"):
        narrowed[name] = tables[name].join(ids, "order_id", "left_semi")
    first = project(owned_orders(narrowed), NORMAL_FORM["orders"])
    items = project(narrowed["order_items"], NORMAL_FORM["order_items"])
    reviews = project(filled_reviews(narrowed["order_reviews"]), NORMAL_FORM["order_reviews"])
    rows = first.join(items, "order_id").join(known_products(tables), "product_id").join(reviews, "order_id").select(
        "order_id",
        "customer_unique_id",
        "order_purchase_timestamp",
        "order_item_id",
        "product_category_name",
        "price",
        "freight_value",
        "review_score",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return top(rows, n, *[F.col(c) for c in (
        "order_id", "order_item_id", "product_category_name", "price", "freight_value", "review_score",
        "customer_unique_id", "order_purchase_timestamp", "order_delivered_customer_date",
        "order_estimated_delivery_date")])


def latest_rows(tables: Tables, n: int = 10) -> DataFrame:
    """The ``n`` wide rows bought last.

    They belong to the ``n`` kept order ids bought last, so only those are widened.
    """
    bought = F.col("order_purchase_timestamp").desc()
    newest = top(kept_orders(tables).groupBy("order_id").agg(F.max("order_purchase_timestamp").alias("order_purchase_timestamp")), n, bought, F.col("order_id"))
    ids = stage(newest.select("order_id"), "newest_orders")
    narrowed = dict(tables)
    for name in ("orders", "order_items", "order_reviews"):
        narrowed[name] = tables[name].join(ids, "order_id", "left_semi")
    rest = [c for c in WIDE_COLUMNS if c not in ("order_id", "order_purchase_timestamp")]
    return top(clean_wide(narrowed), n, bought, F.col("order_id"), *map(F.col, rest)).select(
        "order_id", "order_item_id", "customer_unique_id", "product_category_name", "price", "freight_value",
        "review_score", "order_purchase_timestamp",
    )


def item_listing(tables: Tables, role: str, n: int = 200) -> DataFrame:
    """The last ``n`` items by order and item number, in the columns ``role`` may see.

    Every kept order has an item and every listed item its product, so the last ``n`` different order ids are
    picked first, then the last of their items, and only those meet the products.
    """
    ids = stage(top(kept_orders(tables).select("order_id").distinct(), n, F.col("order_id").desc()), "last_orders")
    narrowed = {**tables, "order_items": tables["order_items"].join(ids, "order_id", "left_semi")}
    items = project(listed_items(narrowed), NORMAL_FORM["order_items"])
    newest_first = (F.col("order_id").desc(), F.col("order_item_id").desc())
    own = [F.col(c) for c in visible(items, role).columns if c not in ("order_id", "order_item_id")]
    picked = top(items, n, *newest_first, *own)
    shown = visible(with_category(picked, known_products(tables)), role)
    rest = [F.col(c) for c in shown.columns if c not in ("order_id", "order_item_id")]
    return top(shown, n, *newest_first, *rest)


def next_item_id(model: Tables) -> DataFrame:
    """For every order and product in it, the next free item number of the order.

    One row per order and product with its last number, and from these the order's. Both are written, so that
    an order with very many products comes to their join by an exchange that Spark can split.
    """
    pairs = model["order_items"].groupBy("order_id", "product_id").agg(F.max("order_item_id").alias("last_id"))
    pairs = stage(pairs, "order_products")
    last = stage(pairs.groupBy("order_id").agg(F.max("last_id").alias("last_id")), "last_items")
    return (
        pairs.drop("last_id")
        .join(model["products"], "product_id")
        .join(last, "order_id")
        .select(
            "order_id",
            (F.coalesce(F.col("last_id"), F.lit(0)) + 1).alias("next_order_item_id"),
            "product_id",
            "product_category_name",
        )
    )
