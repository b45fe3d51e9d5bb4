"""The normal form of the wide table."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, functions as F

from basketmill.operators.cleaning import Tables, filled_products, filled_reviews, owned_orders
from basketmill.operators.relational import owned_by, present_in
from basketmill.schemas import NORMAL_FORM, Projection
from basketmill.session import stage


def project(df: DataFrame, spec: Projection) -> DataFrame:
    """The distinct rows of ``df`` in the columns and types of ``spec``."""
    return df.select(
        *[F.col(c).cast(spec.casts[c]).alias(c) if c in spec.casts else F.col(c) for c in spec.columns]
    ).distinct()


def decompose(wide: DataFrame, specs: Mapping[str, Projection] = NORMAL_FORM) -> dict[str, DataFrame]:
    """Split a stored wide table; each projection scans only its own columns."""
    return {name: project(wide, spec) for name, spec in specs.items()}


def known_products(tables: Tables) -> DataFrame:
    """The product rows without copies."""
    return project(filled_products(tables["products"]), NORMAL_FORM["products"])


def listed_items(tables: Tables) -> DataFrame:
    """Items of known products."""
    return owned_by(tables["order_items"], known_products(tables), ["product_id"])


def kept_orders(tables: Tables, listed: DataFrame | None = None) -> DataFrame:
    """Orders of the wide table without widening: those that find partners in all other tables.

    ``listed`` may be the listed items as a stored table.
    """
    listed = listed_items(tables) if listed is None else listed
    orders = present_in(owned_orders(tables), listed, ["order_id"])
    return project(present_in(orders, tables["order_reviews"], ["order_id"]), NORMAL_FORM["orders"])


def normal_form(tables: Tables, names: Collection[str] = tuple(NORMAL_FORM)) -> dict[str, DataFrame]:
    """The named ones of the same five tables, straight from the raw ones.

    A row of a raw table reaches the wide table exactly when it finds partners in all the others, so
    its projection is a chain of semi joins. No row is multiplied, and only keys are exchanged
    besides the table itself. What several tables follow from is written once and read back: the listed items, read from the
    raw table once, and the orders and kept items where more than one other needs them. The rest is left to its reader.
    As scans the stored tables can also meet crowded partners in a join that Spark is able to split.
    """
    wanted = set(names)
    of_items, of_orders = wanted & {"order_items", "products"}, wanted - {"order_items", "products"}
    listed = None
    if of_items:
        listed = listed_items(tables)
        listed = project(listed, NORMAL_FORM["order_items"]) if "order_items" in wanted else listed.select("order_id", "product_id").distinct()
        listed = stage(listed, "listed_items")
    orders = kept_orders(tables, listed)
    if len(of_orders) + bool(of_items) > 1:
        orders = stage(orders, "orders")
    made = {
        "customers": lambda: project(orders, NORMAL_FORM["customers"]),
        "orders": lambda: orders,
        "order_reviews": lambda: project(owned_by(filled_reviews(tables["order_reviews"]), orders, ["order_id"]), NORMAL_FORM["order_reviews"]),
    }
    if of_items:
        items = owned_by(listed, orders, ["order_id"])
        if len(of_items) > 1:
            items = stage(items, "order_items")
        made["order_items"] = lambda: items
        made["products"] = lambda: project(present_in(known_products(tables), items, ["product_id"]), NORMAL_FORM["products"])
    return {name: made[name]() for name in NORMAL_FORM if name in wanted}
