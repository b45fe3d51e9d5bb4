"""What the retail tables look like: types, keys, references, rules and dependencies.

Everything here is data. The operators take these specs as arguments, so the same code checks any
other set of tables described the same way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


MONEY = DecimalType(10, 2)
TEXT = StringType()
TIME = TimestampNTZType()

# Defaults for missing values (fixed values).
UNKNOWN_CATEGORY = "Unknown"
DEFAULT_SCORE = 3

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Raw files, in the columns the cleaning job reads. Times stay text until they are parsed.
RAW = {
    "customers": struct(customer_id=TEXT, customer_unique_id=TEXT),
    "orders": struct(
        order_id=TEXT,
        customer_id=TEXT,
        order_purchase_timestamp=TEXT,
        order_delivered_customer_date=TEXT,
        order_estimated_delivery_date=TEXT,
    ),
    "order_items": struct(
        order_id=TEXT, order_item_id=IntegerType(), product_id=TEXT, price=MONEY, freight_value=MONEY
    ),
    "products": struct(product_id=TEXT, product_category_name=TEXT),
    "order_reviews": struct(review_id=TEXT, order_id=TEXT, review_score=IntegerType()),
}

WIDE = struct(
    order_id=TEXT,
    order_item_id=IntegerType(),
    customer_unique_id=TEXT,
    order_purchase_timestamp=TIME,
    order_delivered_customer_date=TIME,
    order_estimated_delivery_date=TIME,
    product_id=TEXT,
    product_category_name=TEXT,
    price=MONEY,
    freight_value=MONEY,
    review_id=TEXT,
    review_score=IntegerType(),
)
WIDE_COLUMNS = tuple(WIDE.names)

INVENTORY = struct(product_id=TEXT, stock_count=IntegerType(), updated_at=TIME)

# Raw tables whose cells may hold line breaks.
FREE_TEXT = ("order_reviews",)


@dataclass(frozen=True)
class Projection:
    """One table of the normal form: which wide columns it keeps, its key, casts on the way."""

    columns: tuple[str, ...]
    key: tuple[str, ...]
    casts: dict = field(default_factory=dict)


NORMAL_FORM = {
    "customers": Projection(("customer_unique_id",), ("customer_unique_id",)),
    "products": Projection(("product_id", "product_category_name"), ("product_id",)),
    "orders": Projection(("order_id", "customer_unique_id", *ORDER_TIMES), ("order_id",)),
    "order_items": Projection(
        ("order_id", "order_item_id", "product_id", "price", "freight_value"),
        ("order_id", "order_item_id"),
    ),
    "order_reviews": Projection(
        ("review_id", "order_id", "review_score"),
        ("review_id", "order_id"),
        {"review_score": ShortType()},
    ),
}

# A key that names every wide row when item numbers repeat inside an order.
WIDE_KEY = ("order_id", "order_item_id", "review_id")
WIDE_ORDER = ("order_id", "order_item_id", "review_id", "product_id", "price", "freight_value")


@dataclass(frozen=True)
class Reference:
    """``child.column`` must appear in ``parent.column``."""

    child: str
    column: str
    parent: str


REFERENCES = (
    Reference("orders", "customer_unique_id", "customers"),
    Reference("order_items", "order_id", "orders"),
    Reference("order_items", "product_id", "products"),
    Reference("order_reviews", "order_id", "orders"),
)


@dataclass(frozen=True)
class Dependency:
    """``left`` determines ``right`` inside ``table``."""

    name: str
    table: str
    left: tuple[str, ...]
    right: tuple[str, ...]


DEPENDENCIES = (
    Dependency("FD1", "orders", ("order_id",), ("customer_unique_id", *ORDER_TIMES)),
    Dependency(
        "FD2", "order_items", ("order_id", "order_item_id"), ("product_id", "price", "freight_value")
    ),
    Dependency("FD3", "products", ("product_id",), ("product_category_name",)),
    Dependency("FD4", "order_reviews", ("review_id", "order_id"), ("review_score",)),
)

# Rules as SQL predicates; a rule that evaluates to null counts as kept.
ITEM_RULES = {
    "order_item_id_positive": "order_item_id > 0",
    "price_not_negative": "price >= 0",
    "freight_not_negative": "freight_value >= 0",
}
FREIGHT_RULE = {"freight_not_above_price": "freight_value <= price"}
REVIEW_RULES = {"score_in_range": "review_score BETWEEN 1 AND 5"}
STOCK_RULES = {"stock_not_negative": "stock_count >= 0"}
PRODUCT_RULES = {"category_fits": "length(product_category_name) <= 100"}
ID_LENGTH = 32


def id_rules(*columns: str) -> dict[str, str]:
    """Declared text width of identifier columns."""
    return {f"{c}_fits": f"length(cast({c} as string)) <= {ID_LENGTH}" for c in columns}


# Columns a role may not see.
COLUMN_POLICY = {"admin": (), "analyst": ("freight_value",)}
