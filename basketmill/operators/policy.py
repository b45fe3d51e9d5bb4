"""Views that leave out the columns a role may not see.

Spark itself grants and revokes nothing; whoever may read the base files can read every column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from basketmill.schemas import COLUMN_POLICY

PUBLIC_VIEW = "v_public_order_items"


def visible(df: DataFrame, role: str, policy: Mapping[str, Sequence[str]] = COLUMN_POLICY) -> DataFrame:
    """``df`` without the columns hidden from ``role``; an unknown role is refused."""
    if role not in policy:
        raise ValueError(f"no column policy for role {role}")
    return df.drop(*policy[role])


def with_category(items: DataFrame, products: DataFrame) -> DataFrame:
    return items.join(products, "product_id").select(
        "order_id", "order_item_id", "product_id", "product_category_name", "price", "freight_value"
    )


def create_public_view(items: DataFrame, products: DataFrame, name: str = PUBLIC_VIEW) -> None:
    visible(with_category(items, products), "analyst").createOrReplaceTempView(name)
