"""Small raw retail tables with every kind of flaw, and a plain Python version of cleaning."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime
from decimal import Decimal

from basketmill.schemas import RAW


def raw_rows() -> dict[str, list[tuple]]:
    return {
        "customers": [("c1", "u1"), ("c2", "u2"), ("c3", "u1")],
        "orders": [
            ("o1", "c1", "2017-01-05 10:00:00", "2017-01-20 00:00:00", "2017-01-15 00:00:00"),
            ("o2", "c2", "2017-11-05 10:00:00", "2017-11-07 00:00:00", "2017-11-15 00:00:00"),
            ("o3", "c3", "2018-05-05 10:00:00", "2018-05-07 00:00:00", "2018-05-09 00:00:00"),
            ("o4", "c1", "2017-02-05 10:00:00", None, "2017-02-15 00:00:00"),
            ("o5", "c1", "2017-03-05 10:00:00", "not a time", "2017-03-15 00:00:00"),
            ("o6", "c1", "2017-04-05 10:00:00", "2017-04-07 00:00:00", "2017-04-15 00:00:00"),
            ("o7", "cX", "2017-04-05 10:00:00", "2017-04-07 00:00:00", "2017-04-15 00:00:00"),
        ],
        "order_items": [
            ("o1", 1, "p1", Decimal("100.00"), Decimal("10.00")),
            ("o1", 2, "p2", Decimal("50.00"), Decimal("60.00")),
            ("o2", 1, "p1", Decimal("80.00"), Decimal("20.00")),
            ("o3", 1, "p3", Decimal("0.00"), Decimal("5.00")),
            ("o4", 1, "p1", Decimal("10.00"), Decimal("1.00")),
            ("o5", 1, "p1", Decimal("10.00"), Decimal("1.00")),
            ("o6", 1, "p1", Decimal("10.00"), Decimal("1.00")),
            ("o7", 1, "p1", Decimal("10.00"), Decimal("1.00")),
            ("o2", 2, "pX", Decimal("10.00"), Decimal("1.00")),
        ],
        "products": [("p1", "chairs"), ("p2", None), ("p3", "soap"), ("p4", "lamps")],
        "order_reviews": [
            ("r1", "o1", 2),
            ("r2", "o1", None),
            ("r3", "o2", 5),
            ("r4", "o3", 4),
            ("r5", "o4", 1),
            ("r6", "o7", 1),
            ("r7", "oX", 1),
        ],
    }


def frames(spark, data=None):
    data = raw_rows() if data is None else data
    return {name: spark.createDataFrame(data[name], RAW[name]) for name in RAW}


def random_rows(seed: int, n: int = 60) -> dict[str, list[tuple]]:
    """Tables with repeated keys, missing partners, missing values and exact copies."""
    rng = random.Random(seed)

    def maybe(value, share=0.15):
        return None if rng.random() < share else value

    def time():
        return f"201{rng.randint(6, 8)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 10:00:00"

    ids = [f"o{i}" for i in range(n // 3)]
    items = [
        (rng.choice(ids), rng.randint(1, 3), f"p{rng.randint(0, 9)}", Decimal(rng.randint(0, 500)) / 100, Decimal(rng.randint(0, 500)) / 100)
        for _ in range(n)
    ]
    return {
        "customers": [(f"c{rng.randint(0, 12)}", f"u{rng.randint(0, 6)}") for _ in range(12)],
        "orders": [(o, f"c{rng.randint(0, 14)}", time(), maybe(time()), time()) for o in ids + ids[:3]],
        "order_items": items + items[:10],
        "products": [(f"p{i}", maybe(rng.choice(["chairs", "soap", "lamps"]))) for i in (0, 1, 2, 3, 4, 5, 6, 7, 7)],
        "order_reviews": [(f"r{rng.randint(0, 30)}", rng.choice([*ids, "oX"]), maybe(rng.randint(1, 5))) for _ in range(n // 2)],
    }


def parse(text):
    try:
        return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
    except (TypeError, ValueError):
        return None


def widen(data) -> list[tuple]:
    """The wide rows by nested loops."""
    wide = []
    for order, customer, bought, delivered, promised in data["orders"]:
        if parse(delivered) is None:
            continue
        for customer_id, unique in data["customers"]:
            if customer_id != customer:
                continue
            for item_order, number, product, price, freight in data["order_items"]:
                if item_order != order:
                    continue
                for product_id, category in data["products"]:
                    if product_id != product:
                        continue
                    for review, review_order, score in data["order_reviews"]:
                        if review_order == order:
                            wide.append(
                                (
                                    order, number, unique, parse(bought), parse(delivered), parse(promised),
                                    product, category or "Unknown", price, freight, review,
                                    3 if score is None else score,
                                )
                            )
    return wide


def bag(rows) -> Counter:
    return Counter(tuple(str(v) if isinstance(v, Decimal) else v for v in r) for r in rows)


def as_money(wide):
    """Prices with two digits, as the tables hold them."""
    return [tuple(v.quantize(Decimal("0.01")) if isinstance(v, Decimal) else v for v in r) for r in wide]
