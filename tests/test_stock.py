from datetime import datetime, timedelta

from pyspark.sql import functions as F

from basketmill.operators import stock
from basketmill.schemas import INVENTORY
from basketmill.session import new_path
from basketmill.streaming import reservation
from conftest import rows

START = datetime(2024, 1, 1)
REQUESTS = "event_id long, ts timestamp_ntz, product_id long"


def requests(spark, products, step=timedelta(minutes=1)):
    data = [(i, START + i * step, p) for i, p in enumerate(products)]
    return spark.createDataFrame(data, REQUESTS)


def stock_table(spark, *pairs):
    return spark.createDataFrame(list(pairs), "product_id long, stock_count int")


def served(data):
    return [(r.event_id, r.position, r.seen, r.written, r.outcome) for r in sorted(data.collect(), key=lambda r: r.event_id)]


def test_ten_requests_one_by_one(spark):
    done = served(stock.allocate(requests(spark, [7] * 10), stock_table(spark, (7, 100))))
    assert [d[2] for d in done] == list(range(100, 90, -1))
    assert [d[3] for d in done] == list(range(99, 89, -1))
    assert {d[4] for d in done} == {"accepted"}


def test_more_requests_than_stock(spark):
    done = served(stock.allocate(requests(spark, [7, 8, 7, 7, 9]), stock_table(spark, (7, 2), (8, 0))))
    assert done == [
        (0, 1, 2, 1, "accepted"),
        (1, 1, 0, None, "sold out"),
        (2, 2, 1, 0, "accepted"),
        (3, 3, 0, None, "sold out"),
        (4, 1, None, None, "no stock row"),
    ]


def log(spark, reads, writes):
    data = [(i, START + timedelta(seconds=i), 7, r, w) for i, (r, w) in enumerate(zip(reads, writes))]
    return spark.createDataFrame(data, f"{REQUESTS}, read long, written long")


def test_unguarded_trace(spark):
    unguarded = log(spark, [100] * 10, [99] * 10)
    assert rows(stock.lost_updates(unguarded, F.lit(100))) == [(7, 10, 9)]
    assert rows(stock.verdict(unguarded, stock_table(spark, (7, 100)))) == [(7, 10, 10, 90, 1, 99, "lost update")]


def test_guarded_trace(spark):
    guarded = log(spark, range(100, 90, -1), range(99, 89, -1))
    assert rows(stock.lost_updates(guarded, F.lit(100))) == [(7, 10, 0)]
    assert rows(stock.verdict(guarded, stock_table(spark, (7, 100)))) == [(7, 10, 10, 90, 10, 90, "as expected")]


def test_refused_requests_and_other_writers(spark):
    sold_out = log(spark, [1, 0, 0], [0, None, None])
    assert rows(stock.verdict(sold_out, stock_table(spark, (7, 1)))) == [(7, 3, 1, 0, 1, 0, "as expected")]
    assert rows(stock.lost_updates(sold_out, F.lit(1))) == [(7, 1, 0)]
    too_low = log(spark, [100], [42])
    assert stock.verdict(too_low, stock_table(spark, (7, 100))).first().outcome == "below expected"


def test_seed_listing_and_upsert(spark):
    products = spark.createDataFrame([(i, c) for i, c in enumerate("bcaab")], "product_id long, product_category_name string")
    inventory = spark.createDataFrame(
        [(1, 5, START), (3, 0, START)], "product_id long, stock_count int, updated_at timestamp_ntz"
    )
    seeded = stock.seed(products, inventory, START, 2)
    assert rows(seeded) == [(0, 100, START), (2, 100, START)]
    assert seeded.schema.names == INVENTORY.names
    reseeded = stock.upsert(inventory, products, stock.stamped(seeded, START + timedelta(days=2)))
    assert rows(reseeded.filter("action = 'inserted'")) == [
        (k, 100, START + timedelta(days=2), "inserted") for k in (0, 2)
    ]
    listed = stock.listing(products, inventory, 3).collect()
    assert [(r.product_id, r.label) for r in listed] == [
        (3, "3 | a | stock: 0"), (1, "1 | c | stock: 5"), (2, "2 | a | stock: not initialised")
    ]
    later = START + timedelta(days=1)
    incoming = spark.createDataFrame(
        [(1, 9, START), (1, 8, later), (4, 7, later), (99, 1, later)], inventory.schema
    )
    assert rows(stock.upsert(inventory, products, incoming)) == [
        (1, 8, later, "reset"), (3, 0, START, "kept"), (4, 7, later, "inserted")
    ]
    assert rows(stock.refused(products, incoming), "product_id") == [(99,)]


def test_batches_in_order_equal_one_allocation(spark):
    wanted = [7] * 12 + [8, 9] * 5 + [7] * 4
    everything = requests(spark, wanted)
    table = stock_table(spark, (7, 13), (8, 2))
    sink = new_path(spark, "test-reservation")
    for batch, low in enumerate(range(0, len(wanted), 6)):
        part = everything.filter((F.col("event_id") >= low) & (F.col("event_id") < low + 6))
        # A batch that is run twice, as after a failure, counts once.
        for _ in range(2 if batch == 1 else 1):
            reservation.reserve_batch(part, table, sink, batch)
    assert served(reservation.settled(spark, sink)) == served(stock.allocate(everything, table))
