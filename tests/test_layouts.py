"""Layouts for lookups, the binned join and the counted stream."""

import random
import re

from pyspark.sql import functions as F

from basketmill.operators import relational, stock
from basketmill.session import entries_of, new_path
from basketmill.sources import layouts
from basketmill.streaming import counted, reservation
from conftest import rows
from test_plans import QUERIES, plan_of
from test_stock import requests, served, stock_table
from test_streaming import files_of


def rows_read(df):
    """Rows that the scans gave, by their metrics; the plan must have no exchange."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_reads_one_row_group(spark):
    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(1_000_000)) * 2).alias("k"), F.col("id").alias("v"))
    found = layouts.write_sorted(df, new_path(spark, "sorted"), "k", files=4, group_rows=5000)
    assert found.count() == 200_000 and found.dtypes == df.dtypes
    assert len(found.inputFiles()) == 4
    key = df.first().k
    hit = found.where(F.col("k") == key)
    assert rows(hit) == rows(df.where(F.col("k") == key))
    assert 0 < rows_read(found.where(F.col("k") == key)) <= 5000  # a plan of its own: metrics add up over runs
    # An odd key lies inside the range of some group, but the filters know that it is in none.
    assert sum(rows_read(found.where(F.col("k") == k)) for k in range(1001, 1041, 2)) <= 5000


def test_stored_lookup_reads_less_than_the_table(spark, small):
    found = QUERIES["point_lookup_stored"](spark, small)
    assert "EqualTo(o_custkey,10)" in plan_of(found)


def test_buckets_join_without_exchange(spark, small):
    plan = plan_of(QUERIES["bucket_join"](spark, small))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("Bucketed: true") == 2


def test_buckets_and_crowded_keys(spark):
    left = spark.range(3000).select((F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (3, "c"), (None, "d"), (9, "e")], "k bigint, s string")
    path = new_path(spark, "buckets")
    a, b = layouts.write_buckets(left, f"{path}/a", "k", 4), layouts.write_buckets(right, f"{path}/b", "k", 4)
    met = a.join(b.hint("merge"), a["k"] == b["k"]).select(a["k"], "id", "s")
    assert "Exchange" not in plan_of(met)
    assert rows(met) == rows(left.join(right, "k").select("k", "id", "s"))
    assert rows(b) == rows(right)


def test_range_join(spark):
    rng = random.Random(4)
    points = [(i, rng.choice([rng.uniform(-50, 50), 7.0, None])) for i in range(300)]
    ranges = [(i, low, None if low is None else low + rng.choice([0.0, 0.3, 12.5, -1.0])) for i, low in enumerate(rng.choice([rng.uniform(-60, 60), 7.0, None]) for _ in range(120))]
    ranges += [(900, float("nan"), float("nan")), (901, float("-inf"), 0.0), (902, 0.0, float("inf"))]
    left = spark.createDataFrame(points, "a int, at double")
    right = spark.createDataFrame(ranges, "b int, low double, high double")
    met_by_hand = [(a, b) for a, at in points for b, low, high in ranges if b < 900 and None not in (at, low, high) and low <= at <= high]
    want = sorted(met_by_hand, key=repr)
    for width in (0.2, 3.0, 500.0):
        met = relational.range_join(left, right, F.col("at"), F.col("low"), F.col("high"), width)
        assert met.columns == ["a", "at", "b", "low", "high"]
        assert rows(met, "a", "b") == want
        assert "NestedLoop" not in plan_of(met) and "Cartesian" not in plan_of(met)


def test_range_join_near_in_a_second_number(spark):
    rng = random.Random(5)
    left = [(i, rng.choice([rng.uniform(-9, 9), 2.0, None]), rng.choice([rng.randint(-40, 40), None])) for i in range(200)]
    right = [(i, rng.choice([rng.uniform(-9, 9), 2.0, None]), rng.choice([rng.randint(-40, 40), None])) for i in range(150)]
    met_by_hand = [
        (a, b)
        for a, at, day in left
        for b, low, other in right
        if None not in (at, day, low, other) and low <= at <= low + 2 and abs(day - other) <= 3
    ]
    points = spark.createDataFrame(left, "a int, at double, day int")
    ranges = spark.createDataFrame(right, "b int, low double, other int")
    low, other = F.col("low"), F.col("other")
    for width in (1, 4, 200):
        days = (F.col("day"), other - 3, other + 3, width)
        met = relational.range_join(points, ranges, F.col("at"), low, low + 2, 2.0, days)
        assert met.columns == ["a", "at", "day", "b", "low", "other"]
        assert rows(met.where(F.abs(F.col("day") - other) <= 3), "a", "b") == sorted(met_by_hand, key=repr)
    backwards = (F.col("day"), other + 1, other - 1, 4)
    assert relational.range_join(points, ranges, F.col("at"), low, low + 2, 2.0, backwards).count() == 0


def test_price_matches_meets_few_pairs_that_it_drops(spark, tmp_path):
    """Orders and items of one price over ten years: pairs meet by their days too, not by price alone."""
    day = F.timestamp_seconds(F.col("id") * 86400)
    orders = spark.range(3650).select(F.col("id").alias("o_orderkey"), F.lit(50.0).alias("o_totalprice"), day.alias("o_orderdate"))
    lines = spark.range(3650).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2).alias("l_partkey"), F.lit(52.0).alias("l_extendedprice"), day.alias("l_shipdate")
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["price_matches"](spark, str(tmp_path))
    pairs = sum(min(i + 30, 3649) - max(i - 30, 0) + 1 for i in range(3650))
    assert found.count() == found.select("o_orderkey", "l_orderkey").distinct().count() == pairs
    assert found.where("abs(o_orderkey - l_orderkey) > 30").count() == 0
    keys = re.search(r"Join \[(.*?)\]", plan_of(found)).group(1)
    assert len(keys.split(", ")) == 2


def test_price_matches_has_no_nested_loop(spark, small):
    plan = plan_of(QUERIES["price_matches"](spark, small))
    assert "NestedLoop" not in plan and "HashJoin" in plan or "SortMergeJoin" in plan


def test_counted_stream_over_batches_and_a_restart(spark):
    wanted = [7] * 20 + [8, 9] * 8 + [7] * 9 + [None, None]
    everything = requests(spark, wanted)
    table = stock_table(spark, (7, 23), (8, 3))
    path = new_path(spark, "test-counted")

    def start(**trigger):
        stream = spark.readStream.schema(everything.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        counted.start_reservation(stream, table, f"{path}/rows", f"{path}/progress", **trigger).awaitTermination()

    half = everything.where(F.col("event_id") < 20)
    files_of(half, f"{path}/in", "event_id", 7)
    start()
    assert served(counted.settled(spark, f"{path}/rows")) == served(stock.allocate(half, table))
    rest = everything.where(F.col("event_id") >= 20)
    for low in range(20, len(wanted) + 1, 6):
        rest.where((F.col("event_id") >= low) & (F.col("event_id") < low + 6)).coalesce(1).write.mode("append").parquet(f"{path}/in")
    start()
    start()  # nothing new
    assert served(counted.settled(spark, f"{path}/rows")) == served(stock.allocate(everything, table))
    assert any(name.startswith("state") for name in _names(spark, f"{path}/progress"))


def _names(spark, folder):
    return [name for name, _ in entries_of(spark, folder)]


def test_counted_batch_run_again(spark):
    """A batch that failed after its write is run again from the state before it."""
    table = stock_table(spark, (7, 3))
    path = new_path(spark, "test-counted-again")
    batch = counted.with_counts(requests(spark, [7, 7, 8]))
    later = batch.withColumn("_seen", F.when(F.col("_seen").isNotNull(), F.col("_seen") + 2))
    for _ in range(2):
        counted.settle_batch(later, table, f"{path}/batch_id=4")
    found = counted.settled(spark, path)
    assert sorted((r.product_id, r.position) for r in found.collect()) == [(7, 3), (7, 4), (8, 3)]


def test_nothing_counted(spark):
    none = counted.settled(spark, new_path(spark, "test-counted-none"))
    assert none.count() == 0 and none.schema == reservation.SETTLED
