import random

import pytest
from pyspark.sql import functions as F

from basketmill.operators import ordering
from conftest import rows

SCHEMA = "g string, t int, id int, v int"
MERGING = "spark.sql.adaptive.coalescePartitions.enabled"


def with_all_parts(spark):
    """Few rows would otherwise be merged into one part at run time."""
    spark.conf.set(MERGING, "false")


def crowd(seed=1, n=600):
    """A third of the rows in one group, a null group, and many small ones."""
    rng = random.Random(seed)
    groups = ["hot"] * (n // 3) + [None] * 20 + [f"g{rng.randint(0, 40)}" for _ in range(n - n // 3 - 20)]
    data = [(g, rng.randint(0, 30), i, rng.randint(0, 9)) for i, g in enumerate(groups)]
    rng.shuffle(data)
    return data


def expected_rank(data):
    out = []
    for g in {r[0] for r in data}:
        members = sorted((r for r in data if r[0] == g), key=lambda r: (r[1], r[2]))
        before = None
        for place, r in enumerate(members, 1):
            out.append((*r, place, -1 if before is None else before))
            before = r[3]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_rank_and_previous(spark, seed):
    data = crowd(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    want = expected_rank(data)
    ranked = ordering.rank_in_group(df, ["g"], ["t", "id"], "place")
    assert rows(ranked) == sorted([r[:5] for r in want], key=repr)
    before = ordering.previous_in_group(df, ["g"], ["t", "id"], "v", "before", F.lit(-1))
    assert rows(before) == sorted([(*r[:4], r[5]) for r in want], key=repr)


def test_one_group_over_many_parts(spark):
    """A group longer than several parts, with small ones before and after it."""
    data = [("a", i, i, i) for i in range(3)] + [("hot", i, i, i % 10) for i in range(3000)] + [(None, 1, 1, 1), ("z", 1, 1, 5)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    want = expected_rank(data)
    with_all_parts(spark)
    try:
        assert rows(ordering.rank_in_group(df, ["g"], ["t", "id"], "place")) == sorted([r[:5] for r in want], key=repr)
        before = ordering.previous_in_group(df, ["g"], ["t", "id"], "v", "before", F.lit(-1))
        assert rows(before) == sorted([(*r[:4], r[5]) for r in want], key=repr)
    finally:
        spark.conf.unset(MERGING)


def test_task_sizes_with_a_crowded_group(spark):
    """The windows run inside a part: no task holds the group."""
    df = spark.range(8000).select(F.lit("hot").alias("g"), F.col("id").alias("t"))
    with_all_parts(spark)
    try:
        ranked = ordering.rank_in_group(df, ["g"], ["t"], "place")
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 8000
        assert [r.place for r in ranked.orderBy("t").collect()] == list(range(1, 8001))
    finally:
        spark.conf.unset(MERGING)


def test_a_crowded_group_is_spread_over_parts(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.col("id").alias("t"))
    with_all_parts(spark)
    try:
        placed = ordering._place(df, ["g", "t"], "spread")
    finally:
        spark.conf.unset(MERGING)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 3000


def test_numbers_are_dense_and_ordered(spark):
    data = crowd(5)
    df = spark.createDataFrame(data, SCHEMA)
    numbered = [tuple(r) for r in ordering.number_rows(df, ["t", "id"], "n").collect()]
    assert [r[1:] for r in sorted(numbered)] == sorted(data, key=lambda r: (r[1], r[2]))
    assert sorted(r[0] for r in numbered) == list(range(1, len(data) + 1))


def test_nothing_in_nothing_out(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ordering.number_rows(df, ["t", "id"], "n").count() == 0
    assert ordering.rank_in_group(df, ["g"], ["t"], "n").count() == 0
    assert ordering.previous_in_group(df, ["g"], ["t"], "v", "n", F.lit(0)).count() == 0
