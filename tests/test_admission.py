"""Rules on keys and references, in batch and on a stream, against rows inserted one after another."""

import random

import pytest
from pyspark.sql import functions as F

from basketmill.operators import admission
from basketmill.schemas import Reference
from basketmill.session import new_path
from basketmill.streaming import admission as stream
from conftest import rows

SCHEMA = "batch int, seq int, o string, i int, p string, price int"
RULES = {"price_positive": "price > 0", "small": "price < 100"}
KEY = ("o", "i")
ORDER = ("batch", "seq")
REFERENCES = (Reference("items", "o", "orders"), Reference("items", "p", "products"))


def inserted(data, orders, products):
    """One row after another into an empty table."""
    taken, found = set(), []
    for row in sorted(data, key=lambda r: r[:2]):
        _, _, o, i, p, price = row
        reasons = ["price_positive"] * (price is not None and price <= 0) + ["small"] * (price is not None and price >= 100)
        reasons += ["null_key"] * (o is None or i is None)
        reasons += ["o_not_in_orders"] * (o is not None and o not in orders) + ["p_not_in_products"] * (p is not None and p not in products)
        if not reasons and (o, i) in taken:
            reasons = ["duplicate_key"]
        if not reasons:
            taken.add((o, i))
        found.append((*row, ",".join(reasons) or None))
    return sorted(found, key=repr)


def arrivals(seed, size):
    rng = random.Random(seed)
    return [
        (
            n * 4 // size,
            n,
            rng.choice([f"o{rng.randrange(12)}", "hot", None if rng.random() < 0.1 else "hot"]),
            rng.choice([1, 2, 3, None if rng.random() < 0.1 else 4]),
            rng.choice(["p1", "p2", "gone", None]),
            rng.choice([5, 7, None, 0, 100]),
        )
        for n in range(size)
    ]


@pytest.fixture
def parents(spark):
    return {
        "orders": spark.createDataFrame([(f"o{i}",) for i in range(9)] + [("hot",), ("hot",), (None,)], "o string"),
        "products": spark.createDataFrame([("p1", 1), ("p2", 2)], "p string, x int"),
    }


KNOWN = ({f"o{i}" for i in range(9)} | {"hot"}, {"p1", "p2"})


@pytest.mark.parametrize("seed", [1, 2])
def test_batch(spark, parents, seed):
    data = arrivals(seed, 400)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert rows(admission.admit(df, RULES, KEY, ORDER, REFERENCES, parents)) == inserted(data, *KNOWN)


def test_no_rows_no_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(admission.admit(empty, {}, KEY, ORDER)) == []
    twice = spark.createDataFrame([(0, 0, "a", 1, "p", 1)] * 3, SCHEMA)
    assert sorted(r.reason or "" for r in admission.admit(twice, {}, KEY, ORDER).collect()) == ["", "duplicate_key", "duplicate_key"]


@pytest.mark.parametrize("words,batches,merge", [(1 << 16, 3, 10), (2, 6, 2)])
def test_stream_equals_batch(spark, parents, monkeypatch, words, batches, merge):
    """Several batches, a restart after two, merged filters, and a filter so full that it lets everything pass."""
    monkeypatch.setattr(stream, "MERGE_EVERY", merge)
    data = [((n * batches) // 400, *row[1:]) for n, row in enumerate(arrivals(words, 400))]
    df = spark.createDataFrame(data, SCHEMA)
    path = new_path(spark, "test-admission")

    def start():
        arriving = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        stream.start_admission(
            arriving, RULES, KEY, ORDER, REFERENCES, parents, f"{path}/out", f"{path}/progress", words=words
        ).awaitTermination()

    for batch in range(batches):
        df.where(F.col("batch") == batch).coalesce(1).write.mode("append").parquet(f"{path}/in")
        if batch == 1:
            start()
    start()
    kept = stream.admitted(spark, f"{path}/out", df.schema)
    out = stream.refused(spark, f"{path}/out", df.schema)
    want = rows(admission.admit(df, RULES, KEY, ORDER, REFERENCES, parents))
    assert want == inserted(data, *KNOWN)
    assert sorted([*rows(kept.withColumn("reason", F.lit(None).cast("string"))), *rows(out)], key=repr) == want
    assert spark.read.parquet(f"{path}/out/keys").select(*KEY).distinct().count() == kept.count()


def judge(batch, batch_id, parents, sink, **named):
    stream.admit_batch(batch, RULES, KEY, ORDER, REFERENCES, parents, sink, batch_id, **named)


def test_a_batch_run_again_changes_nothing(spark, parents):
    data = arrivals(5, 120)
    df = spark.createDataFrame(data, SCHEMA)
    sink = new_path(spark, "test-again")
    for batch in (0, 0, 1, 1, 2, 3, 3):
        judge(df.where(F.col("batch") == batch), batch, parents, sink)
    found = [*rows(stream.admitted(spark, sink, df.schema).withColumn("reason", F.lit(None).cast("string"))), *rows(stream.refused(spark, sink, df.schema))]
    assert sorted(found, key=repr) == inserted(data, *KNOWN)


def test_new_keys_do_not_read_the_stored_ones(spark, parents, monkeypatch):
    sink = new_path(spark, "test-filter")
    first = [(0, n, f"o{n % 9}", n, "p1", 5) for n in range(200)]
    new = [(1, n, f"o{n % 9}", n + 1000, "p1", 5) for n in range(200)]
    old = [(2, 0, "o0", 0, "p1", 5)]
    judge(spark.createDataFrame(first, SCHEMA), 0, parents, sink)
    read, real = [], stream._versions

    def watched(spark_, sink_, kind, batches, schema):
        read.append((kind, len(batches)))
        return real(spark_, sink_, kind, batches, schema)

    monkeypatch.setattr(stream, "_versions", watched)
    judge(spark.createDataFrame(new, SCHEMA), 1, parents, sink)
    assert ("keys", 1) not in read[:-1]  # only its own keys, for the filter
    read.clear()
    judge(spark.createDataFrame(old, SCHEMA), 2, parents, sink)
    assert ("keys", 2) in read
    assert rows(stream.refused(spark, sink, spark.createDataFrame([], SCHEMA).schema)) == [(*old[0], "duplicate_key")]


def test_filter_has_no_false_negative(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("_hash"), F.col("id"))
    for words in (16, 1 << 12):
        passed = stream._possible(keys, stream.bloom(keys.where("id < 2500"), words), words)
        got = {r.id for r in passed.collect()}
        assert got >= set(range(2500))
        if words > 16:
            assert len(got) < 2520  # of 2,500 new keys nearly none passes
