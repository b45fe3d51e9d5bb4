from decimal import Decimal

from pyspark.sql import functions as F

from basketmill.operators import gate as batch_gate, stock
from basketmill.schemas import FREIGHT_RULE
from basketmill.session import new_path
from basketmill.streaming import gate, reservation
from conftest import rows
from test_stock import requests, served, stock_table


def files_of(df, path, key, step):
    """One file per range of ``key``, written in order."""
    top = df.agg(F.max(key)).first()[0]
    for low in range(0, top + 1, step):
        df.filter((F.col(key) >= low) & (F.col(key) < low + step)).coalesce(1).write.mode("append").parquet(path)


def test_gate_sinks_equal_the_batch_gate(spark):
    data = [(i, Decimal(i % 7), Decimal(i % 5)) for i in range(60)]
    df = spark.createDataFrame(data, "id int, price decimal(10,2), freight_value decimal(10,2)")
    path = new_path(spark, "test-gate")
    files_of(df, f"{path}/in", "id", 15)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    for _ in range(2):  # a restart finds nothing new
        gate.start_gate(stream, FREIGHT_RULE, f"{path}/rows", f"{path}/progress").awaitTermination()
    valid, rejected = batch_gate.split(df, FREIGHT_RULE)
    got_valid = gate.read_sink(spark, f"{path}/rows", df.schema, gate.VALID)
    got_rejected = gate.read_sink(spark, f"{path}/rows", df.schema, gate.REJECTED)
    assert rows(got_valid) == rows(valid) and rows(got_rejected) == rows(rejected)
    assert got_valid.count() + got_rejected.count() == 60
    written = spark.read.parquet(f"{path}/rows")
    assert written.select("batch_id").distinct().count() == 4


def test_reservation_over_batches_equals_one_allocation(spark):
    wanted = [7] * 20 + [8, 9] * 8 + [7] * 9
    everything = requests(spark, wanted)
    table = stock_table(spark, (7, 23), (8, 3))
    path = new_path(spark, "test-reserve")
    files_of(everything, f"{path}/in", "event_id", 12)
    stream = spark.readStream.schema(everything.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    reservation.start_reservation(stream, table, f"{path}/rows", f"{path}/progress").awaitTermination()
    done = reservation.settled(spark, f"{path}/rows")
    assert served(done) == served(stock.allocate(everything, table))
    accepted = done.filter(F.col("outcome") == "accepted").groupBy("product_id").count()
    assert rows(accepted) == [(7, 23), (8, 3)]


def test_nothing_arrived(spark):
    path = new_path(spark, "test-empty")
    schema = spark.createDataFrame([], "price decimal(10,2), freight_value decimal(10,2)").schema
    assert gate.read_sink(spark, f"{path}/rows", schema, gate.VALID).count() == 0
    assert "reason" in gate.read_sink(spark, f"{path}/rows", schema, gate.REJECTED).columns
    none = reservation.settled(spark, f"{path}/rows")
    assert none.count() == 0 and none.schema == reservation.SETTLED
    nothing = requests(spark, [7]).limit(0)
    reservation.reserve_batch(nothing, stock_table(spark, (7, 3)), f"{path}/rows", 0)
    reservation.reserve_batch(requests(spark, [7]), stock_table(spark, (7, 3)), f"{path}/rows", 1)
    assert [r.position for r in reservation.settled(spark, f"{path}/rows").collect()] == [1]


def test_rerun_under_dynamic_overwrite(spark):
    rows_ = spark.createDataFrame([(Decimal(1), Decimal(2)), (Decimal(2), Decimal(1))], "price decimal(10,2), freight_value decimal(10,2)")
    path = new_path(spark, "test-dynamic")
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        for part in (rows_, rows_.limit(1)):
            gate.write_judged(part, FREIGHT_RULE, f"{path}/batch_id=0")
        for _ in range(2):
            reservation.reserve_batch(requests(spark, [7, 7]), stock_table(spark, (7, 3)), f"{path}/stock", 0)
    finally:
        spark.conf.set(name, before)
    assert gate.read_sink(spark, path, rows_.schema, gate.VALID).count() + gate.read_sink(spark, path, rows_.schema, gate.REJECTED).count() == 1
    assert reservation.settled(spark, f"{path}/stock").count() == 2


def test_a_batch_without_its_state_is_not_read(spark):
    path = new_path(spark, "test-commit")
    table = stock_table(spark, (7, 30))
    for batch in range(12):  # past a whole version of the state
        reservation.reserve_batch(requests(spark, [7, 8] if batch % 2 else [7]), table, path, batch)
    half = spark.createDataFrame([], reservation.SETTLED)
    half.unionByName(reservation.settled(spark, path).limit(1)).write.parquet(f"{path}/settled/batch_id=12")
    done = reservation.settled(spark, path)
    assert done.count() == 18
    assert sorted(r.position for r in done.filter("product_id = 7").collect()) == list(range(1, 13))
    assert spark.read.parquet(f"{path}/taken/batch_id=11").count() == 2
