"""Stock reservation on a stream of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, TimestampNTZType

from basketmill.operators.ordering import rank_in_group
from basketmill.operators.stock import REQUEST_ORDER, settle
from basketmill.schemas import struct
from basketmill.session import finished_batches, stage

TAKEN = "product_id bigint, taken bigint"
SETTLED = struct(
    event_id=LongType(),
    ts=TimestampNTZType(),
    product_id=LongType(),
    position=LongType(),
    seen=LongType(),
    written=LongType(),
    outcome=StringType(),
)
# Every so many batches the state is written whole, else only the products of the batch.
COMPACT_EVERY = 10


def _state(spark: SparkSession, sink: str, batch_id: int) -> DataFrame:
    """Requests seen per product before this batch: the last value since the last whole state."""
    if batch_id == 0:
        return spark.createDataFrame([], TAKEN)
    whole = (batch_id - 1) // COMPACT_EVERY * COMPACT_EVERY
    versions = [f"{sink}/taken/batch_id={b}" for b in range(whole, batch_id)]
    rows = spark.read.schema(f"{TAKEN}, batch_id bigint").option("basePath", f"{sink}/taken").parquet(*versions)
    return rows.groupBy("product_id").agg(F.max_by("taken", "batch_id").alias("taken"))


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def reserve_batch(requests: DataFrame, stock: DataFrame, sink: str, batch_id: int) -> None:
    """Settle one micro-batch after the ones before it.

    The number of requests seen per product is the state, kept as versions: a batch reads those before it and
    overwrites only its own results, so running it again changes nothing. Its version is written last
    and marks the batch as done. The batch itself is read from its source once. Ranking inside the batch
    spreads products with very many requests over tasks, which state held per product in one task could not do.
    """
    spark = requests.sparkSession
    batch = stage(requests, "batch")
    before = _state(spark, sink, batch_id)
    ranked = rank_in_group(batch, ["product_id"], list(REQUEST_ORDER), "_place", stored=True)
    placed = (
        ranked.join(before, ranked["product_id"].eqNullSafe(before["product_id"]), "left")
        .drop(before["product_id"])
        .withColumn("position", F.col("_place") + F.coalesce(F.col("taken"), F.lit(0)))
        .select(*requests.columns, "position")
    )
    _write(settle(placed, stock).select(*SETTLED.names), f"{sink}/settled/batch_id={batch_id}")
    arrived = batch.groupBy("product_id").agg(F.count(F.lit(1)).alias("_arrived")).withColumnRenamed("product_id", "_of")
    how = "full" if batch_id % COMPACT_EVERY == 0 else "right"
    seen = before.join(arrived, before["product_id"].eqNullSafe(arrived["_of"]), how)
    taken = F.coalesce("taken", F.lit(0)) + F.coalesce("_arrived", F.lit(0))
    _write(seen.select(F.coalesce("product_id", "_of").alias("product_id"), taken.alias("taken")), f"{sink}/taken/batch_id={batch_id}")


def start_reservation(requests: DataFrame, stock: DataFrame, sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """First come first served across micro-batches; inside a batch by time and event id."""
    sink = sink.rstrip("/")

    def settle_one(batch: DataFrame, batch_id: int) -> None:
        reserve_batch(batch, stock, sink, batch_id)

    return (
        requests.writeStream.foreachBatch(settle_one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def settled(spark: SparkSession, sink: str) -> DataFrame:
    """Every request settled so far, of batches whose state is written too; none before the first."""
    sink = sink.rstrip("/")
    done = [path.rsplit("/", 1)[1] for path in finished_batches(spark, f"{sink}/taken")]
    if not done:
        return spark.createDataFrame([], SETTLED)
    return spark.read.schema(SETTLED).parquet(*[f"{sink}/settled/{batch}" for batch in done])
