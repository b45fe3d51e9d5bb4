"""Stock reservation with its state in Spark's state store.

The state is one number per product, the requests seen so far, kept by a streaming count. A micro-batch holds its requests
and, from the same files, the new counts of their products; what a product had before is the difference. Nothing of
earlier batches is read, and requests are ranked inside their batch by a range sort, so that a product with very many of
them is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from basketmill.operators.ordering import rank_in_group
from basketmill.operators.stock import REQUEST_ORDER, settle
from basketmill.session import finished_batches, stage
from basketmill.streaming.reservation import SETTLED

_SEEN, _PLACE = "_seen", "_place"


def with_counts(requests: DataFrame) -> DataFrame:
    """The requests, without a count, and one row per product with the requests seen up to this batch."""
    counts = requests.groupBy("product_id").agg(F.count(F.lit(1)).alias(_SEEN))
    return requests.withColumn(_SEEN, F.lit(None).cast("bigint")).unionByName(counts, allowMissingColumns=True)


def settle_batch(batch: DataFrame, stock: DataFrame, path: str) -> None:
    """Settle the requests of one micro-batch of ``with_counts``; run again it writes the same to the same folder."""
    both = stage(batch, "counted_batch")
    requests = both.where(F.col(_SEEN).isNull()).drop(_SEEN)
    arrived = requests.groupBy("product_id").agg(F.count(F.lit(1)).alias("_arrived"))
    seen = both.where(F.col(_SEEN).isNotNull()).select(F.col("product_id").alias("_of"), _SEEN)
    before = seen.join(arrived, seen["_of"].eqNullSafe(arrived["product_id"])).select("_of", (F.col(_SEEN) - F.col("_arrived")).alias("_before"))
    ranked = rank_in_group(requests, ["product_id"], list(REQUEST_ORDER), _PLACE, stored=True)
    placed = ranked.join(before, ranked["product_id"].eqNullSafe(before["_of"])).withColumn("position", F.col(_PLACE) + F.col("_before"))
    rows = settle(placed.select(*requests.columns, "position"), stock).select(*SETTLED.names)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def start_reservation(requests: DataFrame, stock: DataFrame, sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """First come first served across micro-batches; inside a batch by time and event id."""
    sink = sink.rstrip("/")

    def settle_one(batch: DataFrame, batch_id: int) -> None:
        settle_batch(batch, stock, f"{sink}/batch_id={batch_id}")

    return (
        with_counts(requests)
        .writeStream.outputMode("update")
        .foreachBatch(settle_one)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def settled(spark: SparkSession, sink: str) -> DataFrame:
    """Every request settled so far; none before the first batch."""
    done = finished_batches(spark, sink)
    return spark.read.schema(SETTLED).parquet(*done) if done else spark.createDataFrame([], SETTLED)
