"""The rule gate on a stream of arriving rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from basketmill.operators.gate import REASON, judged
from basketmill.session import finished_batches

VERDICT, VALID, REJECTED = "verdict", "valid", "rejected"


def write_judged(rows: DataFrame, rules: Mapping[str, str], path: str) -> None:
    """Both outcomes in one pass over ``rows``, as the two partitions of ``path``."""
    verdict = F.when(F.col(REASON).isNull(), F.lit(VALID)).otherwise(F.lit(REJECTED))
    judged(rows, rules).withColumn(VERDICT, verdict).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(VERDICT).parquet(path)


def start_gate(rows: DataFrame, rules: Mapping[str, str], sink: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Judge every micro-batch into its own folder of ``sink``.

    A batch that is run again after a failure overwrites its own folder, so each row counts once.
    """
    sink = sink.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_judged(batch, rules, f"{sink}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_sink(spark: SparkSession, sink: str, row_schema: StructType, verdict: str) -> DataFrame:
    """The rows of one outcome so far; none before the first batch."""
    written = StructType([*row_schema.fields, StructField(REASON, StringType(), True)])
    partitions = "batch_id bigint, verdict string"
    full = StructType([*written.fields, *StructType.fromDDL(partitions).fields])
    batches = finished_batches(spark, sink)
    stored = spark.read.schema(full).option("basePath", sink).parquet(*batches) if batches else spark.createDataFrame([], full)
    rows = stored.filter(F.col(VERDICT) == verdict).drop("batch_id", VERDICT)
    return rows.drop(REASON) if verdict == VALID else rows
