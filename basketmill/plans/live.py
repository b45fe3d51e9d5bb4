"""The given tables played as streams to their end, and what the sinks then hold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from basketmill.plans.stock import ALLOCATED_STOCK, full_stock
from basketmill.schemas import FREIGHT_RULE, ITEM_RULES, NORMAL_FORM, Reference
from basketmill.session import move, new_path
from basketmill.sources import roles
from basketmill.sources.roles import item_roles, request_roles, table
from basketmill.streaming import admission, counted, gate

ARRIVALS = 3
# Files of a table that one micro-batch takes.
FILES_AT_ONCE = 64
ARRIVAL_KEY = NORMAL_FORM["order_items"].key
ARRIVAL_RULES = {**FREIGHT_RULE, **ITEM_RULES}
ARRIVAL_REFERENCES = (Reference("order_items", "order_id", "orders"), Reference("order_items", "product_id", "products"))


def play(rows: DataFrame, arrival: Column, path: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Let the rows arrive in parts, numbered by ``arrival``, and run the stream on what is new after each.

    The rows are written once; a part arrives when its folder is moved under the watched one. Every run continues from
    the progress of the one before, as after a restart.
    """
    spark = rows.sparkSession
    rows.withColumn("_arrival", arrival).write.partitionBy("_arrival").parquet(f"{path}/waiting")
    for number in range(ARRIVALS):
        if move(spark, f"{path}/waiting/_arrival={number}", f"{path}/arrived/{number}"):
            start(spark.readStream.schema(rows.schema).parquet(f"{path}/arrived/*")).awaitTermination()


def _gated(spark: SparkSession, folder: str, verdict: str) -> DataFrame:
    """The stream reads the given files themselves, whether the table is one file or a folder of them."""
    lines = table(spark, folder, "lineitem")
    sink = new_path(spark, "gate")
    # A pattern of one name: a stream takes a plain path for a folder.
    arriving = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", FILES_AT_ONCE).parquet(f"{folder.rstrip('/')}/lineitem.parque[t]")
    gate.start_gate(item_roles(arriving), FREIGHT_RULE, f"{sink}/rows", f"{sink}/progress").awaitTermination()
    return gate.read_sink(spark, f"{sink}/rows", item_roles(lines).schema, verdict)


def gate_stream_valid(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder, gate.VALID)


def gate_stream_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder, gate.REJECTED)


def reservation_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in order of time; the settled requests equal those of one allocation over all."""
    events = table(spark, folder, "events")
    stock = full_stock(spark, folder, ALLOCATED_STOCK)
    sink = new_path(spark, "reservation")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return counted.settled(spark, f"{sink}/rows")
    edges = [first + (last - first) * (i + 1) / ARRIVALS for i in range(ARRIVALS - 1)]
    arrival = sum((F.when(F.col("ts") >= F.lit(e).cast("timestamp_ntz"), 1).otherwise(0) for e in edges), F.lit(0))

    def start(arrived: DataFrame) -> StreamingQuery:
        return counted.start_reservation(request_roles(arrived), stock, f"{sink}/rows", f"{sink}/progress")

    play(events, arrival, f"{sink}/events", start)
    return counted.settled(spark, f"{sink}/rows")


def parents(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """What arriving items may refer to: reviewed orders and products with a category."""
    return {
        "orders": roles.reviews(spark, folder).select("order_id"),
        "products": roles.products(spark, folder).where("product_category_name IS NOT NULL").select("product_id"),
    }


def _arrivals(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Line items arrive by product number, so that items of one key come in different batches."""
    lines = table(spark, folder, "lineitem")
    sink = new_path(spark, "arrivals")
    known = parents(spark, folder)
    columns = item_roles(lines).columns

    def start(arrived: DataFrame) -> StreamingQuery:
        return admission.start_admission(
            item_roles(arrived), ARRIVAL_RULES, ARRIVAL_KEY, columns, ARRIVAL_REFERENCES, known, f"{sink}/judged", f"{sink}/progress"
        )

    play(lines, F.pmod("l_partkey", F.lit(ARRIVALS)), f"{sink}/lines", start)
    return f"{sink}/judged", item_roles(lines)


def arrivals_admitted(spark: SparkSession, folder: str) -> DataFrame:
    """Items that rules, keys and references admit, judged as they arrive."""
    sink, like = _arrivals(spark, folder)
    return admission.admitted(spark, sink, like.schema)


def arrivals_refused(spark: SparkSession, folder: str) -> DataFrame:
    """Items refused on arrival, with the reason."""
    sink, like = _arrivals(spark, folder)
    return admission.refused(spark, sink, like.schema)


QUERIES = {
    f.__name__: f for f in (gate_stream_valid, gate_stream_rejected, reservation_stream, arrivals_admitted, arrivals_refused)
}
