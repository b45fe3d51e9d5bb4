"""The given tables through files and named tables and back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, TimestampNTZType

from basketmill.functions import parsing
from basketmill.operators import cleaning
from basketmill.plans.stock import RUN_TIME, products
from basketmill.operators.stock import seed
from basketmill.schemas import INVENTORY, struct
from basketmill.session import new_path
from basketmill.sources import files, roles, tables


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as CSV and read back: quotes, line breaks and commas inside cells included."""
    docs = roles.table(spark, folder, "documents")
    path = new_path(spark, "csv")
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema, multi_line=True)


def csv_clean_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The five raw tables as CSV, read in their declared columns and cleaned."""
    raw = roles.retail(spark, folder)
    path = new_path(spark, "raw")
    for name, df in raw.items():
        files.write_csv(df, f"{path}/{name}.csv")
    schemas = {name: df.schema for name, df in raw.items()}
    return cleaning.clean_wide(files.read_raw_tables(spark, path, schemas, free_text=("order_reviews",)))


def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    """Items as CSV, bulk loaded into a typed Parquet table; none is unfit."""
    items = roles.items(spark, folder)
    path = new_path(spark, "items")
    files.write_csv(items, f"{path}/csv")
    good, bad = files.load_typed(spark, f"{path}/csv", items.schema, f"{path}/table")
    return good.unionByName(bad.select(*[bad[f.name].cast(f.dataType).alias(f.name) for f in items.schema.fields]))


def table_reload(spark: SparkSession, folder: str) -> DataFrame:
    """The inventory appended to a declared table, the seeded stock after it, then truncated and loaded anew as a view."""
    name, path = f"inventory_{uuid.uuid4().hex}", new_path(spark, "inventory")
    stock = roles.inventory(spark, folder)
    for _ in range(2):  # the second call finds the table there
        tables.create_table(spark, name, struct(**{f.name: f.dataType for f in stock.schema.fields}), path)
    try:
        tables.append_rows(stock, name)
        tables.append_rows(seed(products(spark, folder), stock, RUN_TIME), name)
        copy = tables.reload(spark.table(name), f"{name}_view")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.dropTempView(f"{name}_view")
    return spark.read.schema(stock.schema).parquet(copy).select(*INVENTORY.names)


def _spelled_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text as people write it: times, days and days the other way round, numbers with blanks, ranks with words."""
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    moment = F.when(status == "O", F.date_format(day, "yyyy-MM-dd HH:mm:ss")).when(status == "F", F.date_format(day, "dd/MM/yyyy"))
    amount = F.col("o_totalprice").cast("string")
    return roles.table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        moment.otherwise(F.date_format(day, "yyyy-MM-dd")).alias("moment"),
        F.when(status == "O", F.concat(F.lit(" "), amount, F.lit(" "))).when(status == "F", F.concat(amount, F.lit(" EUR"))).alias("amount"),
        F.when(status == "O", F.substring("o_orderpriority", 1, 1)).otherwise(F.col("o_orderpriority")).alias("rank"),
    )


def text_parsing(spark: SparkSession, folder: str) -> DataFrame:
    """Text from a CSV parsed as what it may be; what does not parse is null."""
    path = new_path(spark, "spelled")
    files.write_csv(_spelled_orders(spark, folder), path)
    text = files.read_csv(spark, path)
    return text.select(
        parsing.parse_integer(F.col("order_id")).alias("order_id"),
        parsing.parse_time(F.col("moment")).alias("moment"),
        parsing.parse_date(F.col("moment")).alias("day"),
        parsing.parse_number(F.col("amount")).alias("amount"),
        parsing.parse_integer(F.col("rank")).alias("rank"),
    )


def csv_unfit(spark: SparkSession, folder: str) -> DataFrame:
    """The same text bulk loaded into declared types: the values of each column that do not fit."""
    path = new_path(spark, "unfit")
    files.write_csv(_spelled_orders(spark, folder), f"{path}/csv")
    schema = struct(order_id=LongType(), moment=TimestampNTZType(), amount=DoubleType(), rank=IntegerType())
    return files.unfit_counts({"orders": files.land_csv(spark, f"{path}/csv", schema, f"{path}/table")})


def folder_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of CSV tables made views by their names, and a query over two of them."""
    path, prefix = new_path(spark, "folder"), f"csv_{uuid.uuid4().hex}_"
    given = {name: roles.table(spark, folder, name) for name in ("customer", "orders")}
    for name, df in given.items():
        files.write_csv(df, f"{path}/{name}.csv")
    names = files.register_folder(spark, path, {name: df.schema for name, df in given.items()}, prefix)
    try:
        customer, orders = (f"{prefix}{name}" for name in names)
        return tables.query(
            spark,
            f"""SELECT c.c_mktsegment, c.c_nationkey, COUNT(*) AS orders, MAX(o.o_orderdate) AS last_order
                FROM {customer} AS c JOIN {orders} AS o ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment, c.c_nationkey""",
        )
    finally:
        for name in names:
            spark.catalog.dropTempView(f"{prefix}{name}")


QUERIES = {f.__name__: f for f in (csv_round_trip, csv_clean_wide, csv_load, csv_unfit, text_parsing, folder_tables, table_reload)}
