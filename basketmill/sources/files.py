"""CSV files in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketmill.functions.parsing import blank_to_null
from basketmill.session import entries_of, new_path
from basketmill.sources.records import joined_records, parsed_records, split_lines

BAD_COLUMNS, BAD_TEXT = "_bad_columns", "_text"
OUTPUT_TIME = "yyyy-MM-dd HH:mm:ss"


# Quotes are doubled inside a quoted cell, in and out; white space belongs to the cell.
DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    infer: bool = False,
) -> DataFrame:
    """A CSV file with a header row, typed by ``schema``; blank cells are null.

    Columns are matched to the header by name, so ``schema`` lists only what is needed, in any
    order. A missing column fails the read. Without a schema all columns are text, or with ``infer`` of
    types found by reading the data twice, which is meant for profiling small samples. Cells may hold
    line breaks only with ``multi_line``; the lines are then staged once and joined to records, split by split.
    """
    if infer:
        raw = spark.read.options(**DIALECT, inferSchema=True, multiLine=multi_line).csv(path)
    else:
        text = _text_columns(spark, path, schema, multi_line)
        raw = text.select(*[_typed(f).alias(f.name) for f in schema.fields]) if schema else text
    blanked = raw.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in raw.schema.fields
        ]
    )
    return blanked.select(*columns) if columns else blanked


def _text_columns(spark: SparkSession, path: str, schema: StructType | None, multi_line: bool) -> DataFrame:
    """The named columns, or all, as text. Typing them afterwards keeps CSV column pruning."""
    text = spark.read.options(**DIALECT, multiLine=multi_line).csv(path)
    if multi_line:
        text = parsed_records(joined_records(split_lines(spark, path)), text.columns, DIALECT)
    if schema is None:
        return text
    missing = [name for name in schema.names if name not in text.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return text.select(*schema.names)


def _typed(field: StructField) -> Column:
    column = F.col(field.name)
    return column if isinstance(field.dataType, StringType) else F.trim(column).try_cast(field.dataType)


def read_raw_tables(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, StructType],
    pattern: str = "{name}.csv",
    free_text: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Every table of ``schemas`` from ``folder``, in the columns its schema names.

    Tables named in ``free_text`` may hold line breaks inside cells.
    """
    return {
        name: read_csv(spark, f"{folder.rstrip('/')}/{pattern.format(name=name)}", schema, multi_line=name in free_text)
        for name, schema in schemas.items()
    }


def land_csv(spark: SparkSession, path: str, schema: StructType, landing: str, multi_line: bool = False) -> DataFrame:
    """Bulk load: the file read once and written to ``landing`` as a typed Parquet table, then read back from there.

    A value that does not fit its column's type is null; ``_bad_columns`` names the columns at fault, and
    ``_text`` has the row's text where there are any.
    """
    text = _text_columns(spark, path, schema, multi_line)
    unfit = {f.name: blank_to_null(F.col(f.name)).isNotNull() & _typed(f).isNull() for f in schema.fields}
    bad = F.concat_ws(",", *[F.when(test, F.lit(n)) for n, test in unfit.items()])
    typed = [
        (blank_to_null(F.col(f.name)) if isinstance(f.dataType, StringType) else _typed(f)).alias(f.name)
        for f in schema.fields
    ]
    row = F.struct(*[F.col(n) for n in schema.names])
    landed = text.select(*typed, bad.alias(BAD_COLUMNS), F.when(bad != "", row).alias(BAD_TEXT))
    landed.write.mode("overwrite").parquet(landing)
    return spark.read.schema(landed.schema).parquet(landing)


def fitting(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The typed rows of a landed table, and the text of those with a value that does not fit."""
    good = landed.filter(F.col(BAD_COLUMNS) == "").drop(BAD_COLUMNS, BAD_TEXT)
    return good, landed.filter(F.col(BAD_COLUMNS) != "").select(f"{BAD_TEXT}.*", BAD_COLUMNS)


def load_typed(
    spark: SparkSession, path: str, schema: StructType, landing: str | None = None, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``land_csv`` and ``fitting`` in one step, by default into the shared folder."""
    return fitting(land_csv(spark, path, schema, landing or new_path(spark, "landed"), multi_line))


def unfit_counts(landed: Mapping[str, DataFrame]) -> DataFrame:
    """(metric, value) rows: unfit values per table and column, one scan of the narrow fault column per table."""
    counts = []
    for name, df in landed.items():
        columns = [c for c in df.columns if c not in (BAD_COLUMNS, BAD_TEXT)]
        faults = F.split(F.col(BAD_COLUMNS), ",")
        sums = df.agg(*[F.count_if(F.array_contains(faults, c)).alias(c) for c in columns])
        pairs = F.array(*[F.struct(F.lit(f"unfit {name}.{c}").alias("metric"), F.col(c).alias("value")) for c in columns])
        counts.append(sums.select(F.explode(pairs).alias("p")).select("p.metric", "p.value"))
    return reduce(DataFrame.unionByName, counts)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV part files with headers; one file per task, none gathered on one machine."""
    df.write.options(**DIALECT, timestampNTZFormat=OUTPUT_TIME).csv(path)


def register_folder(
    spark: SparkSession, folder: str, schemas: Mapping[str, StructType] | None = None, prefix: str = ""
) -> list[str]:
    """Make every ``<name>.csv`` in ``folder``, a file or a folder of part files, a view called ``<name>``; returns the names.

    Columns are typed by ``schemas``, and text where it has no entry; nothing is read to find types. ``prefix`` goes before
    the names of the views.
    """
    names = [name.removesuffix(".csv") for name, _ in entries_of(spark, folder) if name.endswith(".csv")]
    for name in names:
        read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", (schemas or {}).get(name)).createOrReplaceTempView(f"{prefix}{name}")
    return names
