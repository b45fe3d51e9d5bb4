"""Records of CSV files whose cells may hold line breaks, read split by split.

A line break inside a quoted cell does not end a record. Whether a line begins inside a cell is told by the quotes before
it in its file: an odd number has left one open. Each split counts its own quotes, and one row per split says whether those
before it leave a cell open, so a file of any size is read in as many tasks as it has splits. Only lines of records that
have several are exchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketmill.session import stage

_MARKS = "_file bigint, _part bigint, _seq bigint, inside boolean, toggles boolean, toggled bigint, head boolean, line string"


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in the order of their split, whole batches at a time.

    ``_seq`` is the place in the split, ``inside`` whether the quotes before it there are odd in number, ``toggles`` whether
    its own are, ``toggled`` the last line before it there whose are (-1: none), ``head`` the first line of a file.
    """
    of, seq, odd, toggled, headless = None, 0, 0, -1, False
    for batch in batches:
        file, block = (batch.column(name).to_numpy() for name in ("_file", "_part"))
        line = batch.column("line")
        quotes = pc.count_substring(line, '"').to_numpy()
        filled = pc.greater(pc.binary_length(pc.utf8_trim_whitespace(line)), 0).to_numpy(zero_copy_only=False)
        borders = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        columns = {name: [] for name in ("_seq", "inside", "toggles", "toggled", "head")}
        for low, high in zip([0, *borders], [*borders, len(file)], strict=True):
            if low == high:
                continue
            if (file[low], block[low]) != of:
                of, seq, odd, toggled, headless = (file[low], block[low]), 0, 0, -1, block[low] == 0
            counts = quotes[low:high]
            places = seq + np.arange(high - low)
            turns = counts % 2 == 1
            last = np.maximum.accumulate(np.concatenate([[toggled], np.where(turns, places, -1)]))
            head = np.zeros(high - low, dtype=bool)
            if headless and filled[low:high].any():
                head[filled[low:high].argmax()] = True
                headless = False
            columns["_seq"].append(places)
            columns["inside"].append((odd + np.cumsum(counts) - counts) % 2 == 1)
            columns["toggles"].append(turns)
            columns["toggled"].append(last[:-1])
            columns["head"].append(head)
            seq, odd, toggled = seq + high - low, (odd + int(counts.sum())) % 2, last[-1]
        if len(file):
            found = [pa.array(np.concatenate(parts)) for parts in columns.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_file"), batch.column("_part"), *found, line], ["_file", "_part", *columns, "line"]
            )


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines with their place and quotes, as read once; a carriage return before the break stays on the line."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_part"),
        F.col("value").alias("line"),
    )
    return stage(lines.mapInArrow(_marked, _MARKS), "lines")


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: whether it begins inside a cell, and the line before it where that cell was opened."""
    own = lines.groupBy("_file", "_part").agg(
        F.count_if("toggles").alias("_n"), F.max(F.when(F.col("toggles"), F.struct("_part", "_seq"))).alias("_last")
    )
    file = Window.partitionBy("_file").orderBy("_part")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    whole = file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opened = F.coalesce(F.sum("_n").over(before), F.lit(0)) % 2 == 1
    unclosed = F.raise_error(F.lit("a quoted cell of the file has no end")).cast("boolean")
    return own.select(
        "_file",
        "_part",
        F.when(F.sum("_n").over(whole) % 2 == 0, opened).otherwise(unclosed).alias("_open"),
        F.last("_last", ignorenulls=True).over(before).alias("_opened_at"),
    )


def joined_records(lines: DataFrame) -> DataFrame:
    """The text of every record, as ``line``, without the files' header records; blank lines between records are none.

    Expects quotes as in RFC 4180: around cells, and doubled inside them. A file whose quotes do not pair fails the job.
    """
    placed = lines.join(F.broadcast(_splits(lines)), ["_file", "_part"])
    placed = placed.withColumn("inside", F.col("inside") != F.col("_open"))
    alone = ~F.col("inside") & ~F.col("toggles")
    without_return = F.regexp_replace("line", r"\r\z", "")
    single = placed.where(alone & ~F.col("head")).select(without_return.alias("line"))
    first = (
        F.when(~F.col("inside"), F.struct("_part", "_seq"))
        .when(F.col("toggled") >= 0, F.struct("_part", F.col("toggled").alias("_seq")))
        .otherwise(F.col("_opened_at"))
    )
    parts = F.sort_array(F.collect_list(F.struct("_part", "_seq", "line")))
    several = (
        placed.where(~alone)
        .groupBy("_file", first.alias("_first"))
        .agg(parts.alias("_parts"), F.max("head").alias("head"))
        .where(~F.col("head"))
        .select(F.array_join("_parts.line", "\n").alias("line"))
        .select(without_return.alias("line"))
    )
    return single.where(F.col("line") != "").unionByName(several)


def parsed_records(records: DataFrame, columns: list[str], dialect: dict[str, object]) -> DataFrame:
    """Records as text columns in the order of the header."""
    schema = ", ".join("`{}` string".format(name.replace("`", "``")) for name in columns)
    options = {key: str(value).lower() if isinstance(value, bool) else value for key, value in dialect.items()}
    row = F.from_csv("line", schema, {**options, "multiLine": "true"})
    return records.select(row.alias("_row")).select("_row.*")
