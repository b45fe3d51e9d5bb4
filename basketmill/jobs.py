"""The whole way from raw files to a checked normal form, as three jobs.

    python -m basketmill.jobs --input-dir raw --output out

writes ``out/wide`` (CSV), ``out/wide_raw``, ``out/wide_table`` and ``out/<table>`` (Parquet) and
``out/validation`` (CSV), and ends with code 1 if a file or column is missing or a check fails.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from basketmill.operators import cleaning, modelling, quality
from basketmill.schemas import FREE_TEXT, NORMAL_FORM, RAW, REFERENCES, WIDE
from basketmill.sources.files import land_csv, load_typed, unfit_counts, write_csv


def land_raw_tables(spark: SparkSession, folder: str, landing: str, pattern: str = "{name}.csv") -> dict[str, DataFrame]:
    """The raw CSV files, each read once and landed as typed Parquet under ``landing``."""
    return {
        name: land_csv(
            spark, f"{folder.rstrip('/')}/{pattern.format(name=name)}", schema, f"{landing.rstrip('/')}/{name}", name in FREE_TEXT
        )
        for name, schema in RAW.items()
    }


def clean_files(spark: SparkSession, folder: str, output: str, pattern: str = "{name}.csv") -> DataFrame:
    """Raw CSV files to the wide CSV; returns the cleaning report, with the raw values that did not fit their type."""
    landed = land_raw_tables(spark, folder, f"{output.rstrip('/')}_raw", pattern)
    raw = {name: df.select(*RAW[name].names) for name, df in landed.items()}
    seen = Observation()
    write_csv(cleaning.clean_wide(raw, seen), output)
    return cleaning.observed_report(raw, seen).unionByName(unfit_counts(landed))


def load_normal_form(spark: SparkSession, wide_path: str, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The wide CSV landed as Parquet, and its five projections written under ``folder`` and read back.

    The CSV is read once; the projections and later checks read the landed table. A row that does not fit
    the declared types stops the load.
    """
    wide, bad = load_typed(spark, wide_path, WIDE, f"{folder.rstrip('/')}/wide_table")
    unfit = bad.limit(1).collect()
    if unfit:
        raise ValueError(f"row does not fit the declared types: {unfit[0].asDict()}")
    stored = {}
    for name, df in modelling.decompose(wide).items():
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        stored[name] = spark.read.schema(df.schema).parquet(path)
    return wide, stored


def validate(wide: DataFrame, model: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, subject, violations) rows; a sound model has no violations."""
    keys = {name: spec.key for name, spec in NORMAL_FORM.items()}
    grains = {**keys, "order_items": NORMAL_FORM["order_items"].columns}
    duplicates = quality.duplicate_keys(model, keys).select(
        F.lit("duplicated key").alias("check_name"), F.col("table_name").alias("subject"), F.col("duplicated_keys").alias("violations")
    )
    orphans = quality.orphans(model, REFERENCES).select(
        F.lit("orphan").alias("check_name"),
        F.concat_ws(" ", F.concat_ws(".", "child_table", "child_column"), F.lit("in"), "parent_table").alias("subject"),
        F.col("orphans").alias("violations"),
    )
    grain = quality.grain(wide, model, grains).select(
        F.lit("row count").alias("check_name"),
        F.col("table_name").alias("subject"),
        F.abs(F.col("expected") - F.col("actual")).alias("violations"),
    )
    return quality.union_all([duplicates, orphans, grain])


def run(spark: SparkSession, folder: str, output: str, pattern: str = "{name}.csv") -> bool:
    """All three jobs; true if every check passed."""
    output = output.rstrip("/")
    clean_files(spark, folder, f"{output}/wide", pattern).show(truncate=False)
    wide, model = load_normal_form(spark, f"{output}/wide", output)
    write_csv(validate(wide, model), f"{output}/validation")
    checks = spark.read.option("header", True).csv(f"{output}/validation")
    failed = checks.filter(F.col("violations") != "0")
    failed.show(truncate=False)
    return failed.count() == 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Clean raw retail files, split them into normal form and check it.")
    parser.add_argument("--input-dir", required=True)
    parser.add_argument("--output", required=True, help="a folder that does not exist yet")
    parser.add_argument("--pattern", default="{name}.csv", help="file name of a raw table")
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("basketmill").getOrCreate()
    try:
        return 0 if run(spark, chosen.input_dir, chosen.output, chosen.pattern) else 1
    except (AnalysisException, ValueError) as error:
        print(error, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
