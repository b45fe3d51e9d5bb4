"""Normal-form tables that grow by batches: only the parts that a batch touches are written again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketmill.operators.modelling import project
from basketmill.schemas import NORMAL_FORM, Projection
from basketmill.session import stage
from basketmill.sources import versions
from basketmill.sources.versions import VersionConflict

PARTS = 64
ATTEMPTS = 5


def part_of(key: tuple[str, ...], parts: int) -> Column:
    """The part a row belongs to, by its key; one of a fixed number."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in key]), F.lit(parts)).cast("string")


def merge_rows(rows: DataFrame, path: str, part: Column) -> set[str]:
    """Add distinct ``rows`` to the versioned table at ``path``; returns the parts written anew.

    Parts that the rows do not touch stay the files they were. Rows that are there already change nothing but cost the part's
    rewrite. If another writer publishes first, the merge is made again from the newer version.
    """
    spark = rows.sparkSession
    new = stage(rows, "batch")
    labels = {row[0] for row in new.select(part.alias("part")).distinct().collect()}
    if not labels and versions.last_number(spark, path):
        return labels
    for attempt in range(ATTEMPTS):
        last = versions.version(spark, path)
        old = versions.rows(spark, path, last, labels) if last else new.limit(0)
        try:
            versions.replace_parts(old.unionByName(new).distinct(), path, part, labels, last)
            return labels
        except VersionConflict:
            if attempt + 1 == ATTEMPTS:
                raise
    raise AssertionError("not reached")


def merge_wide(wide: DataFrame, path: str, specs: Mapping[str, Projection] = NORMAL_FORM, parts: int = PARTS) -> dict[str, set[str]]:
    """A batch of wide rows merged into the normal form at ``path``; per table the parts written anew.

    Each table has versions of its own. A batch that is merged again, after a failure in between, changes nothing.
    """
    batch = stage(wide, "wide_batch")
    return {name: merge_rows(project(batch, spec), f"{path}/{name}", part_of(spec.key, parts)) for name, spec in specs.items()}


def merged(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the normal form as merged so far."""
    return versions.read(spark, f"{path}/{name}")
