"""Key and reference rules on a stream of arriving rows.

The keys of admitted rows are the state. Beside them lies a Bloom filter, a table of 64-bit words of which a key sets a few
bits in one. A batch meets the filter first; only rows that pass it, which are nearly all real duplicates, meet the stored
keys, so a batch of new rows never reads them. Both are kept as versions, one per batch, and a batch reads
those of the batches before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from basketmill.operators import admission
from basketmill.operators.gate import REASON
from basketmill.schemas import Reference
from basketmill.session import stage
from basketmill.streaming.gate import REJECTED, VALID, VERDICT, read_sink

# Words of the filter; with four keys a word, one new key in two hundred passes.
WORDS = 1 << 20
_BITS = 4
# Every so many batches the filter is merged into one version.
MERGE_EVERY = 10
_HASH, _WORD, _MASK, _PLACE = "_hash", "_word", "_mask", "_place"


def _hashed(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in key])


def _word(hashed: Column, words: int) -> Column:
    return F.pmod(hashed, F.lit(words))


def _mask(hashed: Column) -> Column:
    """A few bits of a word, chosen by parts of another hash of the key."""
    again = F.xxhash64(F.lit("bits"), hashed)
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.pmod(F.shiftright(again, 8 * i), F.lit(64)).cast("int")) for i in range(_BITS)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom(keys: DataFrame, words: int = WORDS) -> DataFrame:
    """The filter of ``keys``, which has their hash: one row per word that has a bit set."""
    marked = keys.select(_word(F.col(_HASH), words).alias(_WORD), _mask(F.col(_HASH)).alias(_MASK))
    return marked.groupBy(_WORD).agg(F.bit_or(_MASK).alias(_MASK))


def _possible(candidates: DataFrame, filters: DataFrame, words: int) -> DataFrame:
    """The candidates that some version of the filter does not rule out."""
    asked = candidates.withColumn("_own", _mask(F.col(_HASH))).withColumn(_WORD, _word(F.col(_HASH), words))
    met = asked.join(filters, _WORD).where(F.col(_MASK).bitwiseAND(F.col("_own")) == F.col("_own"))
    return met.select(*candidates.columns).distinct()


def _versions(spark: SparkSession, sink: str, kind: str, batches: Sequence[int], schema: StructType | str) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{sink}/{kind}/batch_id={b}" for b in batches])


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def admit_batch(
    batch: DataFrame,
    rules: Mapping[str, str],
    key: Sequence[str],
    order_by: Sequence[str],
    references: Sequence[Reference],
    parents: Mapping[str, DataFrame],
    sink: str,
    batch_id: int,
    words: int = WORDS,
) -> None:
    """Judge one micro-batch after the ones before it.

    It overwrites only its own folders, and the filter's version is written last, so that running it again changes nothing.
    """
    spark = batch.sparkSession
    alone = stage(admission.judged(batch, rules, key, references, parents), "judged")
    in_order = stage(admission.placed(alone, key, order_by).withColumn(_HASH, _hashed(key)), "placed")
    first = in_order.where(F.col(_PLACE) == 1).select(*key, _HASH)
    keys_schema, filter_schema = first.schema, f"{_WORD} bigint, {_MASK} bigint"
    merged = batch_id // MERGE_EVERY * MERGE_EVERY if batch_id % MERGE_EVERY else max(batch_id - MERGE_EVERY, 0)
    filters = _versions(spark, sink, "bloom", range(merged, batch_id), filter_schema)
    possible = stage(_possible(first, filters, words), "possible")
    if possible.isEmpty():
        seen = possible
    else:
        earlier = _versions(spark, sink, "keys", range(batch_id), keys_schema)
        # The hash finds the few; the key itself decides.
        same = [possible[c] == earlier[c] for c in (_HASH, *key)]
        seen = stage(possible.join(earlier, same).select(*[possible[c] for c in possible.columns]), "seen")
    found = in_order.join(seen.select(*key, F.lit(True).alias("_seen")), list(key), "left")
    kept = found.select(*batch.columns, admission.with_duplicates(F.col(_PLACE), F.coalesce("_seen", F.lit(False))))
    rows = alone.where(F.col(REASON).isNotNull()).unionByName(kept)
    verdict = F.when(F.col(REASON).isNull(), F.lit(VALID)).otherwise(F.lit(REJECTED))
    rows.withColumn(VERDICT, verdict).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(VERDICT).parquet(
        f"{sink}/rows/batch_id={batch_id}"
    )
    new = first.join(seen.select(*key), list(key), "left_anti").select(*keys_schema.names)
    _write(new, f"{sink}/keys/batch_id={batch_id}")
    own = bloom(_versions(spark, sink, "keys", [batch_id], keys_schema), words)
    if batch_id % MERGE_EVERY == 0:
        own = own.unionByName(filters).groupBy(_WORD).agg(F.bit_or(_MASK).alias(_MASK))
    _write(own, f"{sink}/bloom/batch_id={batch_id}")


def start_admission(
    rows: DataFrame,
    rules: Mapping[str, str],
    key: Sequence[str],
    order_by: Sequence[str],
    references: Sequence[Reference],
    parents: Mapping[str, DataFrame],
    sink: str,
    checkpoint: str,
    words: int = WORDS,
    **trigger,
) -> StreamingQuery:
    """Judge arriving rows, earlier batches first; inside a batch by ``order_by``."""
    sink = sink.rstrip("/")

    def judge(batch: DataFrame, batch_id: int) -> None:
        admit_batch(batch, rules, key, order_by, references, parents, sink, batch_id, words)

    return (
        rows.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def admitted(spark: SparkSession, sink: str, row_schema: StructType) -> DataFrame:
    """The rows admitted so far."""
    return read_sink(spark, f"{sink.rstrip('/')}/rows", row_schema, VALID)


def refused(spark: SparkSession, sink: str, row_schema: StructType) -> DataFrame:
    """The rows refused so far, with the reason."""
    return read_sink(spark, f"{sink.rstrip('/')}/rows", row_schema, REJECTED)
