"""From raw documents to a mixed training corpus.

1. language: documents whose language cannot be told (no letter, or too uncertain a guess) go.
2. near_duplicates: one document of each group of near duplicates stays.
3. decontaminate: documents with benchmark passages go.
4. secrets: secrets are replaced in the text; no document goes.
5. mix: every document gets its domain posteriors, a rate and a number of copies; no document goes.

All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketmill.llm import decontaminate, langid, minhash, mixing, secrets
from basketmill.llm.staging import written

# Below this calibrated probability a language counts as unknown.
LEAST_SCORE = 0.3
# Documents of this percentage of common shingles (five words) or more are near duplicates.
LEAST_ALIKE = 80
# A pair at 0.80 shares none of 64 bands of 7 coordinates with probability 3e-7.
BANDS, ROWS = 64, 7


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.with_language(docs, langid.train(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs, percent=LEAST_ALIKE, bands=BANDS, rows=ROWS)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(docs, labels.select("doc_id", mixing.label_domain().alias("domain")))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", remove_benchmark),
    ("secrets", hide_secrets),
    ("mix", mix),
]
# Learned models and connected components are not expressible in SQL; tests/llm/test_pipeline.py checks each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written once and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
