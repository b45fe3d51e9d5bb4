"""The registered queries of this package, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketmill.llm import (
    decontaminate,
    langid,
    lmscore,
    merkle,
    minhash,
    mixing,
    preference,
    secrets,
    substrings,
    toxicity,
    urlrules,
    variants,
    whitening,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.fingerprint_documents(_table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    judged = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return judged.drop("matches")


def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents")).drop("text_hash")


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, folder, "documents"))


def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return urlrules.judge_urls(_table(spark, folder, "pages"))


def op7_preference(spark: SparkSession, folder: str) -> DataFrame:
    return preference.preference_segments(preference.swapped_answers(_table(spark, folder, "conversations")))


def op8_gru(spark: SparkSession, folder: str) -> DataFrame:
    return lmscore.score_documents(_table(spark, folder, "documents"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return langid.identify(docs, langid.train(docs.where(~langid.held_out())))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels")
    return mixing.mix(docs, labels.select("doc_id", mixing.label_domain().alias("domain"))).drop("text")


def op11_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(_table(spark, folder, "documents")))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, folder, "documents"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_merkle,
        op2_toxicity,
        op3_decontaminate,
        op4_minhash,
        op5_secrets,
        op6_url_rules,
        op7_preference,
        op8_gru,
        op9_language,
        op10_mixing,
        op11_substrings,
        op12_variants,
        op13_whitening,
    )
}
ORACLE: dict[str, str] = {
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_minhash": minhash.ORACLE,
    "op7_preference": preference.ORACLE,
    "op11_substrings": substrings.ORACLE,
}
