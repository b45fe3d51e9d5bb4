"""Mixing to target weights by soft membership.

A classifier fit on a labelled table gives every document posteriors over domains. Documents then get
rates, from 0 upwards, such that the expected tokens of each domain, rate times tokens times posterior
summed over all documents, match the targets. The rates minimise the squared difference, whitened by the
second moments of the posteriors, by projected gradient steps from a rate of one: each step sums the
domain totals over all documents, one small row, and moves every rate against the residual, cut at zero.
A rate depends only on the steps so far, so it is an expression over them and no state is rewritten.

Everything is DataFrame code and Spark's own learners. The classifier learns from at most ``train_rows`` rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.staging import written

TRAIN_ROWS = 6000
FEATURES = 1 << 12
STEPS = 30
TOLERANCE = 1e-3
# Share of tokens wanted from each domain.
TARGETS = {"good": 0.90, "low": 0.08, "toxic": 0.02}


def label_domain() -> Column:
    """The domain of a row of quality and toxicity labels; null labels count as good."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("good")


def _terms(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}]+")


def _featured(df: DataFrame, text: Column) -> DataFrame:
    counted = HashingTF(inputCol="_terms", outputCol="_counts", numFeatures=FEATURES, binary=True)
    scaled = Normalizer(inputCol="_counts", outputCol="_features", p=2.0)
    return scaled.transform(counted.transform(df.withColumn("_terms", _terms(text)))).drop("_terms", "_counts")


def with_posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents with ``_posterior``, an array over ``domains``; learned from (doc_id, domain) rows.

    Domains that no sampled row has get no mass. Without rows to learn from, all domains weigh the same.
    """
    place = F.xxhash64("doc_id", "domain")
    rows = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).select("doc_id", "domain").distinct()
    chosen = written(rows.orderBy(place, "doc_id", "domain").limit(train_rows), "mix_labels")  # at most train_rows rows
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = written(texts.orderBy(place, F.xxhash64("text")).limit(train_rows), "mix_sample")
    present = sorted((r["domain"] for r in sample.select("domain").distinct().collect()), key=domains.index)
    even = F.array(*[F.lit(1.0 / len(domains))] * len(domains))
    if not present:
        return docs.withColumn("_posterior", even)
    if len(present) == 1:
        return docs.withColumn("_posterior", F.array(*[F.lit(float(d == present[0])) for d in domains]))
    index = F.create_map(*[c for i, d in enumerate(present) for c in (F.lit(d), F.lit(float(i)))])
    learner = LogisticRegression(
        featuresCol="_features", labelCol="_label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction",
        family="multinomial", regParam=1e-3, maxIter=40,
    )
    train = _featured(sample.withColumn("_label", F.element_at(index, F.col("domain"))), F.col("text"))
    model = learner.fit(train.select("_label", "_features"))
    scored = model.transform(_featured(docs, F.col("text")))
    found = vector_to_array("_probability")
    spread = F.array(*[found[present.index(d)] if d in present else F.lit(0.0) for d in domains])
    return scored.withColumn("_posterior", spread).drop("_features", "_raw", "_probability", "_prediction")


def rate_after(steps: list[list[float]]) -> Column:
    """The rate of a document after the given residual steps."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    moves = F.array(*[F.array(*map(F.lit, map(float, s))) for s in steps])
    n = len(steps[0])

    def move(rate, step):
        return F.greatest(F.lit(0.0), rate - sum((F.col("_posterior")[k] * step[k] for k in range(1, n)), F.col("_posterior")[0] * step[0]))

    return F.aggregate(moves, rate, move)


def solve(members: DataFrame, targets: list[float], most_steps: int = STEPS, tolerance: float = TOLERANCE) -> tuple[list[list[float]], list[float]]:
    """Residual steps, and the last shares of all tokens; ``members`` has _tokens and _posterior."""
    n = len(targets)
    moment = [F.sum(F.col("_tokens") * F.col("_posterior")[i] * F.col("_posterior")[k]).alias(f"m{i}_{k}") for i in range(n) for k in range(i, n)]
    first = members.agg(F.sum("_tokens").alias("tokens"), *moment).first()
    tokens = float(first["tokens"] or 0)
    if not tokens:
        return [], [0.0] * n
    moments = np.array([[first[f"m{min(i, k)}_{max(i, k)}"] for k in range(n)] for i in range(n)]) / tokens
    whitener = np.linalg.pinv(moments + 1e-9 * np.eye(n), rcond=1e-6, hermitian=True)
    steps: list[list[float]] = []
    for _ in range(most_steps + 1):
        weight = F.col("_tokens") * rate_after(steps)
        sums = members.agg(*[F.sum(weight * F.col("_posterior")[k]).alias(f"s{k}") for k in range(n)]).first()
        shares = np.array(sums, dtype=float) / tokens
        residual = shares - np.array(targets)
        if len(steps) == most_steps or np.abs(residual).max() < tolerance * max(targets):
            break
        steps.append((whitener @ residual).tolist())
    return steps, shares.tolist()


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The documents with n_tokens, a posterior per domain (p_...), rate and copies; no document is dropped.

    ``labelled`` has doc_id and domain. ``targets`` are shares of the token total, which is kept. copies is
    the rate as a whole number of uses: its floor, and one more for the share of documents, by a hash of
    the id, that the fraction says. Null and blank texts have no tokens, and a rate like any other. Columns
    of these names that came with the documents are replaced. Repeated documents are rated one by one.
    """
    targets = targets or TARGETS
    domains = list(targets)
    total = sum(targets.values())
    new = ["n_tokens", *(f"p_{d}" for d in domains), "rate", "copies"]
    kept = [c for c in docs.columns if c not in new]
    scored = with_posteriors(docs.select(*kept), labelled, domains, train_rows)
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    members = written(scored.withColumn("_tokens", words.cast("bigint")), "members")
    steps, _ = solve(members.select("_tokens", "_posterior"), [targets[d] / total for d in domains])
    rated = members.withColumn("rate", rate_after(steps))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    posteriors = [F.col("_posterior")[k].alias(f"p_{d}") for k, d in enumerate(domains)]
    return rated.select(*kept, F.col("_tokens").alias("n_tokens"), *posteriors, "rate", copies.cast("bigint").alias("copies"))
