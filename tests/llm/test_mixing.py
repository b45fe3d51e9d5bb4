import numpy as np
import pytest
from pyspark.sql import functions as F

from basketmill.llm.mixing import TARGETS, label_domain, mix, rate_after, solve

SCHEMA = "doc_id bigint, text string, lang string, rate string"


def labelled(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label_domain().alias("domain"))


def test_steps_match_plain_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.4, 0.3, 0.2], size=500)
    tokens = rng.integers(1, 900, size=500)
    target = np.array([0.2, 0.2, 0.6])
    df = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p, strict=True)], "_tokens bigint, _posterior array<double>").cache()
    steps, shares = solve(df, target.tolist())
    weight = tokens / tokens.sum()
    inverse = np.linalg.inv((p * weight[:, None]).T @ p + 1e-9 * np.eye(3))
    rate = np.ones(500)
    for _ in steps:
        residual = (rate * weight) @ p - target
        rate = np.maximum(0, rate - p @ (inverse @ residual))
    got = np.array([r[0] for r in df.select(rate_after(steps)).collect()])
    assert np.allclose(got, rate, atol=1e-5) and (got >= 0).all()
    assert np.allclose(shares, target, atol=1e-3) and np.allclose((got * weight) @ p, target, atol=1e-3)


def test_given_documents_meet_the_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = mix(docs, labelled(spark, folder))
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns[: len(docs.columns)] == docs.columns
    tokens = sum(r.n_tokens for r in rows)
    for domain, share in TARGETS.items():
        got = sum(r.rate * r.n_tokens * r[f"p_{domain}"] for r in rows) / tokens
        assert got == pytest.approx(share, abs=0.005)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert all(r.p_good + r.p_low + r.p_toxic == pytest.approx(1) for r in rows)


def test_edge_cases(spark):
    rows = [(i, "good words here", "en", "x") for i in range(6)] + [(i + 6, "bad bad bad", "en", "x") for i in range(6)]
    rows += [(None, "good", None, "x"), (50, None, None, None), (51, "", "en", "x"), (52, "word " * 30_000, "en", "x"), rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA)
    names = "doc_id bigint, domain string"
    labels = spark.createDataFrame([(i, "good" if i < 6 else "toxic") for i in range(12)] + [(None, "good"), (1, None), (0, "good")], names)
    out = mix(docs, labels)
    assert out.count() == len(rows) and out.columns == ["doc_id", "text", "lang", "n_tokens", "p_good", "p_low", "p_toxic", "rate", "copies"]
    assert out.agg(F.max("p_low")).first()[0] == 0.0
    one = mix(docs, labels.where("domain = 'good'")).select("p_good").distinct().collect()
    none = mix(docs, labels.where("false")).select("p_good").distinct().collect()
    assert [r[0] for r in one] == [1.0] and none[0][0] == pytest.approx(1 / 3)
    assert mix(docs.where("false"), labels).count() == 0
