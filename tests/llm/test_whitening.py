import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketmill.llm.whitening import count_above, feast, interval, tridiagonal, whiten

SCHEMA = "vec_id bigint, embedding array<float>, n string, component string"


def brute_force(rows):
    """Python integers for sums and deviations, a dense eigensolver for the rest."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept]
    n, d = len(x), len(x[0])
    sums = [sum(column) for column in zip(*x, strict=True)]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    centred = np.array([[(n * v - s) / n for v, s in zip(row, sums, strict=True)] for row in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    k = min(8, d)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [i for i, _ in kept], n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def check(df, rows):
    found = whiten(df).orderBy("vec_id", "component").collect()
    ids, n, deviation, whitened, explained = brute_force(rows)
    order = np.argsort(ids, kind="stable")
    k = whitened.shape[1]
    assert [r.vec_id for r in found] == [ids[i] for i in order for _ in range(k)]
    assert [r.component for r in found] == list(range(1, k + 1)) * len(ids)
    assert {r.n for r in found} == {n}
    assert [r.deviation for r in found[::k]] == [deviation[i] for i in order]
    got = np.array([r.whitened for r in found]).reshape(-1, k)
    want = whitened[order]
    got *= np.sign((got * want).sum(axis=0))
    assert np.abs(got - want).max() < 1e-8
    assert np.abs(np.array([r.explained for r in found[:k]]) / explained - 1).max() < 1e-10
    assert {r.identity_error for r in found} and found[0].identity_error < 1e-9


def vectors(seed, n, d, spread=3.0):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) * np.exp(-spread * np.arange(d) / d) @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 2


@pytest.mark.parametrize("n,d", [(300, 40), (50, 8), (20, 3), (30, 1)])
def test_against_dense_solver(spark, n, d):
    rows = [(i, v) for i, v in enumerate(vectors(n, n, d).tolist())]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    check(df, rows)


def test_given_table(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    check(df, [(r.vec_id, r.embedding) for r in df.collect()])


def test_unusable_vectors(spark):
    good = vectors(1, 40, 5).tolist()
    rows = list(enumerate(good)) + [(40, good[3]), (41, good[3])]
    bad = [(50, None), (51, []), (52, [1.0, None, 1.0, 1.0, 1.0]), (53, [math.nan] + [1.0] * 4), (54, [math.inf] + [1.0] * 4), (55, [-math.inf] * 5)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + bad], SCHEMA)
    check(df, rows)
    longer = df.union(spark.createDataFrame([(60, [1.0] * 6, "x", "y"), (61, [3e38] * 5, "x", "y")], SCHEMA))
    check(longer, rows)


def test_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4, [(1, None)], [(None, [0.5])]):
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
        found = whiten(df)
        assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert found.collect() == []


def test_null_ids_and_plane(spark):
    """All variance in two of four dimensions: two components."""
    rng = np.random.default_rng(2)
    flat = np.concatenate([rng.standard_normal((30, 2)), np.ones((30, 2))], axis=1)
    df = spark.createDataFrame([(None if i % 3 else 7, v, "x", "y") for i, v in enumerate(flat.tolist())], SCHEMA)
    found = whiten(df)
    assert found.count() == 60 and found.where("vec_id is null").count() == 40
    assert sorted(r[0] for r in found.select("component").distinct().collect()) == [1, 2]


def test_too_large_deviation_is_null(spark):
    rows = [(i, [1e6 * (i % 2), float(i)]) for i in range(4)] + [(9, [9e8, 0.0])]
    found = {r.vec_id: r.deviation for r in whiten(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).where(F.col("component") == 1).collect()}
    _, _, deviation, *_ = brute_force(rows)
    assert [found[i] for i, _ in rows] == [v if v < 1 << 63 else None for v in deviation]
    assert None in found.values()


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 31.0),
        np.r_[1e6, 10 - np.arange(20) / 10],
        np.r_[np.full(12, 5.0), np.full(8, 1.0)],
        np.r_[np.full(3, 7.0), np.linspace(3, 2.999999, 17)],
        np.r_[np.geomspace(1, 1e-9, 20)],
        np.r_[3.0, 2.0, np.zeros(10)],
        np.ones(9),
    ],
)
def test_contour_finds_all(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    got, found = feast(matrix, 8)
    want = np.sort(values)[::-1][: min(8, int((values > 1e-12 * values.max()).sum()))]
    assert len(got) == len(want) and np.abs(got - want).max() < 1e-12 * values.max()
    assert np.abs(found.T @ found - np.eye(len(got))).max() < 1e-12
    assert np.abs(matrix @ found - found * got).max() < 1e-11 * values.max()


def test_inertia():
    rng = np.random.default_rng(0)
    matrix = rng.standard_normal((25, 25))
    matrix = matrix + matrix.T
    values = np.linalg.eigvalsh(matrix)
    tri = tridiagonal(matrix)
    assert np.abs(np.linalg.eigvalsh(np.diag(tri[0]) + np.diag(tri[1], 1) + np.diag(tri[1], -1)) - values).max() < 1e-12
    assert [count_above(tri, s) for s in (-100, 0.0, 3.5, 100)] == [int((values > s).sum()) for s in (-100, 0.0, 3.5, 100)]
    low, high, inside = interval(tri, 8, 100.0)
    assert inside == 8 == ((values > low) & (values < high)).sum()
