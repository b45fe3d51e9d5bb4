import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basketmill.llm import gru, lmscore

SCHEMA = "doc_id bigint, text string, lang string, score string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows):
    split = [(d, [*WORD.findall((t or "").translate(LOWER)), None]) for d, t in rows]
    apart = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in split]
    counts = Counter(w for (_, words), a in zip(split, apart, strict=True) if not a for w in words)
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for (doc, words), a in zip(split, apart, strict=True):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        found.append((doc, a, len(words), sum(counts[w] > 0 for w in words), total, base))
    return sorted(found, key=repr)


def check(df, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()), key=repr)
    want = brute_force(rows)
    assert [g[:5] for g in sorted(got, key=lambda r: repr(r[:5]))] == [w[:5] for w in sorted(want, key=lambda r: repr(r[:5]))]
    assert np.allclose(sorted(g[5] for g in got), sorted(w[5] for w in want), atol=1e-6)


def test_slope_matches_differences():
    shape = gru.Shape(members=3, classes=2, hidden=4)
    rng = np.random.default_rng(1)
    flat = gru.start(shape, rng.integers(1, 50, 6).astype(float), 9.0).astype(np.float64) + rng.normal(size=shape.size()) * 0.3
    ids = rng.integers(0, 7, size=(5, 3))
    before = np.vstack([[-1, 2, 6], ids[:-1]])
    before[3, 1] = -1
    state = rng.normal(size=(3, 4))
    _, slope, _ = gru.loss_and_slope(flat, shape, ids, before, state)
    for at in rng.permutation(shape.size())[:80]:
        step = np.zeros_like(flat)
        step[at] = 1e-6
        up, down = (gru.loss_and_slope(flat + s, shape, ids, before, state)[0] for s in (step, -step))
        assert slope[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_probabilities_sum_to_one_and_windows_do_not_matter():
    shape = gru.Shape(members=3, classes=2, hidden=4)
    flat = gru.start(shape, np.arange(1.0, 7.0), 4.0)
    whole = [np.array([3, 1, 6, i]) for i in range(7)] + [np.array([3, 1, 6])]
    scores = gru.score_texts(flat, shape, whole)
    assert (10 ** scores[:7]).sum() == pytest.approx(10 ** scores[7], rel=1e-4)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 7, size=n) for n in (0, 1, 5, 64, 65, 200, 5)]
    long, short = gru.score_texts(flat, shape, texts), gru.score_texts(flat, shape, texts, window=3, lanes=2)
    assert np.allclose(long, short, atol=1e-3) and long[0] == 0
    for t, s in zip(texts[1:], long[1:], strict=True):
        before = np.concatenate([[-1], t[:-1]])[:, None]
        loss, _, _ = gru.loss_and_slope(flat, shape, t[:, None], before, np.zeros((1, 4), dtype=np.float32))
        assert s == pytest.approx(-loss * len(t) / np.log(10), rel=1e-3)


def test_softmax_runs_once_for_all_classes(monkeypatch):
    shape = gru.Shape(members=3, classes=5, hidden=4)
    rng = np.random.default_rng(3)
    flat = gru.start(shape, rng.integers(1, 50, 15).astype(float), 9.0)
    calls = []
    monkeypatch.setattr(gru, "_loss_and_error", lambda *a, real=gru._loss_and_error: calls.append(len(a[1])) or real(*a))
    ids = np.arange(16 * 2).reshape(2, 16) % 16
    gru.loss_and_slope(flat, shape, ids, np.full((2, 16), -1), np.zeros((16, 4), dtype=np.float32))
    assert calls == [32, 30]  # the classes of all, the members of all but those of the last class
    p, states, ids = shape.views(flat), rng.normal(size=(200, 4)).astype(np.float32), rng.integers(0, 16, 200)
    whole = gru.output_log_probs(p, shape, states, ids)
    assert np.allclose(whole, gru.output_log_probs(p, shape, states, ids, block=7), atol=1e-5)
    for state, i, found in zip(states, ids, whole, strict=True):
        x = state @ p["class_out"] + p["class_bias"]
        want = x[i // 3] - np.log(np.exp(x).sum())
        if i < shape.words:
            y = state @ p["word_out"][i // 3] + p["word_bias"][i // 3]
            want += y[i % 3] - np.log(np.exp(y).sum())
        assert found == pytest.approx(want, abs=1e-4)


def test_scores_are_held_in_blocks_and_few_texts_have_long_windows(monkeypatch):
    shape = gru.Shape(members=3, classes=5, hidden=4)
    rng = np.random.default_rng(6)
    flat = gru.start(shape, rng.integers(1, 50, 15).astype(float), 9.0)
    held, calls = [], []
    monkeypatch.setattr(gru, "_loss_and_error", lambda x, *a, real=gru._loss_and_error: held.append(x.shape[1]) or real(x, *a))
    monkeypatch.setattr(gru, "output_log_probs", lambda *a, real=gru.output_log_probs: calls.append(len(a[3])) or real(*a))
    ids = rng.integers(0, 16, size=(16, 512))
    before = np.vstack([np.full(512, -1), ids[:-1]])
    loss, slope, _ = gru.loss_and_slope(flat, shape, ids, before, np.zeros((512, 4), dtype=np.float32))
    assert max(held) <= gru.BLOCK < sum(held)
    whole, by_whole, _ = gru.loss_and_slope(flat, shape, ids, before, np.zeros((512, 4), dtype=np.float32), block=ids.size)
    assert loss == pytest.approx(whole, rel=1e-5) and np.allclose(slope, by_whole, atol=1e-6)
    gru.score_texts(flat, shape, [rng.integers(0, 16, 5000)])
    assert calls == [5000]


@pytest.mark.filterwarnings("error")
def test_large_weights_stay_in_range():
    shape = gru.Shape(members=3, classes=2, hidden=4)
    rng = np.random.default_rng(7)
    flat = (gru.start(shape, np.arange(1.0, 7.0), 4.0) + rng.normal(size=shape.size()) * 200).astype(np.float32)
    assert not gru._within_range(shape.views(flat)["class_out"], np.zeros((1, 4)))
    p = shape.views(flat.astype(np.float64))
    text, state, want = rng.integers(0, 7, 40), np.zeros(4), 0.0
    for last, i in zip([-1, *text[:-1]], text, strict=True):
        gates = p["first"] + (p["input"][last] if last >= 0 else 0)
        own = state @ p["carry"]
        keep, reset = (0.5 + 0.5 * np.tanh((gates[a : a + 4] + own[a : a + 4]) / 2) for a in (0, 4))
        fresh = np.tanh(gates[8:] + reset * own[8:])
        state = fresh + keep * (state - fresh)
        x = state @ p["class_out"] + p["class_bias"]
        want += x[i // 3] - np.logaddexp.reduce(x)
        if i < shape.words:
            y = state @ p["word_out"][i // 3] + p["word_bias"][i // 3]
            want += y[i % 3] - np.logaddexp.reduce(y)
    assert gru.score_texts(flat, shape, [text])[0] == pytest.approx(want / np.log(10), rel=1e-2)
    before = np.append(-1, text[:-1])[:, None]
    loss, slope, _ = gru.loss_and_slope(flat, shape, text[:, None], before, np.zeros((1, 4), dtype=np.float32))
    assert loss == pytest.approx(-want / 40, rel=1e-2) and np.isfinite(slope).all()


def test_places_in_the_table():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 3, 1000):
        words = np.unique(np.append(rng.integers(0, 1 << 64, n, dtype=np.uint64), [np.uint64(2**64 - 1)] * (n > 1)).astype(np.uint64))
        table = lmscore.Frequencies(1, 1, words, words.view(np.int64), words.view(np.int64), 0, 0)
        where = {int(w): i for i, w in enumerate(words)}
        asked = np.concatenate([words, words - np.uint64(1), words + np.uint64(1), np.array([0, 5, 2**64 - 1], dtype=np.uint64)])
        assert table.places(asked).tolist() == [where.get(int(w), -1) for w in asked]


def test_slope_by_word_of_many_and_of_large_numbers():
    rng = np.random.default_rng(4)
    for words in (rng.integers(0, 9, 500), rng.integers(0, 9, 500) + (1 << 16), np.array([5])):
        rows = rng.normal(size=(len(words), 3))
        found, sums = gru._sums_by_word(words, rows)
        assert found.tolist() == sorted(set(words.tolist()))
        assert all(np.allclose(s, rows[words == w].sum(axis=0)) for w, s in zip(found, sums, strict=True))


def test_training_lowers_the_loss():
    shape = gru.Shape(members=4, classes=2, hidden=8)
    texts = [np.tile([0, 1, 2, 3, 4, 5, 6, 7], 6) for _ in range(60)]
    flat = gru.start(shape, np.full(8, 100.0), 1.0)
    after = flat
    for _ in range(3):
        after = gru.train_windows(after, shape, texts, lanes=2)
    assert gru.score_texts(after, shape, texts[:1])[0] > 0.3 * gru.score_texts(flat, shape, texts[:1])[0]


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for sent in (lmscore.SENT_WORDS, 2500, 10):
        check(lmscore.score_documents(docs, sent_words=sent), rows)


def test_model_beats_frequencies_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = lmscore.score_documents(docs).where("held_out").select("n_tokens", "base_score", "score").collect()
    base, score, n = (sum(r[c] for r in rows) for c in ("base_score", "score", "n_tokens"))
    print("per token", base / n, score / n)
    assert score > base * 0.97 and all(r.score <= 0 for r in rows)


def test_edge_cases(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, " \t\n"), (4, "A a É é"), (4, "A a É é"), (5, "rare"), (6, "word " * 30_000)]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows += [(i, "a unseen unseen") for i in held]
    docs = spark.createDataFrame([(*r, "en", "x") for r in rows], SCHEMA)
    check(lmscore.score_documents(docs, one_in=1, rounds=2), rows)
    check(lmscore.score_documents(docs, one_in=1, rounds=1, sent_words=0), rows)
    only = [r for r in rows if r[0] in held]
    check(lmscore.score_documents(docs.where(docs.doc_id.isin(held))), only)
    assert lmscore.score_documents(docs.where("false")).count() == 0


def test_learns_from_every_document(spark, monkeypatch):
    seen = {}

    def write(df, name, real=lmscore.written):
        seen[name] = real(df, name)
        return seen[name]

    monkeypatch.setattr(lmscore, "written", write)
    rows = [(None if i % 2 else i, f"null ids {i} differ") for i in range(400)]
    docs = spark.createDataFrame([(*r, "en", "x") for r in rows], SCHEMA)
    lmscore.score_documents(docs).collect()
    sample = seen["lm_sample"].collect()
    training = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 10]
    assert len(sample) == len(training) and {r["round"] for r in sample} == set(range(lmscore.ROUNDS))


def test_small_shards_and_last_tokens_count(spark):
    docs = spark.createDataFrame([(None, "a b a b a b", "en", "x")] * 3, SCHEMA)
    counts = spark.createDataFrame([(w, n) for w, n in ((1, 9), (2, 9), (3, 3))], "word bigint, n bigint")
    table = lmscore.frequencies(counts)
    begun = lmscore.learn(docs.where("false"), table)
    assert not np.array_equal(lmscore.learn(docs, table), begun)
    shape = gru.Shape(members=4, classes=2, hidden=8)
    flat = gru.start(shape, np.full(8, 100.0), 1.0)
    texts = [np.tile([0, 1, 2], 11), np.array([7])]
    last = [gru.train_windows(flat, shape, [texts[0], t], lanes=3) for t in (texts[1], texts[1] - 1)]
    assert not np.array_equal(*last)
