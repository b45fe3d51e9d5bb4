import numpy as np
import pyarrow as pa

from basketmill.llm.arrays import texts_of
from basketmill.llm.toxicity import FEATURE_NAMES, FOLDS, Lexicon, _entries, describe, held_out, score_toxicity, split_words, train
from basketmill.llm.arrays import ALPHANUMERIC, span_hashes

SCHEMA = "doc_id bigint, text string, lang string, toxic string"


def lexicon_of(words):
    data, offsets = texts_of(pa.array([" ".join(words)]))
    spans = split_words(data, offsets, ALPHANUMERIC)
    hashes = np.unique(span_hashes(data, spans.starts, spans.ends))
    return Lexicon(hashes, np.full((len(hashes), FOLDS + 1), 3.0))


def features(text, lexicon):
    data, offsets = texts_of(pa.array(["before", text, None, "after"]))
    row = describe(data, offsets, np.full(4, FOLDS), lexicon)[1]
    return dict(zip(FEATURE_NAMES, row, strict=True))


def test_features_count_words():
    lexicon = lexicon_of(["idiot", "scum"])
    got = features("You are an IDIOT, scum! x 1d10t $cum a1", lexicon)
    assert np.isclose(np.expm1(got["strong_words"]), 2) and got["top_weight"] == 3.0
    assert np.isclose(np.expm1(got["disguised"]), 2)
    assert got["near_second_person"] > 0 and np.isclose(np.expm1(got["distinct_strong"]), 2)
    assert features("idiot " + "pad " * 9 + "you", lexicon)["near_second_person"] == 0
    assert features("", lexicon) == dict.fromkeys(FEATURE_NAMES, 0.0)
    assert features("CAPS here!", lexicon)["shouted_words"] == 0.5


def test_entries_are_words_and_beginnings():
    data, offsets = texts_of(pa.array(["abcdefg ab", "abcdxyz"]))
    words = split_words(data, offsets, ALPHANUMERIC)
    text, hashes = _entries(data, words, words.text_of_word())
    # three words, and beginnings of 4, 5 and 6 bytes of the two long ones; those of 4 are equal
    assert len(text) == 9 and len(np.unique(hashes)) == 8


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_toxicity(docs, train(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    score, toxic = np.array([r.score for r in scored]), np.array([r.toxic for r in scored])
    order = np.argsort(np.argsort(score))
    auc = (order[toxic == 1].mean() - (toxic.sum() - 1) / 2) / (toxic == 0).sum()
    predicted = score >= 0.3
    precision, recall = toxic[predicted].mean(), predicted[toxic == 1].mean()
    print("auc", auc, "precision", precision, "recall", recall)
    assert auc > 0.93 and precision > 0.85 and recall > 0.85


def test_edge_cases(spark):
    rows = [(i, "you are a scum idiot" if i % 2 else "a fine day", "en", "x") for i in range(60)]
    rows += [(None, "scum", None, None), (100, None, None, None), (101, "", "en", "x"), rows[1], (102, "idiot " * 30_000, "en", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = "doc_id bigint, quality int, toxic int"
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (3, 0, None), (1, 0, 1)], marks)
    model = train(docs, labels)
    got = score_toxicity(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].predicted == 1 and by[2].predicted == 0 and by[100].score == by[101].score
    assert train(docs, labels.where("toxic = 0")) == 0.0 and train(docs, labels.where("false")) == 0.0
    assert {r.score for r in score_toxicity(docs, 0.0).collect()} == {0.0}
    assert score_toxicity(docs.where("false"), model).count() == 0
    crc = {r.doc_id: r.held_out for r in docs.select("doc_id", held_out().alias("held_out")).collect()}
    import zlib

    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in crc.items() if d is not None)
