import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from basketmill.llm.arrays import texts_of
from basketmill.llm.langid import best_temperature, gram_counts, held_out, identify, softmax, train, with_language

SCHEMA = "doc_id bigint, text string, lang string, score double"


def test_gram_counts_count_letters_only():
    data, offsets = texts_of(pa.array(["Ab, ab!", None, "123 ?", "éÉ x"]))
    counts, has = gram_counts(data, offsets)
    assert has.tolist() == [True, False, False, True]
    # a, b, ab twice; "b " and "ab " twice; " a" and "b a" and " ab" once
    assert counts[0].sum() == 4 + 2 + 2 + 1 + 2 + 1 + 1 and counts[1].sum() == counts[2].sum() == 0
    alone, _ = gram_counts(*texts_of(pa.array(["éÉ x"])))
    assert (alone[0] == counts[3]).all()


def test_temperature_flattens_overconfident_scores():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(2000, 3))
    classes = np.array([rng.choice(3, p=p) for p in softmax(scores)])
    assert 0.8 < best_temperature(scores, classes) < 1.25
    assert 8 < best_temperature(scores * 10, classes) < 12.5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()
    model = train(docs.where(~held_out()))
    found = identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    assert len(found) > 200 and right / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)
    assert (model.weights == 0).mean() > 0.2


def test_edge_cases(spark):
    rows = [(i, "the cat sat on the mat", "en", 0.0) for i in range(8)] + [(i + 8, "le chat était là", "fr", 0.0) for i in range(8)]
    odd = [(None, "the cat", "en", 0.0), (90, None, "en", 0.0), (91, "", None, 0.0), (92, "12 !?", "fr", 0.0), (93, "the cat", None, 0.0)]
    docs = spark.createDataFrame(rows + odd + odd, SCHEMA)
    model = train(docs.where(~held_out()))
    found = identify(docs, model).collect()
    assert len(found) == 26
    by = {r.doc_id: r for r in found}
    assert [by[k].lang_pred for k in (90, 91, 92)] == ["und"] * 3 and by[93].lang_pred == "en" and by[8].lang_pred == "fr"
    kept = with_language(docs, model)
    assert kept.columns == docs.columns and kept.count() == 20
    empty = docs.where(F.lit(False))
    assert train(empty) is None and identify(empty, None).count() == 0
    assert {r.lang_pred for r in identify(docs, None).collect()} == {"und"}
