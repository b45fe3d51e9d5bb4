import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_decontaminate import brute_force as contaminated
from test_minhash import brute_force as grouped

from basketmill.llm.secrets import redacted


@pytest.fixture(scope="module")
def planted(spark, small, tmp_path_factory):
    """The given documents with a few odd ones: no letters, copies, a benchmark passage, nulls, further columns."""
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").limit(2).collect()]
    text = max((r.text for r in docs.collect()), key=len)
    odd = [
        (900, "1234 !!", "en", "s", 7), (901, None, "en", "s", None), (902, "", None, "s", 0), (903, text, "en", "s", len(text)),
        (904, text.replace(" ", "  "), "en", "s", None), (905, f"The words before {items[0]}", "en", "s", None),
        (906, f"{items[1]} token = abcdef0123", None, None, 0), (None, "the cat and the dog are in the house", "en", "s", 3),
    ]
    whole = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("rate", F.lit("clash"))
    whole.repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def chain(spark, planted):
    """The documents and what each stage makes of its predecessor's, written and read again."""
    frames = [spark.read.parquet(f"{planted}/documents.parquet")]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{planted}/out_{number}"
        stage(spark, frames[-1], planted).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def test_each_stage_on_its_own_input(spark, planted, chain):
    columns, first = chain[0].columns, chain[0].count()
    before = chain[0].collect()
    for (name, _), docs in zip(corpus_pipeline.STAGES, chain[1:], strict=True):
        after = docs.collect()
        if name != "mix":
            assert docs.columns == columns
        ids = sorted((r.doc_id for r in after), key=repr)
        if name == "language":
            lost = [r for r in before if r.doc_id not in set(ids)]
            assert {900, 901, 902} <= {r.doc_id for r in lost}
            assert len([r for r in lost if r.text and any(c.isalpha() for c in r.text)]) <= 0.01 * first
        elif name == "near_duplicates":
            groups = grouped([(r.doc_id, r.text) for r in before], percent=80)
            assert ids == sorted((d for d, _, c, k in groups if k), key=repr)
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{planted}/benchmark.parquet").collect()]
            bad = {r[0] for r in contaminated([(r.doc_id, r.text) for r in before], items) if r[-1]}
            assert {905, 906} <= bad and ids == sorted((r.doc_id for r in before if r.doc_id not in bad), key=repr)
        elif name == "secrets":
            assert {r.doc_id: r.text for r in after} == {r.doc_id: redacted(r.text) for r in before}
        else:
            assert ids == sorted((r.doc_id for r in before), key=repr) and all(r.rate >= 0 for r in after)
        before = after


def test_run_is_the_chain_of_stages(spark, planted, chain):
    ran = corpus_pipeline.run(spark, planted)
    chained = chain[-1]
    assert ran.columns == chained.columns
    assert sorted(r[0] for r in ran.select(F.xxhash64("doc_id", "text")).collect()) == sorted(
        r[0] for r in chained.select(F.xxhash64("doc_id", "text")).collect()
    )


def test_registered(spark):
    import __spark_entry__ as contract

    names = [n for n in contract.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def test_one_query_per_sql(spark, small):
    import __spark_entry__ as contract
    from compare import compare, database

    from basketmill.llm.queries import ORACLE

    db = database(small)
    for name, sql in ORACLE.items():
        assert compare(contract.queries()[name](spark, small), db, sql)[0] == []


def test_near_duplicates_stage_links_from_080(spark):
    words = [f"w{i}" for i in range(100)]
    light = [*words[:30], "x", *words[31:60], "y", *words[61:]]  # 86 of 106 shingles are common: 0.81
    heavy = [f"v{i}" for i in range(100)]
    other = [*heavy[:20], "x", *heavy[21:50], "y", *heavy[51:80], "z", *heavy[81:]]  # 81 of 111: 0.73
    rows = [(i, " ".join(w)) for i, w in enumerate((words, light, heavy, other))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 2, 3]


def test_one_document_of_a_group_with_equal_or_no_ids(spark):
    def copies(mark):
        return [" ".join([f"{mark}{i}" for i in range(100)] + [end]) for end in ("x", "y", "z")]

    rows = [(None, t) for t in copies("a")] + [(7, t) for t in copies("b")] + [(7, t) for t in copies("c")]
    rows += [(None, None), (8, ""), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [(r.doc_id, (r.text or "")[:1]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([(None, "a"), (7, "b"), (7, "c"), (None, ""), (8, ""), (9, " ")], key=repr)
