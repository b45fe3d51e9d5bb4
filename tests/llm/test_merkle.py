import hashlib

import pytest
from pyspark.sql import functions as F

from basketmill.llm.merkle import _Print, build, edits, fingerprint_documents, likeness, read_tree, write_tree

SCHEMA = "doc_id bigint, text string, part bigint, end string"


def fingerprint(text):
    return write_tree(*build(text))


def brute_force(rows):
    rows = sorted(rows, key=lambda r: r[0])
    found = []
    for i, (doc, text) in enumerate(rows):
        own, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + other[:half]
        sha = hashlib.sha256(changed.encode()).hexdigest()
        mine, new, after = map(fingerprint, (own, changed, other))
        found.append((doc, len(own), sha, mine, new, pytest.approx(likeness(mine, new)), pytest.approx(likeness(mine, after))))
    return found


def test_tree():
    text = "One line. Two sentences here!\n\nA new section é.\nMore " + "words without end " * 50
    root, tree = read_tree(fingerprint(text))
    assert (root, tree) == build(text)
    assert likeness(fingerprint(text), fingerprint(text)) == 1.0
    assert likeness(fingerprint(text), fingerprint(text + " ")) < 1.0
    assert likeness(fingerprint(""), fingerprint("a")) == 0.0 and likeness(fingerprint(""), fingerprint("")) == 1.0
    assert edits(fingerprint(text), fingerprint(text.replace("A new", "An old"))) == [(1, 0)]
    assert edits(fingerprint(text), fingerprint(text)) == []
    assert len(fingerprint("x" * 300_000)) < 200


def test_pieces_realign_inside_a_paragraph():
    words = [f"w{i}" + "." * (i % 4 == 3) for i in range(1200)]
    assert likeness(fingerprint(" ".join(words)), fingerprint(" ".join(words[:101] + words[102:]))) > 0.98


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [tuple(r) for r in fingerprint_documents(docs).orderBy("doc_id").collect()]
    assert found == brute_force(plain)
    longer = [r for r in found if r[1] > 200]
    assert sum(r[5] > r[6] for r in longer) > 0.97 * len(longer)


def test_nulls_ties_and_repeats(spark):
    rows = [(2, "b"), (2, "b"), (None, "null id, first"), (1, None), (3, ""), (4, "é" * 5), (2, "other b")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    found = fingerprint_documents(docs)
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in found.collect()), key=repr)
    ordered = [tuple(r) for r in docs.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).select("doc_id", "text").collect()]
    want = []
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        sha, _, _, _, near = _Print(text or "").against(_Print(after or ""))
        want.append((doc, len(text or ""), sha, near))
    assert got == sorted(want, key=repr)


def test_one_and_no_document(spark):
    one = fingerprint_documents(spark.createDataFrame([(7, "abcd", 1, "x")], SCHEMA)).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in one] == [(7, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    assert fingerprint_documents(spark.createDataFrame([], SCHEMA)).count() == 0
