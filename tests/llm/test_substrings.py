import random
import re

import numpy as np
import pytest

from basketmill.llm.substrings import _packed, _unpacked, digest, remove_repeats

SCHEMA = "doc_id bigint, text string, late string, found string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, size):
    """All windows of all documents in a dictionary; words of repeated ones go."""
    least = {}
    split = [WORD.findall(text or "") for _, text in rows]
    for (doc, _), words in zip(rows, split, strict=True):
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if doc is not None:
                least[window] = min(doc, least.get(window, doc))
    found = []
    for (doc, _), words in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(words) - size + 1):
            first = least.get(tuple(words[i : i + size]))
            if first is not None and (doc is None or first < doc):
                gone.update(range(i, i + size))
        starts = [i for i in sorted(gone) if i - 1 not in gone]
        ends = [i + 1 for i in sorted(gone) if i + 1 not in gone]
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((doc, len(words), len(gone), list(zip(starts, ends, strict=True)), kept))
    return sorted(found, key=repr)


def got(spark, rows, size, partitions=3):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(partitions)
    found = remove_repeats(df, size=size).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(i) for i in r.removed], r.kept) for r in found), key=repr)


def test_small_cases(spark):
    rows = [(1, "a b c d"), (2, "x a b c y"), (3, "A b c"), (4, "a b"), (5, None), (6, ""), (7, " \t\n "), (8, "c d a  b c\td é")]
    rows += [(9, "k k k k k"), (10, "k k k"), (11, "k k k k k k z z z"), (None, "a b c"), (None, "n n n"), (None, "n n n"), (None, "a b c")]
    rows += [(12, "r r r"), (12, "r r r"), (12, "q r r r"), (-3, "neg a tive"), (0, "neg a tive"), (1 << 62, "neg a tive")]
    rows += [(13, "no break space x"), (14, "no break space x"), (15, "　 wide space"), (16, "　 wide space")]
    assert got(spark, rows, 3) == brute_force(rows, 3)


@pytest.mark.parametrize("partitions", [1, 7])
def test_shared_passages(spark, partitions):
    rng = random.Random(partitions)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "Wörter", "語"]
    passages = [rng.choices(vocabulary, k=rng.randrange(50, 90)) for _ in range(6)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(passages)
        rows.append((rng.randrange(1000), "  ".join(words)))
    assert got(spark, rows, 50, partitions) == brute_force(rows, 50)


def test_one_window_in_every_document(spark):
    """A hot window beside a very long text."""
    rng = random.Random(1)
    hot = " ".join(f"h{i}" for i in range(50))
    rows = [(i, f"own{i} {hot} tail{i}") for i in range(400)]
    rows.append((-1, " ".join(rng.choices(["a", "b"], k=60_000)) + " " + hot))
    found = got(spark, rows, 50)
    assert found == brute_force(rows, 50)
    assert sum(r[2] == 50 for r in found) == 400


def test_empty_table_and_digest(spark, small):
    empty = spark.createDataFrame([], SCHEMA)
    assert remove_repeats(empty).collect() == []
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert digest(remove_repeats(docs)).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    # Text ids are read as numbers.
    as_text = docs.selectExpr("cast(doc_id as string) as doc_id", "text")
    assert sorted(r.n_removed for r in remove_repeats(as_text).collect()) == sorted(r.n_removed for r in remove_repeats(docs).collect())
    named = docs.selectExpr("'n' || doc_id as doc_id", "text")
    assert not any(r.n_removed for r in remove_repeats(named).collect())


@pytest.mark.parametrize("ids", [[5], [-9, 0, 255], [3, 3, 300], [0, 70_000], [-(1 << 63), (1 << 63) - 1]])
def test_packed_ids(ids):
    assert _unpacked(_packed(np.array(ids, dtype=np.int64))).tolist() == ids
