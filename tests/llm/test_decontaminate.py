import hashlib
import re

import pytest
from pyspark.sql import functions as F

from basketmill.llm.decontaminate import contamination, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_force(docs, items, window=13):
    """Every window of every item as a tuple, looked up at every place of every document."""
    holders = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            holders.setdefault(tuple(own[i : i + window]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in holders}
    found = []
    for doc, text in docs:
        own, hit, held = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                names = holders.get(tuple(own[i : i + size]))
                if names:
                    held |= names
                    hit |= set(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        found.append((doc, len(own), len(hit), len(held), digest, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(found, key=repr)


def got(df):
    picked = df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r) for r in picked.collect()), key=repr)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
ITEMS = [(1, ITEM), (2, "Short item"), (3, None), (4, ""), (None, "é ß one"), (10, ITEM + " pi"), (1, "second text of one")]
DOCS = [
    (1, f"x y {ITEM.upper()} z"),
    (2, None),
    (3, ""),
    (4, "nothing here"),
    (5, "a SHORT-item, short. item"),
    (5, "a SHORT-item, short. item"),
    (None, "É ß é ß one"),
    (6, " ".join(["pad"] * 300) + " short item"),
    (7, "short"),
    (8, "item"),
    (9, ITEM + " " + ITEM + " pi"),
    (10, "Second text of one"),
]


@pytest.mark.parametrize("block", [10_000_000, 20])
def test_planted_windows(spark, block):
    docs = spark.createDataFrame([(*d, "en") for d in DOCS], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert got(contamination(docs, items, block_chars=block)) == brute_force(DOCS, ITEMS)


def test_longest_match_and_removal(spark):
    docs = spark.createDataFrame([(*d, "en") for d in DOCS], SCHEMA).withColumn("_items", F.lit(1)).withColumn("n_hit", F.lit(2))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    row = contamination(docs, items).where("doc_id = 1").first()
    assert [(m.item, m.item_word, m.doc_word, m.n_words) for m in row.matches if m.item == "1"] == [("1", 0, 2, 15)]
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    bad = {r[0] for r in brute_force(DOCS, ITEMS) if r[-1]}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in DOCS} - bad


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs, items).count() == 0
    full = spark.createDataFrame([(1, "a b", "en")], SCHEMA)
    assert got(contamination(full, items)) == brute_force([(1, "a b")], [])


def test_given_documents(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    tests = [(r.item_id, r.text) for r in items.collect()]
    found = got(contamination(docs, items))
    assert found == brute_force(plain, tests) and any(r[-1] for r in found)
