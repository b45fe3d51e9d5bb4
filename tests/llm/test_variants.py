import random
import re
from collections import Counter
from zlib import crc32

import pytest

from basketmill.llm.variants import affected, decompose, entries, frequent_grams, near_words, spelling_variants, variant_groups, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, word string, n string"


def counted(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_force(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def edited(rng, word):
    at, letter = rng.randrange(len(word) + 1), rng.choice("abeéÿ")
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])


def vocabulary(seed, size):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abeéÿ", k=rng.randrange(6, 11))) for _ in range(size)}
    words |= {"pre" + w for w in words} | {w + "tion" for w in words}
    for w in sorted(words):
        words.update(edited(rng, w) for _ in range(rng.randrange(3)))
    return {w: rng.choice([5, 6, 30, 31, 200, 1000, 30_000]) for w in sorted(words) if len(w) >= 6}


@pytest.mark.parametrize("list_length,most", [(2, 1 << 18), (32, 1 << 18), (1, 10)])
def test_groups(spark, list_length, most):
    counts = vocabulary(list_length, 60)
    df = spark.createDataFrame(sorted(counts.items()), "word string, n bigint").repartition(3)
    assert got(variant_groups(df, list_length, most)) == brute_force(counts)


def test_words_of_documents(spark):
    rng = random.Random(3)
    base = ["Straße", "language", "ÀÉÿabc", "colouring", "statement", "abc", "xxxxxx", "Ünïçödé"]
    rows = [(i, " ".join(rng.choice(base) + rng.choice([" ", "-", "0", "语", "\n", "Ā"]) for _ in range(40))) for i in range(60)]
    rows += [(None, "language Language LANGUAGE"), (7, None), (8, ""), (-9, "languages " * 20), (-9, "languages " * 20), (10, "q" * 5000)] * 5
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    counts = counted(rows)
    assert {r.word: r.n for r in word_counts(df).collect()} == counts
    assert any(len(w) > 1000 for w in counts)
    assert got(spelling_variants(df)) == brute_force(counts)


def test_given_documents(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    counts = counted([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert got(spelling_variants(df)) == brute_force(counts)


def test_empty(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert variant_groups(spark.createDataFrame([(None, 9)], "word string, n bigint")).collect() == []


def test_chain_of_forms(spark):
    """aaaaaa0 after aaaaaab after ...: every link five times as frequent."""
    words = ["abcdef", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefghijk", "abcdefghijkl"]
    counts = {w: 5 ** (i + 1) for i, w in enumerate(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert {r[2] for r in got(variant_groups(df))} == {words[-1]}


def test_crowded_list(spark):
    """A thousand words that share their rarest-looking beginning; no pair is lost."""
    rng = random.Random(9)
    counts = {"inter" + "".join(rng.choices("abcdefgh", k=4)): rng.randrange(5, 500) for _ in range(1000)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    wanted = {(a, b) for a in counts for b in counts if one_edit(a, b)}
    assert {(r.word, r.near) for r in near_words(df).collect()} == wanted


def test_dictionary_is_bounded(spark):
    counts = vocabulary(4, 300)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert len(frequent_grams(df, 1, 50)) <= 50
    assert len(frequent_grams(df, 1)) > 50


def test_grams_of_a_word():
    frequent = {"an": 9, "ana": 9, "na": 9}
    grams = decompose("banana", frequent)
    assert ["^banana$"[a:b] for a, b in grams] == ["^b", "ba", "anan", "nan", "ana$", "na$", "a$"]
    assert affected(grams) == 4  # the second n is in anan, nan, ana$ and na$
    assert all(affected(decompose("x" * size, {"x" * k: 9 for k in range(2, 7)})) < size + 1 for size in range(6, 12))
    assert len(entries("banana", frequent)) <= 10
