"""Benchmark decontamination by suffix arrays over the training documents.

Every block of training texts becomes a shard: its words are ranked by the test vocabulary and its
suffixes, cut at the window length, are sorted. Every test suffix is then found by binary search in
every shard, which gives all places where a window of the test set occurs; neighbouring places on the
same diagonal are joined to longest verbatim matches. Suffixes that leave the test vocabulary
within the window cannot match and are left out before sorting.

The test set is read in blocks of about ``block_chars`` characters of distinct text; each block visits all
documents, which never leave their partition, and is released before the next is read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import ALPHANUMERIC, blocks, span_hashes, split_words
from basketmill.llm.staging import written

WINDOW = 13
# A document is contaminated if hit words are at least one in so many.
ONE_IN = 20
BLOCK_CHARS = 16_000_000

_MATCH = "struct<item: string, item_word: bigint, doc_word: bigint, n_words: bigint>"


@dataclass
class TestSet:
    """Windows of a block of test items: ranks of their words, and the items and places that hold each."""

    __test__ = False
    vocabulary: np.ndarray
    lengths: np.ndarray
    ranks: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    names: list[str]


def _packed(ranks: np.ndarray, bits: int) -> np.ndarray:
    """Rows of ranks as byte strings that sort as the rows do."""
    per = 63 // bits
    keys = np.zeros((len(ranks), -(-ranks.shape[1] // per)), dtype=">u8")
    for k in range(ranks.shape[1]):
        at = k // per
        keys[:, at] = (keys[:, at].astype(np.uint64) << np.uint64(bits)) | ranks[:, k].astype(np.uint64)
    return np.ascontiguousarray(keys).view(f"S{8 * keys.shape[1]}").reshape(-1)


def read_test_set(names: list[str], texts: list[str], window: int = WINDOW) -> TestSet:
    """Index the windows of some items. Items of fewer words than ``window`` are one window."""
    column = pa.array(texts, pa.large_string())
    parts, firsts = [], [np.zeros(1, dtype=np.int64)]
    for _, _, data, offsets in blocks(column):
        words = split_words(data, offsets, ALPHANUMERIC)
        parts.append(span_hashes(data, words.starts, words.ends))
        firsts.append(words.first[1:] + firsts[-1][-1])
    hashes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    first = np.concatenate(firsts)
    vocabulary, ranks = np.unique(hashes, return_inverse=True)
    ranks = ranks + 1
    rows, lengths, item, place = [], [], [], []
    for i, n in enumerate(np.diff(first)):
        size = min(int(n), window)
        if not size:
            continue
        starts = np.arange(int(n) - size + 1)
        row = np.zeros((len(starts), window), dtype=np.int64)
        row[:, :size] = ranks[first[i] + starts[:, None] + np.arange(size)]
        rows.append(row)
        lengths.append(np.full(len(starts), size))
        item.append(np.full(len(starts), i))
        place.append(starts)
    if not rows:
        none = np.zeros(0, dtype=np.int64)
        return TestSet(vocabulary, none, none.reshape(0, window), np.zeros(1, dtype=np.int64), none, none, names)
    rows, lengths = np.concatenate(rows), np.concatenate(lengths)
    distinct, which = np.unique(np.column_stack([lengths, rows]), axis=0, return_inverse=True)
    order = np.argsort(which.reshape(-1), kind="stable")
    borders = np.searchsorted(which.reshape(-1)[order], np.arange(len(distinct) + 1))
    return TestSet(
        vocabulary, distinct[:, 0], distinct[:, 1:], borders, np.concatenate(item)[order], np.concatenate(place)[order], names
    )


def occurrences(hashes: np.ndarray, first: np.ndarray, tests: TestSet, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(word place, test window) for every occurrence of a test window inside one of the texts."""
    none = np.zeros(0, dtype=np.int64)
    if not len(tests.vocabulary) or not len(hashes):
        return none, none
    at = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    ranks = np.where(tests.vocabulary[at] == hashes, at + 1, 0)
    known = np.concatenate([[0], np.cumsum(ranks > 0)])
    stop = np.repeat(first[1:], np.diff(first))
    bits = max(1, int(len(tests.vocabulary)).bit_length())
    places, found = [], []
    for size in np.unique(tests.lengths):
        mine = np.flatnonzero(tests.lengths == size)
        starts = np.zeros(len(tests.vocabulary) + 1, dtype=bool)
        starts[tests.ranks[mine, 0]] = True
        end = np.minimum(np.arange(len(hashes)) + size, len(hashes))
        fits = (known[end] - known[:-1] == size) & (np.arange(len(hashes)) + size <= stop) & starts[ranks]
        suffixes = np.flatnonzero(fits)
        if not len(suffixes):
            continue
        keys = _packed(ranks[suffixes[:, None] + np.arange(size)], bits)
        order = np.argsort(keys, kind="stable")
        keys, suffixes = keys[order], suffixes[order]
        wanted = _packed(tests.ranks[mine, :size], bits)
        low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
        hit = np.flatnonzero(high > low)
        n = (high - low)[hit]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        places.append(suffixes[np.repeat(low[hit], n) + inside])
        found.append(np.repeat(mine[hit], n))
    return (np.concatenate(places), np.concatenate(found)) if places else (none, none)


def _longest(places: np.ndarray, found: np.ndarray, tests: TestSet) -> np.ndarray:
    """Longest matches (item, word in the item, word place, words) from window occurrences."""
    n = tests.first[found + 1] - tests.first[found]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    holder = np.repeat(tests.first[found], n) + inside
    at, size = np.repeat(places, n), np.repeat(tests.lengths[found], n)
    item, place = tests.item[holder], tests.place[holder]
    order = np.lexsort((at, at - place, item))
    item, place, at, size = item[order], place[order], at[order], size[order]
    fresh = np.ones(len(item), dtype=bool)
    fresh[1:] = (item[1:] != item[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)
    starts = np.flatnonzero(fresh)
    last = np.concatenate([starts[1:], [len(item)]]) - 1 if len(item) else starts
    return np.column_stack([item[starts], place[starts], at[starts], at[last] - at[starts] + size[last]])


def _scan(tests: TestSet, window: int):
    def shard(batches):
        for batch in batches:
            n_words, covers, items, matches = [], [], [], []
            for low, high, data, offsets in blocks(batch.column("text")):
                words = split_words(data, offsets, ALPHANUMERIC)
                hashes = span_hashes(data, words.starts, words.ends)
                places, found = occurrences(hashes, words.first, tests, window)
                text = np.searchsorted(words.first, places, "right") - 1
                n_words.extend(words.counts.tolist())
                rows = {int(t): [[], set(), []] for t in np.unique(text)}
                steps = np.zeros(len(hashes) + 1, dtype=np.int64)
                np.add.at(steps, places, 1)
                np.add.at(steps, places + tests.lengths[found], -1)
                # A window never leaves its text, but two texts may touch: cut runs at text borders.
                inside = np.cumsum(steps[:-1]) > 0
                edge = inside.copy()
                edge[1:] &= ~inside[:-1]
                heads = words.first[:-1][words.counts > 0]
                edge[heads] = inside[heads]
                begins = np.flatnonzero(edge)
                close = inside.copy()
                close[:-1] &= ~inside[1:]
                close[words.first[1:][words.counts > 0] - 1] = inside[words.first[1:][words.counts > 0] - 1]
                ends = np.flatnonzero(close) + 1
                for t, b, e in zip(np.searchsorted(words.first, begins, "right") - 1, begins, ends, strict=True):
                    base = words.first[t]
                    rows[int(t)][0].append({"start": int(b - base), "stop": int(e - base)})
                for item, place, at, size in _longest(places, found, tests).tolist():
                    t = int(np.searchsorted(words.first, at, "right")) - 1
                    rows[t][1].add(tests.names[item])
                    rows[t][2].append(
                        {"item": tests.names[item], "item_word": place, "doc_word": at - int(words.first[t]), "n_words": size}
                    )
                for i in range(high - low):
                    cover, held, longest = rows.get(i, ([], set(), []))
                    covers.append(cover)
                    items.append(sorted(held))
                    matches.append(longest)
            span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            match = pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())])
            columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
            columns["n_words"] = pa.array(n_words, pa.int64())
            for name, new, kind in (("_covers", covers, span), ("_items", items, pa.string()), ("_matches", matches, match)):
                columns[name] = pa.array(new, pa.list_(kind))
            yield pa.RecordBatch.from_pydict(columns)

    return shard


def _verdicts(batches):
    """Union of the covered words and of the items over all test blocks."""
    for batch in batches:
        hits, n_items, digests = [], [], []
        for covers, items in zip(batch.column("_covers").to_pylist(), batch.column("_items").to_pylist(), strict=True):
            total, reach = 0, 0
            for span in sorted(covers, key=lambda s: s["start"]):
                total += max(0, span["stop"] - max(reach, span["start"]))
                reach = max(reach, span["stop"])
            held = sorted(set(items))
            hits.append(total)
            n_items.append(len(held))
            digests.append(hashlib.sha256(",".join(held).encode()).hexdigest())
        keep = [n for n in batch.schema.names if n not in ("_covers", "_items")]
        columns = {name: batch.column(name) for name in keep}
        columns |= {
            "n_hit": pa.array(hits, pa.int64()),
            "n_items": pa.array(n_items, pa.int64()),
            "items_sha256": pa.array(digests, pa.string()),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _is_contaminated(tests: TestSet, window: int, one_in: int):
    """Whether enough words of each text lie inside occurrences."""

    def judge(texts: pa.Array) -> pa.Array:
        verdicts = [np.zeros(0, dtype=bool)]
        for _, _, data, offsets in blocks(texts):
            words = split_words(data, offsets, ALPHANUMERIC)
            hashes = span_hashes(data, words.starts, words.ends)
            places, found = occurrences(hashes, words.first, tests, window)
            steps = np.zeros(len(hashes) + 1, dtype=np.int64)
            np.add.at(steps, places, 1)
            np.add.at(steps, places + tests.lengths[found], -1)
            hit = np.bincount(words.text_of_word()[np.cumsum(steps[:-1]) > 0], minlength=len(words.counts))
            verdicts.append((hit > 0) & (one_in * hit >= words.counts))
        return pa.array(np.concatenate(verdicts))

    return judge


def test_blocks(benchmark: DataFrame, block_chars: int, window: int = WINDOW):
    """The distinct test items, in blocks of about ``block_chars`` characters; how many, and one after the other."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_chars))

    def read():
        for i in range(n):
            rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).collect()
            yield read_test_set([r["item"] for r in rows], [r["text"] for r in rows], window)

    return n, read()


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, block_chars: int) -> DataFrame:
    """The judgement per document, with ``_key`` for its id and text.

    Of several test blocks each leaves the rows with hits in the shared folder before the next is read, so that neither the
    driver nor a plan ever holds more than one.
    """
    n, tests = test_blocks(benchmark, block_chars, window)
    found = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    found = found.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), "text")
    kinds = found.drop("text").schema.simpleString()[len("struct<") : -1]
    lists = "_covers:array<struct<start:bigint,stop:bigint>>,_items:array<string>,_matches:array<" + _MATCH + ">"

    def scan(block: TestSet) -> DataFrame:
        return found.mapInArrow(_scan(block, window), f"{kinds},n_words:bigint,{lists}")

    if n == 1:
        held = scan(next(tests))
    else:
        hits = [written(scan(block).where(F.size("_covers") > 0).select("_key", "_covers", "_items", "_matches"), "hits") for block in tests]
        every = reduce(DataFrame.unionAll, hits).groupBy("_key")
        every = every.agg(*[F.flatten(F.collect_set(c)).alias(c) for c in ("_covers", "_items", "_matches")])
        bare = scan(read_test_set([], [], window)).select("doc_id", "_key", "n_words")
        lists_of = [F.coalesce(every[c], F.array().cast(every.schema[c].dataType)).alias(c) for c in ("_covers", "_items", "_matches")]
        held = bare.join(every, "_key", "left").select("doc_id", "_key", "n_words", *lists_of)
    kinds = held.drop("_covers", "_items").schema.simpleString()[len("struct<") : -1]
    return held.mapInArrow(_verdicts, f"{kinds},n_hit:bigint,n_items:bigint,items_sha256:string")


def _contaminated(one_in: int):
    return (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and matches.

    A null text has no words; a document without words, or against an empty test set, has no hits and
    is clean. Repeated documents are judged one by one. Test rows of the same item_id count as one
    item; a null item_id is written as an empty text. ``matches`` lists longest verbatim matches
    with their places in the document and the item, in words.
    """
    return _judged(docs, benchmark, window, block_chars).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        _contaminated(one_in).alias("contaminated"),
        F.col("_matches").alias("matches"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, one_in: int = ONE_IN, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with.

    Against a test set of one block only the text goes to Python and no document is moved.
    """
    n, tests = test_blocks(benchmark, block_chars, window)
    text = F.col("text").cast("string")
    if n == 1:
        return docs.where(~F.arrow_udf(_is_contaminated(next(tests), window, one_in), "boolean")(text))
    judged = _judged(docs, benchmark, window, block_chars)
    bad = written(judged.where(_contaminated(one_in)).select("_key").distinct(), "contaminated")
    return docs.join(bad, F.xxhash64("doc_id", text) == bad["_key"], "left_anti")


# The same over documents and benchmark, as SQL: every window of every text, joined.
ORACLE = r"""
WITH lowered AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
tested AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS passage
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS places(i) WHERE len(w) > 0),
held AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS passage
  FROM d, (SELECT DISTINCT size FROM tested) AS sizes, unnest(range(1, len(w) - size + 2)) AS places(i)),
hits AS (SELECT r, i, size, item FROM held JOIN tested USING (size, passage)),
words AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, size)) AS steps(k) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
