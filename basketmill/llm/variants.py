"""Spelling variants of words: a variable-length gram index over the words of a corpus.

The gram dictionary holds grams of ``SHORTEST`` to ``LONGEST`` letters, pruned by frequency: a gram that occurs more
often than a list may be long is replaced by its longer continuations. A word is decomposed into one gram per place, the
shortest there that is not too frequent. One edit can touch only the grams over its place; the most that any single place
has is the word's bound. A near word shares all other grams, so the bound and one more of the rarest lists of each
word always contain one that both are in, untouched. Left or right of that gram both words are equal, so its list is
divided by what stands there, and only words inside such a part are compared.

Words begin and end with a mark, so a word of six letters has at least seven grams, of which one edit touches six at most.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import blocks, byte_set, span_hashes, split_words
from basketmill.llm.staging import written

LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is this many times as frequent as its variant.
FORM_TIMES = 5
# One distinct word in so many, by document, loses a letter before counting.
NOISE_ONE_IN = 199
SHORTEST, LONGEST = 2, 6
# Words that a gram may have before it is lengthened, and the bound on how many grams may exceed it.
LIST_LENGTH = 32
MOST_FREQUENT = 1 << 18
_FLUSH = 1 << 19
_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A))
_MARKED = byte_set((1, 1))
# U+00C0 to U+00FF are this byte and one more.
_LATIN = 0xC3


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letter runs of enough code points: text, first byte, byte after the last, code points."""
    lead = data == _LATIN
    inside = _LETTERS[data] | lead
    inside[1:] |= lead[:-1]
    words = split_words(inside.view(np.uint8), offsets, _MARKED)
    leads = np.concatenate([[0], np.cumsum(lead)])
    length = words.ends - words.starts - (leads[words.ends] - leads[words.starts])
    enough = length >= LEAST_LENGTH
    return words.text_of_word()[enough], words.starts[enough], words.ends[enough], length[enough]


def _fresh(*columns: np.ndarray) -> np.ndarray:
    """Places in sorted columns where a new combination begins."""
    change = np.ones(len(columns[0]), dtype=bool)
    change[1:] = False
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def _count_block(counts: Counter, ids: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
    text, starts, ends, _ = _runs(data, offsets)
    hashes = span_hashes(data, starts, ends)
    order = np.lexsort((hashes, text))
    text, starts, ends, hashes = text[order], starts[order], ends[order], hashes[order]
    at = _fresh(text, hashes)
    times = np.diff(np.append(at, len(text)))
    upper = (data >= 0x41) & (data <= 0x5A)
    body = (data + (upper * np.uint8(0x20))).tobytes()
    heads = [crc32(f"{i}:".encode()) for i in ids]
    spans = list(zip(starts[at].tolist(), ends[at].tolist(), strict=True))
    codes = np.array([crc32(body[a:b], heads[t]) for (a, b), t in zip(spans, text[at].tolist(), strict=True)], dtype=np.int64)
    noisy = codes % NOISE_ONE_IN == 0
    for k in np.flatnonzero(noisy):
        run = body[slice(*spans[k])].decode()
        place = int(codes[k]) % len(run)
        if len(run) > LEAST_LENGTH:
            counts[(run[:place] + run[place + 1 :]).encode()] += int(times[k])
    clean = np.flatnonzero(~noisy)
    clean = clean[np.argsort(hashes[at[clean]], kind="stable")]
    own = _fresh(hashes[at[clean]])
    sums = np.add.reduceat(times[clean], own) if len(own) else []
    for k, n in zip(clean[own].tolist(), sums, strict=True):
        counts[body[slice(*spans[k])]] += int(n)


def _counts_batch(counts: Counter, name: str) -> pa.RecordBatch:
    keys = pa.array(list(counts), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([keys, pa.array(list(counts.values()), pa.int64())], [name, "n"])


def _counted(batches):
    counts = Counter()
    for batch in batches:
        ids = batch.column("id").to_pylist()
        for low, high, data, offsets in blocks(batch.column("text")):
            _count_block(counts, ids[low:high], data, offsets)
            if len(counts) >= _FLUSH:
                yield _counts_batch(counts, "word")
                counts = Counter()
    if counts:
        yield _counts_batch(counts, "word")


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words and how often they occur in all texts.

    Words are longest runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. A run whose CRC-32, taken together with
    its document's id, is a multiple of ``NOISE_ONE_IN`` loses one letter. Words of fewer than
    ``LEAST_LENGTH`` code points or ``LEAST_COUNT`` occurrences are left out. A null id is written as an empty text.
    """
    source = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").alias("text"))
    counts = source.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def marked(word: str) -> str:
    return f"^{word}$"


def _gram_counts(batches):
    counts = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            z = marked(word)
            for size in range(SHORTEST, LONGEST + 1):
                counts.update(z[p : p + size] for p in range(len(z) - size + 1))
            if len(counts) >= _FLUSH:
                yield pa.RecordBatch.from_pydict({"gram": list(counts), "n": list(counts.values())})
                counts = Counter()
    if counts:
        yield pa.RecordBatch.from_pydict({"gram": list(counts), "n": list(counts.values())})


def frequent_grams(words: DataFrame, list_length: int = LIST_LENGTH, most: int = MOST_FREQUENT) -> dict[str, int]:
    """Grams that occur too often to be an index entry unless they are of the greatest length, with their counts.

    The limit rises with the number of grams so that no more than ``most`` can exceed it.
    """
    grams = written(words.mapInArrow(_gram_counts, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    frequent = grams.where(F.col("n") > max(list_length, total // most)).toArrow()
    return dict(zip(frequent["gram"].to_pylist(), frequent["n"].to_pylist(), strict=True))


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """One gram per place of the marked word: first letter and the one after the last."""
    z = marked(word)
    found = []
    for start in range(len(z) - SHORTEST + 1):
        end = start + SHORTEST
        while end < len(z) and end - start < LONGEST and z[start:end] in frequent:
            end += 1
        found.append((start, end))
    return found


def affected(grams: list[tuple[int, int]]) -> int:
    """The most grams that one edit can touch."""
    steps = [0] * (grams[-1][1] + 1)
    for start, end in grams:
        steps[start] += 1
        steps[end] -= 1
    most = now = 0
    for step in steps:
        now += step
        most = max(most, now)
    return most


def entries(word: str, frequent: dict[str, int]) -> set[str]:
    """Index entries of a word: its rarest grams, each with all that stands left or right of it."""
    z = marked(word)
    grams = decompose(word, frequent)
    rarest = sorted(grams, key=lambda g: (frequent.get(z[g[0] : g[1]], 0), z[g[0] : g[1]], g[0]))[: affected(grams) + 1]
    return {f"<{z[:end]}" for _, end in rarest} | {f">{end - start}{z[start:]}" for start, end in rarest}


def _indexed(frequent: dict[str, int]):
    def index(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            lists = [list(entries(word, frequent)) for word in words]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.string()))], ["word", "n", "entries"])

    return index


def near_words(words: DataFrame, list_length: int = LIST_LENGTH, most: int = MOST_FREQUENT) -> DataFrame:
    """Pairs (word, n, near, near_n), both ways, of words that one inserted, deleted or replaced letter sets apart.

    ``words`` has distinct words and n. The join's sides come from a stored index, so Spark can split a crowded entry.
    """
    frequent = frequent_grams(words, list_length, most)
    lists = words.select("word", "n").mapInArrow(_indexed(frequent), "word string, n bigint, entries array<string>")
    lists = lists.select("word", "n", F.explode("entries").alias("entry"))
    lists = written(lists.select("word", "n", F.xxhash64("entry").alias("entry"), F.char_length("word").alias("length")), "gram_index")
    other = lists.select("entry", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("length").alias("near_length"))
    close = F.abs(F.col("length") - F.col("near_length")) <= 1
    found = lists.join(other, "entry").where((F.col("word") < F.col("near")) & close)
    found = found.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n").distinct()
    return found.unionAll(found.select("near", "near_n", "word", "n"))


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, twice as far in each turn.

    A form is ``FORM_TIMES`` times as frequent as its variant, so there are no circles.
    """
    now = written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        now = written(further, "roots")
        if not now.agg(F.max("moved")).first()[0]:
            return now.select("word", "root")
        now = now.select("word", "root")


def variant_groups(words: DataFrame, list_length: int = LIST_LENGTH, most: int = MOST_FREQUENT) -> DataFrame:
    """Per word: word, form, root, n, n_near and form_n.

    The form is the most frequent near word (ties: the smallest) if it is ``FORM_TIMES`` times as frequent. ``words`` has
    distinct words and n, as from ``word_counts``; other columns are not read. No words give an empty result.
    """
    words = written(words.select("word", "n").where("word IS NOT NULL"), "words")
    near = near_words(words, list_length, most).groupBy("word", "n")
    best = near.agg(
        F.count("near").alias("n_near"), F.min_by("near", F.struct(-F.col("near_n"), "near")).alias("form"), F.max("near_n").alias("form_n")
    )
    enough = F.col("form_n") >= FORM_TIMES * F.col("n")
    best = best.select("word", "n_near", F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    best = written(best, "forms")
    joined = words.join(best, "word", "left").join(_roots(best.where("form IS NOT NULL")), "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Variants among the words of all texts of ``docs``, as ``variant_groups`` returns them.

    Null and empty texts have no words; very long texts and very long words are taken whole. Repeated rows count each.
    An empty table gives an empty result. Columns other than ``key`` and ``text`` are not read, whatever their names.
    """
    return variant_groups(word_counts(docs, key, text))
