"""Scoring documents by a gated recurrent language model and by smoothed word frequencies.

Word counts of the training documents are summed by a 64-bit hash of the word. The most frequent words, as
many as fit a stated bound, travel to the tasks as a sorted table; rarer words of a document are joined
with the counts by hash, and being rare they cannot crowd a key. The recurrent model knows the most frequent
few thousand words; the others form one class, inside which their smoothed counts decide.

It learns from every training document once: the documents are dealt over the rounds by a hash of id and text,
and stored as word numbers. Each round, tasks train copies on their own documents and the copies are averaged by
Spark, each by the tokens it has seen.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm import gru
from basketmill.llm.arrays import SPACED, blocks, id_and_text, span_hashes, split_words
from basketmill.llm.staging import written

SMOOTHING = 0.1
SENT_WORDS = 1 << 17
SHAPE = gru.Shape(members=32, classes=64)
TRAIN_ONE_IN = 1
ROUNDS = 4
SHARD_TOKENS = 2_000_000
# About as many steps are taken over a shard, on at most so many lanes.
SHARD_STEPS, LANES = 200, 512
END = np.uint64(0x454E44)
_FLUSH_WORDS = 1 << 20


def held_out(key: str = "doc_id") -> Column:
    """A tenth of the documents by a checksum of the id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 10 == 0, F.lit(False))


def tokens(column: pa.Array):
    """Blocks of texts: first row, hashed tokens and the border of each text. Every text ends with END."""
    for low, _, data, offsets in blocks(column):
        words = split_words(data, offsets, SPACED)
        hashes = span_hashes(data, words.starts, words.ends)
        first = words.first + np.arange(len(words.first))
        everything = np.full(first[-1], END, dtype=np.uint64)
        everything[np.arange(len(hashes)) + words.text_of_word()] = hashes
        yield low, everything, first


def _counted(batches):
    """Distinct tokens with counts, summed in the task as far as memory goes."""

    def out(parts):
        hashes = np.concatenate([p[0] for p in parts])
        found, which = np.unique(hashes, return_inverse=True)
        sums = np.bincount(which.reshape(-1), weights=np.concatenate([p[1] for p in parts]), minlength=len(found)).astype(np.int64)
        return found, sums

    parts, held = [], 0
    for batch in batches:
        for _, hashes, _ in tokens(batch.column("text")):
            parts.append(np.unique(hashes, return_counts=True))
            held += len(parts[-1][0])
            if held > 4 * _FLUSH_WORDS:
                parts = [out(parts)]
                held = len(parts[0][0])
                if held > _FLUSH_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(parts[0][0].view(np.int64)), pa.array(parts[0][1])], ["word", "n"])
                    parts, held = [], 0
    if parts:
        found, sums = out(parts)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(sums)], ["word", "n"])


@dataclass
class Frequencies:
    """Tokens and distinct tokens of the training texts, and the sorted table of the most frequent."""

    tokens: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    ranks: np.ndarray
    other_tokens: int
    other_distinct: int

    @cached_property
    def _begins(self) -> tuple[int, np.ndarray, np.ndarray]:
        """By the first bits of a hash, the first word that has them or more; the words, with one more at their end."""
        shift = 63 - len(self.words).bit_length()
        low = np.arange(1 << (64 - shift), dtype=np.uint64) << np.uint64(shift)
        return shift, np.searchsorted(self.words, low), np.append(self.words, np.uint64(2**64 - 1))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the table, -1 for words that are not in it."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        shift, begins, words = self._begins
        at = begins.take((hashes >> np.uint64(shift)).view(np.int64))
        behind = np.flatnonzero(words.take(at) < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[words.take(at.take(behind)) < hashes.take(behind)]
        return np.where((words.take(at) == hashes) & (at < len(self.words)), at, -1)

    def ids(self, places: np.ndarray) -> np.ndarray:
        """Ids for the recurrent model."""
        return np.where(places < 0, SHAPE.words, self.ranks[places]) if len(self.words) else np.full(len(places), SHAPE.words)


def frequencies(counts: DataFrame, sent_words: int = SENT_WORDS) -> Frequencies:
    """``counts`` has word and n. Words are sent down to the least count of which no more than ``sent_words`` exist."""
    total = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("words")).first()
    # One row per power step of the counts, some hundreds: enough to find the cut.
    step = F.floor(F.log2(F.col("n").cast("double")) * 64).cast("long")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    sent, least = 0, None
    for row in sizes:
        sent += row["words"]
        if sent > sent_words:
            break
        least = row["least"]
    rows = counts.where(F.col("n") >= least).toArrow() if least is not None else None
    words = rows["word"].to_numpy().astype(np.int64).view(np.uint64) if rows else np.zeros(0, dtype=np.uint64)
    n = rows["n"].to_numpy() if rows else np.zeros(0, dtype=np.int64)
    order = np.lexsort((words, -n))
    ranks = np.empty(len(words), dtype=np.int64)
    ranks[order] = np.minimum(np.arange(len(words)), SHAPE.words)
    known = int(n[order[: SHAPE.words]].sum())
    by_hash = np.argsort(words)
    tokens, distinct = int(total["tokens"] or 0), int(total["words"])
    return Frequencies(
        tokens, distinct, words[by_hash], n[by_hash], ranks[by_hash], tokens - known, distinct - min(SHAPE.words, len(words))
    )


def _numbered(table: Frequencies):
    """Texts as the model's word numbers, two bytes each."""

    def number(batches):
        for batch in batches:
            ids = []
            for _, hashes, first in tokens(batch.column("text")):
                numbers = table.ids(table.places(hashes)).astype(np.uint16)
                ids += [numbers[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("round"), pa.array(ids, pa.binary())], ["round", "ids"])

    return number


def _trained(flat: np.ndarray, shard_tokens: int):
    """A copy trained on all texts of the task, one run of bounded size after the other."""

    def train(batches):
        def after(texts, held):
            lanes = min(max(held // (16 * SHARD_STEPS), 32), LANES)
            return gru.train_windows(own, SHAPE, texts, lanes=lanes)

        own, texts, held, size = flat, [], 0, 0
        for batch in batches:
            for ids in batch.column("ids"):
                texts.append(np.frombuffer(ids.as_buffer(), dtype=np.uint16))
                held += len(texts[-1])
                if held >= 2 * shard_tokens:
                    own, texts, held, size = after(texts, held), [], 0, size + held
        if held:
            own, size = after(texts, held), size + held
        if size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(own)), pa.int64()), pa.array(own.astype(np.float64) * size), pa.array(np.full(len(own), size), pa.int64())],
                ["place", "value", "weight"],
            )

    return train


def learn(train_docs: DataFrame, table: Frequencies, one_in: int = TRAIN_ONE_IN, rounds: int = ROUNDS) -> np.ndarray:
    """The parameters after averaging copies over ``rounds`` parts of the documents, or of one in ``one_in`` of them."""
    by_rank = np.zeros(SHAPE.words)
    known = table.ranks < SHAPE.words
    by_rank[table.ranks[known]] = table.counts[known]
    flat = gru.start(SHAPE, by_rank, float(table.other_tokens))
    place = F.pmod(F.xxhash64(F.lit("lm"), "doc_id", "text"), F.lit(one_in * rounds))
    chosen = train_docs.select("text", place.alias("round")).where(F.col("round") < rounds)
    chosen = written(chosen.mapInArrow(_numbered(table), "round bigint, ids binary"), "lm_sample")
    shards = max(1, round(table.tokens / one_in / rounds / SHARD_TOKENS))
    for turn in range(rounds):
        part = chosen.where(F.col("round") == turn).select("ids").repartition(shards)
        sums = part.mapInArrow(_trained(flat, SHARD_TOKENS), "place bigint, value double, weight bigint").groupBy("place")
        found = sums.agg((F.sum("value") / F.sum("weight")).alias("value")).toArrow()
        if found.num_rows:
            flat = np.empty_like(flat)
            flat[found["place"].to_numpy()] = found["value"].to_numpy()
    return flat


def _scored(flat: np.ndarray, table: Frequencies):
    """Per text: what the sent table and the model say, and its distinct rarer words with counts."""
    smooth = np.log10(table.counts + SMOOTHING)
    inside = table.ranks < SHAPE.words

    def score(batches):
        for batch in batches:
            texts, n_tokens, n_known, base, other, n_other, rare, rare_n = [], [], [], [], [], [], [], []
            for _, hashes, first in tokens(batch.column("text")):
                places = table.places(hashes)
                ids = table.ids(places)
                texts += [ids[a:b].astype(np.int32) for a, b in zip(first[:-1], first[1:], strict=True)]
                text = np.repeat(np.arange(len(first) - 1), np.diff(first))
                sent = places >= 0
                rows = len(first) - 1
                value = np.where(sent, smooth[places], 0.0) if len(smooth) else np.zeros(len(hashes))
                outside = ids == SHAPE.words
                n_tokens += np.diff(first).tolist()
                n_known += np.bincount(text[sent], minlength=rows).tolist()
                base += np.bincount(text, weights=value, minlength=rows).tolist()
                other += np.bincount(text[outside], weights=value[outside], minlength=rows).tolist()
                n_other += np.bincount(text[outside], minlength=rows).tolist()
                order = np.lexsort((hashes[~sent], text[~sent]))
                t, w = text[~sent][order], hashes[~sent][order]
                fresh = np.ones(len(t), dtype=bool)
                fresh[1:] = (t[1:] != t[:-1]) | (w[1:] != w[:-1])
                at = np.flatnonzero(fresh)
                times = np.diff(np.append(at, len(t)))
                borders = np.searchsorted(t[at], np.arange(rows + 1))
                words = w[at].view(np.int64)
                rare += [words[a:b] for a, b in zip(borders[:-1], borders[1:], strict=True)]
                rare_n += [times[a:b] for a, b in zip(borders[:-1], borders[1:], strict=True)]
            model = gru.score_texts(flat, SHAPE, texts)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "row": batch.column("row"),
                    "n_tokens": pa.array(n_tokens, pa.int64()),
                    "n_sent": pa.array(n_known, pa.int64()),
                    "base_sent": pa.array(base, pa.float64()),
                    "other_sent": pa.array(other, pa.float64()),
                    "n_other": pa.array(n_other, pa.int64()),
                    "model": pa.array(model, pa.float64()),
                    "rare": pa.array(rare, pa.list_(pa.int64())),
                    "rare_n": pa.array(rare_n, pa.list_(pa.int64())),
                }
            )

    return score


def score_documents(docs: DataFrame, one_in: int = TRAIN_ONE_IN, rounds: int = ROUNDS, sent_words: int = SENT_WORDS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    A null text counts as empty: its one token is the end. Scores are log10 probabilities of whole texts.
    Repeated documents count and are scored one by one. With nothing to learn from, every word is unknown.
    """
    source = id_and_text(docs)
    training = source.where(~held_out())
    counts = training.select("text").mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts, "word_counts")
    table = frequencies(counts, sent_words)
    flat = learn(training, table, one_in, rounds)
    kind = source.schema["doc_id"].dataType.simpleString()
    columns = "row bigint, n_tokens bigint, n_sent bigint, base_sent double, other_sent double, n_other bigint, model double"
    numbered = source.withColumn("row", F.monotonically_increasing_id())
    scored = numbered.mapInArrow(_scored(flat, table), f"doc_id {kind}, {columns}, rare array<bigint>, rare_n array<bigint>")
    scored = written(scored, "lm_scores")  # row numbers hold from here on
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("pair")).select("row", "pair.rare", "pair.rare_n")
    known = counts.select(F.col("word").alias("rare"), "n")
    found = pairs.join(known, "rare").groupBy("row")
    found = found.agg(F.sum("rare_n").alias("found"), F.sum(F.col("rare_n") * F.log10(F.col("n") + SMOOTHING)).alias("value"))
    joined = scored.drop("rare", "rare_n").join(found, "row", "left")
    n_found, value = F.coalesce("found", F.lit(0)), F.coalesce("value", F.lit(0.0))
    n_unknown = F.col("n_tokens") - F.col("n_sent") - n_found
    rare = value + n_unknown * float(np.log10(SMOOTHING))
    base_total = float(np.log10(table.tokens + SMOOTHING * (table.distinct + 1)))
    other_total = float(np.log10(table.other_tokens + SMOOTHING * (table.other_distinct + 1)))
    return joined.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_sent") + n_found).alias("n_known"),
        F.lit(table.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_sent") + rare - F.col("n_tokens") * base_total).alias("base_score"),
        (F.col("model") + F.col("other_sent") + rare - F.col("n_other") * other_total).alias("score"),
    )
