"""Toxicity: boosted trees over dense features of a text, calibrated by isotonic regression.

A lexicon is learned from labels: whole words and word beginnings, each with the shrunken log odds of
toxicity of the texts that hold it. A text is described by how dense its lexicon words are, how close they
stand to second-person words, and by its capitals, punctuation and obfuscation. Counts are kept by fold, so that
a learning text is described by a lexicon that has not seen it. The trees are Spark's; their scores
outside their own fold set the calibration. At most ``train_rows`` labelled texts are learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import ALPHANUMERIC, Words, _VALUES, blocks, byte_set, id_and_text, span_hashes, split_words
from basketmill.llm.staging import written

TRAIN_ROWS = 16_000
# Files of the bounded sample, so that several tasks read it.
SAMPLE_PARTS = 16
MAX_LEXICON = 20_000
FOLDS = 4
LEAST_TEXTS, LEAST_WEIGHT, STRONG = 2, 0.7, 2.2
PRIOR = 4.0
NEAR = 5
PREFIXES = (4, 5, 6, 8)
THRESHOLD = 0.3
TREES, DEPTH, STEP = 24, 3, 0.2
# The part of a score that keeps the order among texts of the same calibrated value.
ORDER_PART = 0.01
SEED = 11

# Words of the second person in four languages.
SECOND_PERSON = (
    "you your yours yourself yourselves du dich dir dein deine deinen deinem deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros vuestro vuestra os"
).split()
# Signs that stand in for letters.
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_UPPER, _LOWER, _DIGIT = byte_set((0x41, 0x5A)), byte_set((0x61, 0x7A)), byte_set((0x30, 0x39))
_MARKS = byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_DISGUISED = ALPHANUMERIC.copy()
_DISGUISED[[ord(c) for c in STAND_INS]] = True
_READ_AS = _VALUES.copy()
for _sign, _letter in STAND_INS.items():
    _READ_AS[ord(_sign)] = _VALUES[ord(_letter)]

FEATURE_NAMES = (
    "strong_words", "strong_density", "weight_density", "top_weight", "strong_starts", "start_density", "start_weight_density", "top_start",
    "near_second_person", "second_person", "capitals", "shouted_words", "punctuation", "exclamations", "odd_signs", "mixed_words", "disguised",
    "log_words", "distinct_strong",
)


@dataclass
class Lexicon:
    """Sorted hashes with a column of weights per fold left out, and a last one for none."""

    hashes: np.ndarray
    weights: np.ndarray

    def look_up(self, hashes: np.ndarray, column: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.weights[at, column], 0.0)


def _starts(data: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words longer than ``size`` bytes, and hashes of their beginnings."""
    long = np.flatnonzero(words.ends - words.starts > size)
    salt = np.uint64(size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return long, span_hashes(data, words.starts[long], words.starts[long] + size) + salt


def _entries(data: np.ndarray, words: Words, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all words and beginnings."""
    hashes, texts = [span_hashes(data, words.starts, words.ends)], [text]
    for size in PREFIXES:
        long, own = _starts(data, words, size)
        hashes.append(own)
        texts.append(text[long])
    return np.concatenate(texts), np.concatenate(hashes)


def _second_person() -> np.ndarray:
    data = np.frombuffer(" ".join(SECOND_PERSON).encode(), dtype=np.uint8)
    words = split_words(data, np.array([0, len(data)]), ALPHANUMERIC)
    return np.unique(span_hashes(data, words.starts, words.ends))


def describe(data: np.ndarray, offsets: np.ndarray, folds: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """A row of features per text. ``folds`` names the lexicon column to use for each."""
    rows = len(offsets) - 1
    words = split_words(data, offsets, ALPHANUMERIC)
    text = words.text_of_word()
    n = np.maximum(words.counts, 1)
    hashes = span_hashes(data, words.starts, words.ends)
    column = folds[text]
    weight = lexicon.look_up(hashes, column)
    start = np.zeros(len(hashes))
    for size in PREFIXES:
        long, own = _starts(data, words, size)
        start[long] = np.maximum(start[long], lexicon.look_up(own, column[long]))

    def total(values):
        return np.bincount(text, weights=values, minlength=rows)

    def top(values):
        best = np.zeros(rows)
        np.maximum.at(best, text, values)
        return best

    strong, strong_start = weight >= STRONG, start >= STRONG
    hot = strong | strong_start
    known = _second_person()
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    person = known[at] == hashes
    sums = np.concatenate([[0], np.cumsum(person)])
    place = np.arange(len(hashes))
    first, stop = words.first[text], words.first[text + 1]
    near = sums[np.minimum(place + NEAR + 1, stop)] - sums[np.maximum(place - NEAR, first)] > 0

    def in_bytes(table):
        return np.concatenate([[0], np.cumsum(table[data])])

    upper, lower, digit, mark = map(in_bytes, (_UPPER, _LOWER, _DIGIT, _MARKS))
    loud, odd = in_bytes(byte_set((0x21, 0x21))), in_bytes(byte_set((0x23, 0x26), (0x2A, 0x2A), (0x40, 0x40)))
    of_text = lambda sums: np.diff(sums[offsets])
    of_word = lambda sums: sums[words.ends] - sums[words.starts]
    size = np.maximum(np.diff(offsets), 1)
    shouted = (of_word(upper) >= 2) & (of_word(lower) == 0)
    mixed = (of_word(digit) > 0) & (of_word(upper) + of_word(lower) > 0) & (words.ends - words.starts < 20)
    hidden = split_words(data, offsets, _DISGUISED)
    hidden_text = hidden.text_of_word()
    veiled = lexicon.look_up(span_hashes(data, hidden.starts, hidden.ends, _READ_AS), folds[hidden_text]) >= STRONG
    veiled &= lexicon.look_up(span_hashes(data, hidden.starts, hidden.ends), folds[hidden_text]) < STRONG
    pairs = np.unique(np.column_stack([text[hot], hashes[hot].view(np.int64)]), axis=0)[:, 0]
    columns = [
        np.log1p(total(strong)), total(strong) / n, total(weight) / n, top(weight),
        np.log1p(total(strong_start)), total(strong_start) / n, total(start) / n, top(start),
        total(hot & near) / n, total(person) / n, of_text(upper) / np.maximum(of_text(upper) + of_text(lower), 1), total(shouted) / n,
        of_text(mark) / size, of_text(loud) / size, of_text(odd) / size, total(mixed) / n,
        np.log1p(np.bincount(hidden_text, weights=veiled, minlength=rows)), np.log1p(words.counts), np.log1p(np.bincount(pairs, minlength=rows)),
    ]
    return np.column_stack(columns)


def _tally(batches):
    """(hash, fold, toxic texts, texts) for the distinct entries of every text."""
    for batch in batches:
        folds = np.asarray(batch.column("fold").to_pylist(), dtype=np.int64)
        toxic = np.asarray(batch.column("toxic").to_pylist(), dtype=np.int64)
        for low, high, data, offsets in blocks(batch.column("text")):
            words = split_words(data, offsets, ALPHANUMERIC)
            text, hashes = _entries(data, words, words.text_of_word())
            pairs = np.unique(np.column_stack([hashes.view(np.int64), text]), axis=0)
            fold, own = folds[low:high][pairs[:, 1]], toxic[low:high][pairs[:, 1]]
            groups, which = np.unique(np.column_stack([pairs[:, 0], fold]), axis=0, return_inverse=True)
            which = which.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(groups[:, 0], pa.int64()),
                    pa.array(groups[:, 1], pa.int64()),
                    pa.array(np.bincount(which, weights=own, minlength=len(groups)).astype(np.int64), pa.int64()),
                    pa.array(np.bincount(which, minlength=len(groups)), pa.int64()),
                ],
                ["hash", "fold", "toxic", "texts"],
            )


def learn_lexicon(sample: DataFrame, sizes: dict[int, tuple[int, int]]) -> Lexicon:
    """At most MAX_LEXICON entries; ``sizes`` has (toxic texts, texts) by fold."""
    counts = sample.select("text", "toxic", "fold").mapInArrow(_tally, "hash bigint, fold bigint, toxic bigint, texts bigint")
    sums = [F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for f in range(FOLDS) for c in ("toxic", "texts")]
    whole = counts.groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("texts").alias("texts"), *sums)
    rate = (sum(t for t, _ in sizes.values()) + 0.5) / (sum(n for _, n in sizes.values()) + 1)
    odds = (F.col("toxic") + PRIOR * rate) / (F.col("texts") - F.col("toxic") + PRIOR * (1 - rate))
    score = F.log(odds) - float(np.log(rate / (1 - rate)))
    best = whole.where((F.col("toxic") >= LEAST_TEXTS) & (score >= LEAST_WEIGHT)).orderBy(F.desc(score), "hash").limit(MAX_LEXICON).collect()
    best.sort(key=lambda r: r["hash"] & 0xFFFFFFFFFFFFFFFF)
    weights = np.zeros((len(best), FOLDS + 1))
    for f in range(FOLDS + 1):
        toxic = np.array([r["toxic"] - (r[f"toxic{f}"] if f < FOLDS else 0) for r in best], dtype=float)
        texts = np.array([r["texts"] - (r[f"texts{f}"] if f < FOLDS else 0) for r in best], dtype=float)
        odds = (toxic + PRIOR * rate) / (texts - toxic + PRIOR * (1 - rate))
        weights[:, f] = np.maximum(0, np.log(odds) - np.log(rate / (1 - rate)))
    return Lexicon(np.array([r["hash"] & 0xFFFFFFFFFFFFFFFF for r in best], dtype=np.uint64), weights)


def _described(lexicon: Lexicon, names: list[str]):
    def run(batches):
        for batch in batches:
            if "fold" in batch.schema.names:
                folds = np.asarray(batch.column("fold").to_pylist(), dtype=np.int64)
            else:
                folds = np.full(batch.num_rows, FOLDS)
            parts = [describe(d, o, folds[low:high], lexicon) for low, high, d, o in blocks(batch.column("text"), most_rows=4000)]
            table = np.concatenate(parts) if parts else np.zeros((0, len(FEATURE_NAMES)))
            column = pa.ListArray.from_arrays(
                np.arange(0, table.size + 1, table.shape[1], dtype=np.int32), pa.array(table.reshape(-1), pa.float64())
            )
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), column], [*names, "features"])

    return run


def held_out(key: str = "doc_id") -> Column:
    """A fourth of the documents by a checksum of the id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    lexicon: Lexicon
    trees: object
    calibration: object

    def scores(self, described: DataFrame) -> DataFrame:
        """Adds ``score`` to rows with ``features``."""
        scored = self.trees.transform(described.withColumn("features", array_to_vector("features")))
        scored = scored.withColumn("_raw_score", vector_to_array("probability")[1])
        scored = self.calibration.transform(scored)
        score = (1 - ORDER_PART) * F.least(F.greatest("prediction_iso", F.lit(0.0)), F.lit(1.0)) + ORDER_PART * F.col("_raw_score")
        return scored.withColumn("score", score)


def _boost() -> GBTClassifier:
    return GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, subsamplingRate=0.8, seed=SEED, maxBins=64)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | float:
    """Learn from the labelled of the given documents; the plain rate of toxic rows where one class is missing."""
    marks = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", (F.col("toxic") > 0).cast("double").alias("toxic"))
    marks = marks.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # At most train_rows rows of two numbers: small enough to send to every task.
    chosen = written(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "toxic_labels")
    texts = id_and_text(docs).where(~held_out()).join(F.broadcast(chosen), "doc_id")
    fold = F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(FOLDS)).cast("bigint").alias("fold")
    sample = texts.select("doc_id", "text", "toxic", fold).orderBy(F.xxhash64("doc_id", "text")).limit(train_rows)
    sample = written(sample.repartition(SAMPLE_PARTS), "toxic_sample")
    sizes = {r["fold"]: (int(r["t"]), r["n"]) for r in sample.groupBy("fold").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()}
    toxic, rows = sum(t for t, _ in sizes.values()), sum(n for _, n in sizes.values())
    if not toxic or toxic == rows:
        return toxic / rows if rows else 0.0
    lexicon = learn_lexicon(sample, sizes)
    described = sample.mapInArrow(_described(lexicon, ["fold", "toxic"]), "fold bigint, toxic double, features array<double>")
    described = written(described, "toxic_features").withColumn("features", array_to_vector("features")).coalesce(4)
    out = []
    for half in (0, 1):
        inside = described.where(F.col("fold") % 2 == half)
        if len({r[0] for r in inside.select("toxic").distinct().collect()}) == 2:
            trees = _boost().fit(inside)
            out.append(trees.transform(described.where(F.col("fold") % 2 != half)).select("toxic", vector_to_array("probability")[1].alias("_raw_score")))
    trees = _boost().fit(described)
    if not out:
        out = [trees.transform(described).select("toxic", vector_to_array("probability")[1].alias("_raw_score"))]
    outside = written(out[0] if len(out) == 1 else out[0].unionAll(out[1]), "toxic_outside")
    calibration = IsotonicRegression(featuresCol="_raw_score", labelCol="toxic", predictionCol="prediction_iso").fit(outside)
    return Model(lexicon, trees, calibration)


def score_toxicity(docs: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted.

    Only the text counts; null counts as empty, and an empty text has a score like any other. Repeated
    documents have a row each. Where only one class was there to learn from, the score is its plain rate.
    """
    source = id_and_text(docs)
    if isinstance(model, float):
        scored = source.withColumn("score", F.lit(model))
    else:
        kind = source.schema["doc_id"].dataType.simpleString()
        described = source.mapInArrow(_described(model.lexicon, ["doc_id"]), f"doc_id {kind}, features array<double>")
        scored = model.scores(described)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
