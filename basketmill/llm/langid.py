"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are read as lower-case letters with one gap between words; grams of one to three are hashed to a
fixed number of features. Document frequencies cover every document learned from. The weights are fit by
the follow-the-regularised-leader rule with elastic-net penalties on a bounded sample of about
``train_docs`` documents, dealt evenly to the languages; a fifth of the sample sets the temperature.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import blocks, id_and_text, mix

FEATURES = 1 << 13
TRAIN_DOCS = 3000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01
UNDECIDED = "und"
# Bytes and texts counted at a time.
_BYTES, _ROWS = 1 << 19, 128


@cache
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for everything else."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        sign = chr(code)
        if sign.isalpha():
            low = sign.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def gram_counts(data: np.ndarray, offsets: np.ndarray, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed grams, a row per text, and whether the text has a letter."""
    rows = len(offsets) - 1
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    signs = _letters()[codes]
    text = np.repeat(np.arange(rows, dtype=np.int64), np.diff(heads))
    letter = signs > 0
    has = np.bincount(text[letter], minlength=rows) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    signs, text = signs[keep].astype(np.uint64), text[keep]
    counts = np.zeros(rows * features, dtype=np.int64)
    shift = np.uint64(64 - features.bit_length() + 1)
    value = np.zeros(len(signs), dtype=np.uint64)
    for size in (1, 2, 3):
        n = len(signs) - size + 1
        if n <= 0:
            break
        value = value[:n] * np.uint64(0x110001) + signs[size - 1 :] + np.uint64(1)
        same = text[:n] == text[size - 1 :]
        if size == 1:
            same &= signs > 0
        bucket = (mix(value + np.uint64(size)) >> shift).astype(np.int64)
        counts += np.bincount((text[:n] * features + bucket)[same], minlength=rows * features)
    return counts.reshape(rows, features), has


def _tables(batch) -> tuple[int, int, np.ndarray, np.ndarray]:
    for low, high, data, offsets in blocks(batch.column("text"), _BYTES, _ROWS):
        yield low, high, *gram_counts(data, offsets)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one."""
    rows = np.log1p(counts.astype(np.float32)) * idf
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-9)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def posteriors(self, counts: np.ndarray) -> np.ndarray:
        return softmax((weighted(counts, self.idf) @ self.weights + self.bias) / self.temperature)


def softmax(scores: np.ndarray) -> np.ndarray:
    parts = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return parts / parts.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], classes: np.ndarray, n_classes: int, width: int) -> np.ndarray:
    """Weights, the last row being the bias, by per-coordinate FTRL with elastic-net penalties."""
    z, n = np.zeros((width + 1, n_classes)), np.zeros((width + 1, n_classes))

    def solved(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at = np.append(rows[i][0].astype(np.int64), width)
            x = np.append(rows[i][1], 1.0)[:, None]
            w = solved(z[at], n[at])
            error = softmax((x * w).sum(axis=0))
            error[classes[i]] -= 1
            slope = x * error
            squares = slope * slope
            z[at] += slope - (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / ALPHA * w
            n[at] += squares
    return solved(z, n)


def best_temperature(scores: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm.

    Targets are smoothed, as if one more row of each class had been seen, so that a sample without an error
    does not ask for certainty.
    """
    n, k = scores.shape
    target = np.full((n, k), 1 / (n + k))
    target[np.arange(n), classes] += n / (n + k)

    def loss(log_t):
        return -(target * np.log(np.maximum(softmax(scores / np.exp(log_t)), 1e-300))).sum(axis=1).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(key: str = "doc_id") -> Column:
    """A fourth of the documents by a checksum of the id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def _frequencies(batches):
    total = np.zeros(FEATURES, dtype=np.int64)
    for batch in batches:
        for _, _, counts, _ in _tables(batch):
            total += (counts > 0).sum(axis=0)
    yield pa.RecordBatch.from_pydict({"feature": pa.array(np.arange(FEATURES), pa.int32()), "docs": pa.array(total, pa.int64())})


def _sparse(batches):
    for batch in batches:
        cells = []
        for _, _, counts, _ in _tables(batch):
            for row in counts:
                at = np.flatnonzero(row)
                cells.append((at.astype(np.uint16).tobytes(), row[at].astype(np.uint32).tobytes()))
        yield pa.RecordBatch.from_pydict(
            {
                "lang": batch.column("lang"),
                "place": batch.column("place"),
                "at": pa.array([c[0] for c in cells], pa.binary()),
                "n": pa.array([c[1] for c in cells], pa.binary()),
            }
        )


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """Learn from the text and lang of all given documents; none without a labelled text.

    The sample takes equally many documents of each language, together about a tenth more than ``train_docs`` and never more than
    twice as many. It holds each language at least once, so no more than ``train_docs`` languages, the most frequent, are learned.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(train_docs).collect()
    if not sizes:
        return None
    total = sum(r["count"] for r in sizes)
    table = known.select("text").mapInArrow(_frequencies, "feature int, docs bigint")
    frequency = np.ones(FEATURES)
    for row in table.groupBy("feature").agg(F.sum("docs").alias("docs")).collect():
        frequency[row.feature] += row.docs
    idf = np.log((1 + total) / frequency).astype(np.float32) + np.float32(0.1)
    share = -(-train_docs // len(sizes))
    rate = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, 1.1 * share / r["count"]))])
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.withColumn("place", place).where(F.col("place") < F.try_element_at(rate, F.col("lang")))
    cells = chosen.select("lang", "place", "text").mapInArrow(_sparse, "lang string, place double, at binary, n binary")
    sample = cells.orderBy("place", "lang", F.xxhash64("at", "n")).limit(2 * train_docs).select("lang", "at", "n").toArrow()
    languages = sorted(r["lang"] for r in sizes)
    classes = np.array([languages.index(lang) for lang in sample["lang"].to_pylist()])
    rows = []
    for at, n in zip(sample["at"], sample["n"], strict=True):
        at = np.frombuffer(at.as_buffer(), dtype=np.uint16)
        x = np.log1p(np.frombuffer(n.as_buffer(), dtype=np.uint32), dtype=np.float32) * idf[at]
        rows.append((at, x / max(np.sqrt((x * x).sum()), 1e-9)))
    apart = np.arange(len(rows)) % 5 == 0 if len(rows) >= 50 else np.zeros(len(rows), dtype=bool)
    learned = follow_the_leader([r for r, a in zip(rows, apart, strict=True) if not a], classes[~apart], len(languages), FEATURES)
    model = Model(languages, idf, learned[:-1].astype(np.float32), learned[-1].astype(np.float32))
    if apart.any() and len(languages) > 1:
        scores = np.array([rows[i][1] @ learned[rows[i][0]] + learned[-1] for i in np.flatnonzero(apart)])
        model.temperature = best_temperature(scores, classes[apart])
    return model


def _guesses(model: Model | None, batch) -> tuple[list[str], list[float]]:
    """Language and score of each text of a batch."""
    langs, scores = [], []
    for low, high, counts, has in _tables(batch):
        if model is None:
            langs += [UNDECIDED] * (high - low)
            scores += [0.0] * (high - low)
            continue
        p = model.posteriors(counts).astype(np.float64)
        best = p.argmax(axis=1)
        langs += [model.languages[b] if h else UNDECIDED for b, h in zip(best, has, strict=True)]
        scores += [min(1.0, float(p[i, b])) if has[i] else 0.0 for i, b in enumerate(best)]
    return langs, scores


def _predicted(model: Model | None):
    def predict(batches):
        for batch in batches:
            langs, scores = _guesses(model, batch)
            columns = {"doc_id": batch.column("doc_id"), "_lang_pred": pa.array(langs, pa.string()), "_score": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    return predict


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score.

    A null text, or one without a letter, is ``und`` with score 0, as is everything if there was nothing
    to learn from. Repeated documents have a row each; only the text counts.
    """
    source = id_and_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(_predicted(model), f"doc_id {kind}, _lang_pred string, _score double")
    return found.select("doc_id", held_out().alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))


def with_language(docs: DataFrame, model: Model | None, least_score: float = 0.0) -> DataFrame:
    """The documents whose language is known with at least ``least_score``, with the columns they came with."""

    def score(texts: pa.Array) -> pa.Array:
        langs, scores = _guesses(model, pa.RecordBatch.from_arrays([texts], ["text"]))
        return pa.array([None if lang == UNDECIDED else s for lang, s in zip(langs, scores, strict=True)], pa.float64())

    # Only the text goes to Python; an unknown language has no score and drops out.
    plain = docs.withColumn("text", F.col("text").cast("string"))
    return plain.where(F.arrow_udf(score, "double")("text") >= least_score)
