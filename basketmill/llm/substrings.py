"""Passages that several documents share: Rabin-Karp windows, counted in Spark, merged into removals.

Every run of ``WINDOW`` words gets a rolling hash. A task sorts the hashes of a bounded block of texts: of equal
windows only the one of the smallest document is sent on, the others are already known to go. What is sent is dealt
into buckets of hash ranges, so a window that a third of all documents hold reaches its bucket once per block, not once
per document. A bucket holds all that was sent of its windows and finds for each the smallest document. Hashes of
windows to remove then meet their document's text, where they become maximal intervals of words.

Windows are compared by 64-bit hashes; two different ones collide with probability 5e-20.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import SPACED, Words, blocks, mix, span_hashes, split_words

WINDOW = 50
# Windows that a task sorts together.
BLOCK_WINDOWS = 1 << 20
# Bytes of text whose windows make one bucket.
BUCKET_BYTES = 1 << 20
_BASE = 0xD6E8FEB86659FD93
# A value per byte; letters of different case differ.
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_DIFFERENCES = (np.uint8, np.uint16, np.uint32, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


def window_hashes(hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of all runs of ``size`` words inside one text, and the place of each one's first word."""
    last = len(hashes) - size + 1
    if last <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers(_BASE, len(hashes)), out=sums[1:])
    text = words.text_of_word()
    starts = np.flatnonzero(text[:last] == text[size - 1 :])
    inverse = _powers(pow(_BASE, -1, 1 << 64), last)
    return mix((sums[starts + size] - sums[starts]) * inverse[starts]), starts


def _text_windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[Words, np.ndarray, np.ndarray]:
    words = split_words(data, offsets, SPACED)
    return words, *window_hashes(span_hashes(data, words.starts, words.ends, _VALUES), words, size)


def _packed(ids: np.ndarray) -> bytes:
    """Ascending integers as the first, then differences of one, two, four or eight bytes."""
    steps = np.diff(ids).view(np.uint64) if len(ids) > 1 else np.zeros(0, dtype=np.uint64)
    largest = int(steps.max(initial=0))
    kind = next(k for k in _DIFFERENCES if largest <= np.iinfo(k).max)
    return ids[:1].tobytes() + bytes([np.dtype(kind).itemsize]) + steps.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, dtype=f"u{packed[8]}", offset=9)
    return np.cumsum(np.concatenate([np.frombuffer(packed, dtype=np.uint64, count=1), steps.astype(np.uint64)])).view(np.int64)


def _verdicts(hashes: np.ndarray, ids: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For windows in ascending order of hash: which of them repeat one of a smaller document, and which to pass on.

    ``late`` marks windows of documents without an id: all others are smaller, none of their own kind.
    """
    if not len(hashes):
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=bool)
    at = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    sizes = np.diff(np.append(at, len(hashes)))
    most = np.iinfo(np.int64).max
    least = np.repeat(np.minimum.reduceat(np.where(late, most, ids), at), sizes)
    early = np.repeat(np.logical_or.reduceat(~late, at), sizes)
    repeats = np.where(late, early, ids > least)
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (ids[1:] != ids[:-1]) | (late[1:] != late[:-1])
    return repeats & fresh, ~repeats & fresh


def _rows(groups: np.ndarray, hashes: np.ndarray, ids: np.ndarray, late: np.ndarray, repeats: bool) -> dict[str, list]:
    """One row for each bucket and kind of document, ordered by id inside."""
    order = np.lexsort((ids, late, groups))
    groups, hashes, ids, late = groups[order], hashes[order], ids[order], late[order]
    change = np.ones(len(groups), dtype=bool)
    change[1:] = (groups[1:] != groups[:-1]) | (late[1:] != late[:-1])
    at = np.flatnonzero(change)
    ends = np.append(at, len(groups))[1:]
    return {
        "bucket": groups[at].tolist(),
        "late": late[at].tolist(),
        "repeats": [repeats] * len(at),
        "hashes": [hashes[a:b].tobytes() for a, b in zip(at, ends, strict=True)],
        "ids": [_packed(ids[a:b]) for a, b in zip(at, ends, strict=True)],
    }


_SENT = pa.schema([("bucket", pa.int64()), ("late", pa.bool_()), ("repeats", pa.bool_()), ("hashes", pa.binary()), ("ids", pa.binary())])


def _slot(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _sent(size: int, buckets: int):
    """Windows of the task's texts, sorted block by block: the smallest document of each, and known repeats."""

    def finish(parts):
        hashes, ids, late = (np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.lexsort((ids, late, hashes))
        hashes, ids, late = hashes[order], ids[order], late[order]
        repeats, first = _verdicts(hashes, ids, late)
        for chosen, by, known in ((first, hashes, False), (repeats, mix(ids.view(np.uint64)), True)):
            rows = _rows(_slot(by[chosen], buckets), hashes[chosen], ids[chosen], late[chosen], known)
            yield pa.RecordBatch.from_pydict(rows, schema=_SENT)

    def send(batches):
        parts, held = [], 0
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            late = batch.column("late").to_numpy(zero_copy_only=False)
            for low, _, data, offsets in blocks(batch.column("text")):
                words, hashes, starts = _text_windows(data, offsets, size)
                row = low + words.text_of_word()[starts]
                parts.append((hashes, ids[row], late[row]))
                held += len(hashes)
                if held >= BLOCK_WINDOWS:
                    yield from finish(parts)
                    parts, held = [], 0
        if parts:
            yield from finish(parts)

    return send


def _found(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    hashes, ids, late = part
    return pa.RecordBatch.from_arrays([pa.array(late), pa.array(ids), pa.array(hashes.view(np.int64))], ["late", "id", "hash"])


def _compared(batches):
    """Rows in the order of their bucket: documents and hashes to remove from them."""

    def rows():
        for batch in batches:
            for row in zip(*(batch.column(name) for name in ("bucket", "late", "repeats", "hashes", "ids")), strict=True):
                bucket, late, repeats, hashes, ids = (value.as_py() for value in row)
                values = np.frombuffer(hashes, dtype=np.uint64)
                yield bucket, repeats, (values, _unpacked(ids), np.full(len(values), late))

    for _, members in groupby(rows(), key=lambda row: row[0]):
        sent = []
        for _, repeats, part in members:
            if repeats:
                yield _found(part)
            else:
                sent.append(part)
        if sent:
            hashes, ids, late = (np.concatenate(column) for column in zip(*sent, strict=True))
            order = np.lexsort((ids, late, hashes))
            hashes, ids, late = hashes[order], ids[order], late[order]
            repeats, _ = _verdicts(hashes, ids, late)
            yield _found((hashes[repeats], ids[repeats], late[repeats]))


def _kept_texts(data: np.ndarray, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    text = words.text_of_word()[kept]
    starts, ends = words.starts[kept], words.ends[kept]
    inner = np.flatnonzero(text[1:] == text[:-1])  # words with another kept one after them
    marks = np.zeros(len(data) + 2, dtype=np.int8)
    np.add.at(marks, starts, 1)
    np.add.at(marks, ends, -1)
    inside = np.cumsum(marks[: len(data)], dtype=np.int8).astype(bool)
    inside[ends[inner]] = True
    spaced = data.copy()
    spaced[ends[inner]] = 0x20
    lengths = np.bincount(text, weights=ends - starts, minlength=len(words.first) - 1).astype(np.int64)
    lengths += np.bincount(text[inner], minlength=len(lengths))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.tobytes()), pa.py_buffer(spaced[inside].tobytes())).cast(pa.string())


def _intervals(words: Words, gone: np.ndarray) -> pa.Array:
    """Maximal runs of removed words of each text, as places of the first word and of the one after the last."""
    text = words.text_of_word()
    before, after = gone.copy(), gone.copy()
    before[1:] &= ~gone[:-1] | (text[1:] != text[:-1])
    after[:-1] &= ~gone[1:] | (text[1:] != text[:-1])
    first, last = np.flatnonzero(before), np.flatnonzero(after)
    base = words.first[text[first]]
    pairs = pa.StructArray.from_arrays([pa.array(first - base, pa.int64()), pa.array(last + 1 - base, pa.int64())], ["first", "end"])
    counts = np.bincount(text[first], minlength=len(words.first) - 1)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pairs)


def _removed(size: int):
    """Texts with the hashes to remove from them: intervals and kept words."""

    def remove(batches):
        for batch in batches:
            ids, found = batch.column("doc_id"), batch.column("found")
            gone_hashes = found.values.to_numpy(zero_copy_only=False).view(np.uint64)
            limits = found.offsets.to_numpy()
            for low, high, data, offsets in blocks(batch.column("text")):
                words, hashes, starts = _text_windows(data, offsets, size)
                marks = np.zeros(len(words.starts) + size + 1, dtype=np.int64)
                borders = np.searchsorted(starts, words.first)
                for text in range(high - low):
                    hits = gone_hashes[limits[low + text] : limits[low + text + 1]]
                    if len(hits):
                        own = slice(borders[text], borders[text + 1])
                        hit = starts[own][np.isin(hashes[own], hits)]
                        marks[hit] += 1
                        marks[hit + size] -= 1
                gone = np.cumsum(marks[: len(words.starts)]) > 0
                taken = np.bincount(words.text_of_word()[gone], minlength=high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, high - low),
                        pa.array(words.counts, pa.int64()),
                        pa.array(taken, pa.int64()),
                        _intervals(words, gone),
                        _kept_texts(data, words, ~gone),
                    ],
                    ["doc_id", "n_words", "n_removed", "removed", "kept"],
                )

    return remove


def _identity(key: str, text: str) -> tuple[Column, Column]:
    """Whether a document has no id to compare by, and what its windows are known by."""
    number = F.col(key).try_cast("bigint")
    return number.isNull().alias("late"), F.coalesce(number, F.xxhash64(F.col(text).cast("string"))).alias("id")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, removed (array of first, end in words) and kept (text).

    A word goes if a window of ``size`` words that covers it also starts in a document of smaller id. Ids are
    compared as 64-bit integers; a document whose id is null or no integer comes after all others, and none of
    these removes anything from another, nor does a document from one of the same id. Null and empty texts and texts
    of fewer words than a window lose nothing. Repeated rows get the same result each. Very long texts are hashed
    alone and whole. An empty table gives an empty result. Other columns are not read, whatever their names.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), *_identity(key, text))
    bytes_of_text = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, min(bytes_of_text // BUCKET_BYTES, (1 << 31) - 1))
    sent = source.select("late", "id", "text").mapInArrow(
        _sent(size, buckets), "bucket bigint, late boolean, repeats boolean, hashes binary, ids binary"
    )
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(_compared, "late boolean, id bigint, hash bigint")
    found = found.groupBy("late", "id").agg(F.collect_list("hash").alias("found"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return (
        source.join(found, ["late", "id"], "left")
        .select("doc_id", "text", "found")
        .mapInArrow(
            _removed(size),
            f"doc_id {kind}, n_words bigint, n_removed bigint, removed array<struct<first: bigint, end: bigint>>, kept string",
        )
    )


def digest(repeats: DataFrame) -> DataFrame:
    """The kept text of ``remove_repeats`` as a checksum."""
    return repeats.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
    SELECT doc_id, start, sha256(array_to_string(words[start:start + 49], ' ')) AS content
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS start FROM texts WHERE len(words) >= 50)
),
repeated AS (
    SELECT doc_id, start FROM windows JOIN (SELECT content, min(doc_id) AS first_doc FROM windows GROUP BY content) USING (content)
    WHERE first_doc < doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS place FROM repeated),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts)
    ANTI JOIN gone USING (doc_id, place)
    GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts
LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id) USING (doc_id)
LEFT JOIN kept USING (doc_id)
"""
