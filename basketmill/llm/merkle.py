"""Document fingerprints: Merkle trees over sections, paragraphs and pieces of text.

A paragraph is a line. A section ends with a blank line, or with a paragraph whose own digest says so
(one in eight), so that borders stay where they were when text is inserted before them. A paragraph's
digest covers its bytes, a section's the digests of its paragraphs, the root those of the sections:
roots are equal just if the texts are. Each paragraph also lists short labels of its pieces, cut at
sentence ends; the likeness of two trees is the share of labels they have in common, by weight. The
first pieces of a text are finer and weigh less, so that short texts can be told apart.

A fingerprint is written as ``root:section=paragraph-labels,paragraph-labels/section=...``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import id_and_text
from basketmill.llm.staging import written

SECTION_ONE_IN = 8
FINE_PIECES = 16
COARSE_WEIGHT = 4
LABEL = 6
_PARAGRAPH = re.compile(rb"[^\n]*\n|[^\n]+")
_FINE = re.compile(rb"(?:[^\s.!?]+\s*){0,1}\S+\s*|\s+")
_COARSE = re.compile(rb"(?:[^\s.!?]+\s*){0,15}\S+\s*|\s+")

Tree = list[tuple[str, list[tuple[str, list[str]]]]]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def build(text: str) -> tuple[str, Tree]:
    """Root and sections of a text: (section digest, [(paragraph digest, piece labels)])."""
    sections, paragraphs, below, fine = [], [], [], FINE_PIECES
    for paragraph in _PARAGRAPH.findall(text.encode("utf-8", "surrogatepass")):
        at, pieces = 0, []
        if fine:
            pieces = [m[0] for m in islice(_FINE.finditer(paragraph), fine)]
            at, fine = sum(map(len, pieces)), fine - len(pieces)
        pieces += _COARSE.findall(paragraph, at)
        own = _digest(paragraph)
        below.append(own)
        paragraphs.append((own.hex()[:8], [f"{zlib.crc32(p):08x}"[-LABEL:] for p in pieces]))
        if own[0] * SECTION_ONE_IN < 256 or not paragraph.strip():
            sections.append((_digest(b"".join(below)), paragraphs))
            below, paragraphs = [], []
    if below:
        sections.append((_digest(b"".join(below)), paragraphs))
    return _digest(b"".join(s[0] for s in sections)).hex(), [(s[0].hex()[:8], s[1]) for s in sections]


def write_tree(root: str, tree: Tree) -> str:
    return root + ":" + "/".join(s + "=" + ",".join(p + "-" + "".join(labels) for p, labels in inner) for s, inner in tree)


def read_tree(fingerprint: str) -> tuple[str, Tree]:
    root, _, rest = fingerprint.partition(":")
    tree = []
    for section in filter(None, rest.split("/")):
        digest, _, inner = section.partition("=")
        pairs = [p.partition("-")[::2] for p in inner.split(",")]
        tree.append((digest, [(p, [s[i : i + LABEL] for i in range(0, len(s), LABEL)]) for p, s in pairs]))
    return root, tree


def weights(tree: Tree) -> Counter:
    found, place = Counter(), 0
    for _, inner in tree:
        for _, labels in inner:
            if place >= FINE_PIECES:
                for label in labels:
                    found[label] += COARSE_WEIGHT
            else:
                for label in labels:
                    found[label] += 1 if place < FINE_PIECES else COARSE_WEIGHT
                    place += 1
    return found


def alike(root: str, own: Counter, other_root: str, other: Counter) -> float:
    """1 for equal roots, else twice the common weight over the whole weight, below 1."""
    if root == other_root:
        return 1.0
    common = sum(min(n, other[label]) for label, n in own.items() if label in other)
    total = own.total() + other.total()
    return min(2 * common / total, 0.999999) if total else 0.0


def likeness(fingerprint: str, other: str) -> float:
    """Likeness of two written fingerprints, from 0 to 1."""
    (root, tree), (other_root, other_tree) = read_tree(fingerprint), read_tree(other)
    return alike(root, weights(tree), other_root, weights(other_tree))


def edits(fingerprint: str, other: str) -> list[tuple[int, int]]:
    """(section, paragraph) places in the other text, from 0, that differ from all of the first; equal branches are skipped."""
    (root, tree), (other_root, other_tree) = read_tree(fingerprint), read_tree(other)
    if root == other_root:
        return []
    sections = {s for s, _ in tree}
    paragraphs = {p for _, inner in tree for p, _ in inner}
    return [
        (i, k) for i, (s, inner) in enumerate(other_tree) if s not in sections for k, (p, _) in enumerate(inner) if p not in paragraphs
    ]


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class _Print:
    """A text with its tree, as the sweep below needs it."""

    def __init__(self, text: str):
        self.text = text
        self.root, tree = build(text)
        self.written, self.weights = write_tree(self.root, tree), weights(tree)

    def against(self, following: _Print) -> tuple:
        changed = edited(self.text, following.text)
        other = _Print(changed) if changed != self.text else self
        return (
            hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            self.written,
            other.written,
            alike(self.root, self.weights, other.root, other.weights),
            alike(self.root, self.weights, following.root, following.weights),
        )


_ROW = [
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]
_ROW_SQL = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FLUSH = 500


def _batch(rows: list[tuple], id_type: pa.DataType, fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in range(len(fields) + 1)]
    kinds = [("doc_id", id_type), *fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


_SWEPT = [*_ROW, ("part", pa.int64()), ("end", pa.string()), ("text", pa.string())]


def _sweep(batches):
    """Each document against the next of its partition; the first text and the last document are handed on."""
    part, previous, out, kind = TaskContext.get().partitionId(), None, [], None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            now = _Print(text or "")
            if previous is None:
                out.append((None, *[None] * len(_ROW), part, "first", now.text))
            else:
                out.append((previous[0], len(previous[1].text), *previous[1].against(now), part, None, None))
            previous = (doc_id, now)
            if len(out) >= _FLUSH:
                yield _batch(out, kind, _SWEPT)
                out = []
    if previous is not None:
        out.append((previous[0], *[None] * len(_ROW), part, "last", previous[1].text))
        yield _batch(out, kind, _SWEPT)


def _finish(batches):
    for batch in batches:
        rows = []
        for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
            rows.append((doc_id, len(text), *_Print(text).against(_Print(following))))
        yield _batch(rows, batch.schema.field("doc_id").type, _ROW)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one that follows by ascending doc_id, nulls first; equal ids follow each
    other by a hash of their texts; the last is followed by the first, a single one by itself. A null
    text counts as empty. Texts travel once, to their place in the order; only the first text and the
    last document of each partition are joined afterwards.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    source = id_and_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    swept = written(ranged.mapInArrow(_sweep, f"doc_id {kind}, {_ROW_SQL}, part bigint, end string, text string"), "fingerprints")
    parts = sorted(r.part for r in swept.where("end = 'first'").select("part").collect())  # one number per partition
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part bigint, next_part bigint")
    first = swept.where("end = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = swept.where("end = 'last'").select("part", "doc_id", "text")
    ends = last.join(follows, "part").join(first, "next_part").select("doc_id", "text", "following")
    names = ["doc_id", *(n for n, _ in _ROW)]
    return swept.where("end IS NULL").select(names).unionAll(ends.mapInArrow(_finish, f"doc_id {kind}, {_ROW_SQL}"))
