"""Secret scan: keyword automaton, anchored patterns at its hits, then embedded checksums.

An Aho-Corasick automaton over all keywords reads a text once. A pattern is tried only where one of
its keywords starts, anchored there; a hit inside the previous match of the kind is passed over, so
that matches are leftmost and do not overlap. Long hexadecimal runs have no keyword and are found by
their own pattern. Kinds with a checksum count only if it fits.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import id_and_text

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(value: int, width: int) -> str:
    digits = ""
    while value or len(digits) < width:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def crc_fits(token: str) -> bool:
    """The last six characters are the CRC32 of the random part, in base 62."""
    body = token.split("_", 1)[1]
    return base62(zlib.crc32(body[:-6].encode()), 6) == body[-6:]


def header_fits(token: str) -> bool:
    """The first part of a signed web token decodes to an object that names its algorithm."""
    head = token.split(".", 1)[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError, RecursionError):
        return False


def luhn_fits(token: str) -> bool:
    """The number after the keyword satisfies the card check digit."""
    digits = [int(d) for d in re.sub(r"[^0-9]", "", token)]
    doubled = sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return len(digits) >= 13 and (sum(digits[-1::-2]) + doubled) % 10 == 0


@dataclass(frozen=True)
class Kind:
    """``valid`` judges a match; matches that fail are used up but not reported."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]


# The three base kinds in their order, then kinds with an embedded checksum or fixed form.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
        ),
        lambda m: len(m[2]) >= 6,
    ),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    Kind("hex", (), re.compile(r"[0-9a-f]{24,}"), lambda m: True),
    Kind(
        "forge",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        lambda m: crc_fits(m[0]),
    ),
    Kind("registry", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc_fits(m[0])),
    Kind("webtoken", ("eyj",), re.compile(r"eyJ[\w-]+\.[\w-]+\.[\w-]*", re.ASCII), lambda m: header_fits(m[0])),
    Kind(
        "pem",
        ("-----begin",),
        re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
        lambda m: True,
    ),
    Kind("card", ("card",), re.compile(r"card\W{0,3}(?:\d[ -]?){12,18}\d(?!\d)", re.IGNORECASE | re.ASCII), lambda m: luhn_fits(m[0])),
)
BASE_KINDS = 3
_HEX = 2


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for order, kind in enumerate(KINDS):
        for keyword in kind.keywords:
            found.add_word(keyword, (order, len(keyword)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """Lower case of the same length. One capital letter alone would grow and is not in any keyword."""
    low = text.lower()
    return low if len(low) == len(text) else text.replace("İ", "I").lower()


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of all secrets, sorted, in code points."""
    spans, reach = [], [0] * len(KINDS)
    for last, (order, size) in automaton().iter(lowered(text)):
        start = last + 1 - size
        if start < reach[order]:
            continue
        match = KINDS[order].pattern.match(text, start)
        if match:
            reach[order] = match.end()
            if KINDS[order].valid(match):
                spans.append((start, order, match.end()))
    spans.extend((m.start(), _HEX, m.end()) for m in KINDS[_HEX].pattern.finditer(text))
    return sorted(spans)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind].name}:{start}:{end}" for start, kind, end in spans)


def _scan(batches):
    for batch in batches:
        found = [find_spans(text or "") for text in batch.column("text").to_pylist()]
        base = [[s for s in spans if s[1] < BASE_KINDS] for spans in found]
        count = lambda order: pa.array([sum(s[1] == order for s in spans) for spans in base], pa.int64())
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_assign": count(0),
                "n_access": count(1),
                "n_hex": count(2),
                "base_sha256": pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base], pa.string()),
                "spans": pa.array([written(s) for s in found], pa.string()),
            }
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 and spans.

    A null text counts as empty: no spans. Repeated documents have a row each.
    """
    source = id_and_text(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_scan, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(text: str) -> str:
    """The text with every secret replaced by the name of its kind; overlapping ones by one name."""
    out, reach = [], 0
    for start, kind, end in find_spans(text):
        if start >= reach:
            out += [text[reach:start], f"[{KINDS[kind].name}]"]
        reach = max(reach, end)
    return "".join([*out, text[reach:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced and ``n_chars`` brought up to date; no row is dropped.

    A null text stays null. Columns other than text and n_chars pass unchanged.
    """

    def rewrite(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else redacted(t) for t in texts.to_pylist()], pa.string())

    # Only the text goes to Python.
    changed = docs.withColumn("text", F.arrow_udf(rewrite, "string")("text"))
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars").cast("bigint")))
