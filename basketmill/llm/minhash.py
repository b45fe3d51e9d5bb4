"""Near duplicates: fast similarity sketches, banding, exact verification, connected components.

The sketch of a set has a fixed number of coordinates. In each round every element is thrown into one
coordinate with a value that grows from round to round, and the smallest value stays; rounds go on until
all coordinates are filled, and after as many rounds as there are coordinates each further round fills a
set one, so that none can stay empty. Two sets agree in a coordinate with the probability of their
similarity, concentrated as for independent hashes.

Sketches are cut into bands. Texts that share a band fall into loose clusters; inside a cluster all pairs
are verified on their full shingle sets, and only spanning links are passed on. Clusters are dealt in
blocks of bounded size and every pair of blocks is verified somewhere, so no link is lost however
large a cluster is. Texts with equal sets are one node from the start.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.llm.arrays import SPACED, blocks, id_and_text, mix, run_hashes, span_hashes, split_words
from basketmill.llm.components import components
from basketmill.llm.staging import written

SHINGLE = 5
PERCENT = 85
# A pair at 0.85 shares none of 48 bands of 8 coordinates with probability 3e-7.
BANDS, ROWS = 48, 8
# Characters of distinct text verified together by one task.
BLOCK_CHARS = 6_000_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_NO_ID = (1 << 63) - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = split_words(data, offsets, SPACED)
    hashes, text = run_hashes(span_hashes(data, words.starts, words.ends), words, size)
    if (words.counts < size).any():
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    edges = np.searchsorted(text, np.arange(len(offsets)))
    sets = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        own = np.sort(hashes[low:high])
        sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
    return sets


def sketches(sets: list[np.ndarray], size: int = BANDS * ROWS) -> np.ndarray:
    """A row of ``size`` coordinates per set; rows of empty sets stay unfilled."""
    table = np.full((len(sets), size), _EMPTY, dtype=np.uint64)
    flat = table.reshape(-1)
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    open_rows = np.flatnonzero(counts)
    elements = np.concatenate([sets[i] for i in open_rows]) if len(open_rows) else np.zeros(0, dtype=np.uint64)
    base = np.repeat(open_rows * size, counts[open_rows])
    for turn in range(2 * size):
        if not len(open_rows):
            break
        hashed = mix(elements + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (hashed & np.uint64(0xFFFFFFFF)) | np.uint64(turn << 32)
        if turn < size:
            place = ((hashed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = turn - size
        np.minimum.at(flat, base + place, value)
        if turn < 6 or turn % 8 == 0:
            unfilled = (table[open_rows] == _EMPTY).any(axis=1)
            if not unfilled.all():
                keep = np.repeat(unfilled, counts[open_rows])
                elements, base, open_rows = elements[keep], base[keep], open_rows[unfilled]
    return table


def band_keys(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band: equal for equal coordinates of the same band."""
    n, size = table.shape
    factors = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    keys = (table.reshape(n, size // rows, rows) * factors).sum(axis=2, dtype=np.uint64)
    return mix(keys + np.arange(1, size // rows + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)).view(np.int64)


def _sketched(n_bands: int, rows: int):
    def sketched(batches):
        for batch in batches:
            counts, nodes, bands = [], [], []
            for _, _, data, offsets in blocks(batch.column("text"), most_rows=2000):
                sets = shingle_sets(data, offsets)
                keys = band_keys(sketches(sets, n_bands * rows), rows)
                counts += [len(s) for s in sets]
                nodes += [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None for s in sets]
                bands += [k if len(s) else None for s, k in zip(sets, keys, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "node": pa.array(nodes, pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                }
            )

    return sketched


def similar(own: int, other: int, common: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (own + other - common)


def spanning_links(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that span the components of all pairs at or above the threshold, by exact set sizes."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if similar(sizes[0], sizes[1], common, percent) else []
    _, shingle = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(shingle, kind="stable")
    posted, heads = owner[order], np.searchsorted(shingle[order], np.arange(shingle.max() + 2))
    borders = np.concatenate([[0], np.cumsum(sizes)])
    parent, links = np.arange(n), []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(n):
        own = shingle[borders[i] : borders[i + 1]]
        low, length = heads[own], heads[own + 1] - heads[own]
        inside = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        common = np.bincount(posted[np.repeat(low, length) + inside], minlength=n)[:i]
        for k in np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[:i] - common)):
            a, b = root(i), root(int(k))
            if a != b:
                parent[a] = b
                links.append((int(k), i))
    return links


def _verified(percent: int):
    """Spanning links of every run of rows with the same cluster and blocks."""

    def verified(batches):
        def links(nodes, texts):
            column = pa.array(texts, pa.large_string())
            sets = [s for _, _, data, offsets in blocks(column) for s in shingle_sets(data, offsets)]
            return [(nodes[a], nodes[b]) for a, b in spanning_links(sets, percent)] if len(sets) > 1 else []

        key, nodes, texts, found = None, [], [], []
        for batch in batches:
            for label, i, j, node, text in zip(*(batch.column(c).to_pylist() for c in ("label", "i", "j", "node", "text")), strict=True):
                if (label, i, j) != key:
                    found += links(nodes, texts)
                    key, nodes, texts = (label, i, j), [], []
                nodes.append(node)
                texts.append(text)
        found += links(nodes, texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"]
        )

    return verified


def _loose_clusters(docs: DataFrame) -> DataFrame:
    """(node, label): nodes that share a band, directly or through others."""
    keys = docs.where("node IS NOT NULL").select("node", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top")
    buckets = written(buckets.select("band", "hub"), "buckets")
    edges = keys.join(buckets, "band").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return components(edges, "clusters")


def _dealt(docs: DataFrame, classes: DataFrame, loose: DataFrame, block_chars: int) -> DataFrame:
    """The text of every clustered node, once for each pair of blocks that it has to meet."""
    spots = loose.join(classes, "node").select("node", "label", "spot", "spot_hash")
    texts = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("spot"), "text", F.xxhash64("text").alias("spot_hash"))
    texts = written(texts.join(spots, ["spot", "spot_hash"]).dropDuplicates(["node"]).select("node", "label", "text"), "clustered")
    sizes = texts.groupBy("label").agg(F.ceil(F.sum(F.length("text")) / block_chars).cast("int").alias("n_blocks"), F.count("*").alias("n"))
    sizes = written(sizes.where("n > 1"), "cluster_sizes")
    placed = texts.join(sizes, "label").withColumn("own", F.pmod(F.hash("node"), F.col("n_blocks")))
    others = F.when(F.col("n_blocks") > 1, F.array_except(F.sequence(F.lit(0), F.col("n_blocks") - 1), F.array("own"))).otherwise(F.array("own"))
    placed = placed.withColumn("other", F.explode(others))
    return placed.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "text")


def near_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id and kept, and the hash of its text as text_hash.

    Words are runs without white space, A-Z read as a-z; a text of fewer words than a shingle is one
    shingle. A null or blank text has no shingles and is linked with nothing: its component is itself.
    component_id is the smallest id that can be reached over links of similarity ``percent`` or more, null only
    where no reachable document has an id. Repeated rows share everything; all rows with the smallest id
    are marked as kept. A pair at similarity s shares no band with probability (1 - s ** rows) ** bands.
    """
    return _judged(docs, block_chars, percent, bands, rows).drop("group")


def _judged(docs: DataFrame, block_chars: int, percent: int, bands: int, rows: int) -> DataFrame:
    """``near_duplicates`` and the group of each row: one number per component, null without shingles."""
    source = id_and_text(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    hashed = source.withColumn("text_hash", F.xxhash64("text"))
    own = written(hashed.mapInArrow(_sketched(bands, rows), "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, bands array<bigint>"), "sketches")
    spot = F.coalesce("doc_id", F.lit(_NO_ID))
    classes = own.where("node IS NOT NULL").groupBy("node")
    classes = written(classes.agg(F.min(spot).alias("spot"), F.min_by("text_hash", spot).alias("spot_hash")), "classes")
    dealt = _dealt(source, classes, _loose_clusters(own), block_chars)
    links = dealt.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "node").mapInArrow(_verified(percent), "a bigint, b bigint")
    linked = components(links, "links")
    least = linked.join(classes, "node").groupBy("label").agg(F.min("spot").alias("least"))
    least = linked.join(least, "label").select("node", "least", "label")
    smallest = classes.join(least, "node", "left").select("node", F.coalesce("least", "spot").alias("least"), F.coalesce("label", "node").alias("group"))
    smallest = written(smallest, "smallest")
    joined = own.drop("bands").join(smallest, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.nullif("least", F.lit(_NO_ID)))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), "text_hash", "group").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def deduplicate(docs: DataFrame, block_chars: int = BLOCK_CHARS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One document of each group of near duplicates, with the columns it came with; repeated rows count as a group.

    It is the one of the smallest id; of several with that id, or of several without any, the one of the least text hash.
    """
    kept = _judged(docs, block_chars, percent, bands, rows).where("kept")
    # Texts without shingles are groups of their own by id and text.
    kept = kept.groupBy("group", F.when(F.col("group").isNull(), F.struct("doc_id", "text_hash")).alias("own"))
    kept = kept.agg(F.min("doc_id").alias("_kept_id"), F.min("text_hash").alias("_kept_hash")).select("_kept_id", "_kept_hash")
    kept = written(kept, "kept")
    keyed = docs.withColumns({"_own_id": F.col("doc_id").cast("bigint"), "_own_hash": F.xxhash64(F.col("text").cast("string"))})
    same = keyed["_own_id"].eqNullSafe(kept["_kept_id"]) & (keyed["_own_hash"] == kept["_kept_hash"])
    return keyed.join(kept, same).dropDuplicates(["_own_id", "_own_hash"]).select(*docs.columns)


# The same over documents, as SQL: all pairs that share a shingle, and all documents that can be reached.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT ROW_NUMBER() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM d, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS places(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS size FROM s GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM s a JOIN s b USING (shingle) WHERE a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.r = x JOIN n b ON b.r = y
  WHERE 100 * common >= 85 * (a.size + b.size - common)),
reached AS (SELECT r AS x, r AS y FROM d UNION SELECT reached.x, links.y FROM reached JOIN links ON links.x = reached.y),
least AS (SELECT x AS r, min(doc_id) AS component_id FROM reached JOIN d ON d.r = reached.y GROUP BY x)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN least USING (r) LEFT JOIN n USING (r)
"""
