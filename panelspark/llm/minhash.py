"""Near-duplicates by BagMinHash: signatures of weighted multisets of five-word shingles, bands, verified links.

A shingle that occurs w times has weight w. Its weights are discretised at 1, 2, 4, 8, ...: each band of
weights between two levels has a Poisson process of its own, of a rate equal to the band's width, whose points
fall on the components of the signature; in the last band, points above w are left out, which splits the
process as the hierarchy does. A component keeps its earliest point. Two multisets agree in a component with
the probability of their weighted Jaccard similarity, and a process stops once it is past the latest
component, so that long texts cost about one point a shingle.

Signatures are cut into ``BANDS`` bands of ``ROWS`` components (a pair of similarity 0.8 meets in one with
probability 0.9993). Texts that meet, also over others, form a cluster; all pairs of a cluster are compared
exactly, in blocks of bounded size, so no pair is ever a row and no task holds a whole cluster.

Defined cases: equal word sequences (words are separated by white space, case of A-Z ignored) are one class;
null, empty and white texts are equal to each other and to nothing else; a text of fewer than five words is one
shingle; rows that repeat are copies; a null id is a row like any other, though never the name of a class that
has other ids. The input may have further columns of any name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.graph import components
from panelspark.llm.kernels import U64, Words, fingerprints, grams, mix, text_slices
from panelspark.llm.tables import col, fresh, in_batches, sent_if
from panelspark.workspace import stored

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
#: Texts and bytes of a block; two blocks are compared at a time.
BLOCK_TEXTS, BLOCK_BYTES = 128, 1 << 20
#: Up to so many texts that met another (24 bytes each), or rows that go (8 bytes), are sent to all executors;
#: beyond it texts are shuffled.
BROADCAST_TEXTS = 2_000_000
#: Distinct shingles per matrix product of a comparison.
COLUMNS = 4096
_GOLD = U64(0x9E3779B97F4A7C15)


def counted(runs: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and count of the distinct shingles of each text."""
    key = mix(runs ^ (texts.astype(U64) + U64(1)) * _GOLD)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    return texts[order[first]], runs[order[first]], np.diff(np.append(first, len(key)))


def signatures(texts: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int, m: int = BANDS * ROWS) -> np.ndarray:
    """BagMinHash signatures, n x m; infinite where a text has no shingle."""
    least, latest = np.full(n * m, np.inf), np.full(n, np.inf)
    level = 0
    while True:
        low = 0 if level == 0 else 1 << (level - 1)
        width = max(1, low)
        there = np.flatnonzero(weights > low)
        if not len(there):
            break
        doc, weight = texts[there], weights[there]
        seed = mix(shingles[there] + U64((level + 1) * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        at, x = 0, np.zeros(len(there))
        while len(doc):
            many = 1 if len(doc) > 20_000 else 16
            r = mix(seed[:, None] + np.arange(at, at + many, dtype=U64) * _GOLD)
            gap = -np.log(((r >> U64(11)).astype(float) + 0.5) * 2.0**-53) / width
            gap[:, 0] += x
            times = np.cumsum(gap, axis=1)
            r = mix(r ^ _GOLD)
            to = doc[:, None] * m + ((r >> U64(32)) * U64(m) >> U64(32)).astype(np.int64)
            if width > 1:
                inside = low + width * ((r & U64(0xFFFFFFFF)).astype(float) * 2.0**-32) < weight[:, None]
                np.minimum.at(least, to[inside], times[inside])
            else:
                np.minimum.at(least, to.ravel(), times.ravel())
            latest = least.reshape(n, m).max(1)
            x = times[:, -1]
            go = x < latest[doc]
            doc, weight, seed, x, at = doc[go], weight[go], seed[go], x[go], at + many
        level += 1
    return least.reshape(n, m)


def bands(signature: np.ndarray) -> np.ndarray:
    """Keys of the bands. Times are compared as 32-bit floats, so last-bit differences between machines don't count."""
    parts = signature.astype(np.float32).view(np.uint32).reshape(len(signature), BANDS, ROWS).astype(U64)
    total = np.arange(1, BANDS + 1, dtype=U64)[None, :] * _GOLD
    for j in range(ROWS):
        total = mix(total ^ parts[:, :, j])
    return total


def _prepared(column: pa.Array) -> Iterator[list[pa.Array]]:
    for at, to, data, offsets in text_slices(column):
        words = Words(data, offsets)
        texts, shingles, weights = counted(*grams(words, SHINGLE))
        keys = bands(signatures(texts, shingles, weights, to - at)).view(np.int64)
        some = words.counts > 0
        ends = np.cumsum(np.where(some, BANDS, 0))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(keys[some].ravel()))
        yield [pa.array(fingerprints(words).view(np.int64)), lists, pa.array(np.diff(offsets))]


def links(column: pa.Array, clusters: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each text and a spanning label (a place in the column): texts of one cluster, and of two
    different blocks where a tile has two (``second`` tells the block; -1: all pairs of the cluster)."""
    docs, runs, at = [], [], 0
    for lo, hi, data, offsets in text_slices(column):
        r, t = grams(Words(data, offsets), SHINGLE)
        docs.append(t + lo)
        runs.append(r)
        at = hi
    texts, shingles, weights = counted(np.concatenate(runs), np.concatenate(docs))
    size = np.bincount(texts, weights, at)
    order = np.argsort(shingles, kind="stable")
    texts, shingles, weights = texts[order], shingles[order], weights[order]
    new = np.append(True, shingles[1:] != shingles[:-1])
    held = np.diff(np.append(np.flatnonzero(new), len(new)))
    shared = np.repeat(held > 1, held)
    texts, weights, column_of = texts[shared], weights[shared], np.cumsum(new)[shared]
    common = np.zeros((at, at), np.float32)
    column_of = np.unique(column_of, return_inverse=True)[1]
    for low in range(int(weights.max(initial=0))):  # the minimum of two counts is the number of levels both reach
        reach = weights > low
        t, c = texts[reach], column_of[reach]
        used = np.unique(c, return_inverse=True)[1]
        cuts = np.searchsorted(used, np.arange(0, int(used.max(initial=-1)) + 1 + COLUMNS, COLUMNS))
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = np.zeros((at, COLUMNS), np.float32)
            part[t[a:b], used[a:b] % COLUMNS] = 1
            common += part @ part.T
    linked = common >= THRESHOLD * (size[:, None] + size - common)
    linked &= (clusters[:, None] == clusters) & ((second[:, None] != second) | (second < 0))
    np.fill_diagonal(linked, False)
    label = np.arange(at)
    while True:
        low = np.where(linked, label, at).min(1, initial=at)
        better = np.minimum(label, low)
        better = better[better]
        if (better == label).all():
            return linked.sum(1), label
        label = better


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile. Small tiles are compared together, each text with those of its cluster only."""

    def compared(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        nodes, tile = t["node"].to_numpy(), t["tile"].to_numpy()
        block = np.where(t["i"].to_numpy() == t["j"].to_numpy(), -1, t["block"].to_numpy())
        degree, label = links(t["text"].combine_chunks(), tile, block)
        some = degree > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.array(nodes[label[some]]), pa.array(degree[some].astype(np.int64))],
            names=["node", "near", "links"],
        )

    held: list[pa.RecordBatch] = []
    rows = size = 0
    last = None
    for batch in batches:
        tile = batch.column(batch.schema.get_field_index("tile")).to_numpy()
        text = batch.column(batch.schema.get_field_index("text"))
        nbytes = pc.binary_length(text).to_numpy()
        cuts = [0, *(np.flatnonzero(tile[1:] != tile[:-1]) + 1), len(tile)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            more = int(nbytes[a:b].sum())
            if held and tile[a] != last and (rows + b - a > 2 * BLOCK_TEXTS or size + more > 2 * BLOCK_BYTES):
                yield compared(held)
                held, rows, size = [], 0, 0
            held.append(batch.slice(a, b - a))
            rows, size, last = rows + b - a, size + more, tile[a]
    if held:
        yield compared(held)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, list[str]]:
    """A written table of the rows with a row number and a text number, and for each text number its class
    (``component``, ``links`` to other texts); the names of the two columns added to the rows."""
    rid, node, keys, size = names = fresh(docs.columns, "_row", "_node", "_keys", "_bytes")
    kinds = [T.LongType(), T.ArrayType(T.LongType()), T.LongType()]
    numbered = docs.withColumn(rid, F.monotonically_increasing_id())
    rows = stored(
        in_batches(numbered, text_col, [T.StructField(n, k) for n, k in zip(names[1:], kinds)], _prepared), "signed"
    )
    first = stored(rows.groupBy(col(node).alias("node")).agg(F.min(col(rid)).alias("first"), F.count("*").alias("copies")), "texts")
    # copies have equal keys, so one row of each text is enough from here on
    one = stored(rows.groupBy(col(node).alias("node")).agg(F.first(col(keys)).alias("keys")), "bands")
    met = one.select("node", F.explode("keys").alias("key"))
    buckets = stored(
        met.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("most")).filter("lead != most").drop("most"), "buckets"
    )
    edges = met.join(buckets, "key").filter("node != lead").select("node", "lead").distinct()
    clusters = components(edges, "node", "lead").join(first, "node").select(
        F.col("node").alias(node), F.col("first").alias(rid), F.col("component").alias("cluster")
    )
    clusters = stored(clusters, "clusters")
    if clusters.count() <= BROADCAST_TEXTS:
        clusters = F.broadcast(clusters)  # the texts stay where they are
    candidates = stored(
        rows.join(clusters, [node, rid]).select(
            col(node).alias("node"), "cluster", F.coalesce(col(text_col), F.lit("")).alias("text"), col(size).alias("bytes")
        ),
        "candidates",
    )
    blocks = stored(
        candidates.groupBy("cluster").agg(
            F.ceil(F.greatest(F.count("*") / BLOCK_TEXTS, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
        ),
        "blocks",
    )
    dealt = (
        candidates.join(blocks, "cluster")
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node", "text", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        )
    )
    found = stored(
        dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(_tiles, "node long, near long, links long"),
        "links",
    )
    joined = components(found.select("node", "near"), "node", "near")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = first.join(joined, "node", "left").join(degree, "node", "left")
    return rows, stored(
        named.select("node", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"), "copies"),
        "classes",
    ), [rid, node]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its id, ``class_id`` (smallest id of its class), ``n_links`` (other distinct texts that it is
    linked with), ``n_copies`` (rows with its very words, itself included) and ``kept`` (id = class_id)."""
    rows, texts, (rid, node) = classes(docs.select(col(id_col), col(text_col)), id_col, text_col)
    ids = rows.groupBy(col(node).alias("node")).agg(F.min(col(id_col)).alias("least"))
    named = texts.join(ids, "node")
    least = named.groupBy("component").agg(F.min("least").alias("class_id"))
    named = stored(named.drop("least").join(least, "component").drop("component"), "named")
    return rows.select(col(id_col), col(node).alias("node")).join(named, "node").select(
        col(id_col), "class_id", F.col("links").alias("n_links"), F.col("copies").alias("n_copies"),
        F.coalesce(col(id_col) == F.col("class_id"), F.lit(False)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, the one of the smallest id, with the columns it had."""
    rows, texts, (rid, node) = classes(docs, id_col, text_col)
    best = (
        rows.select(col(rid).alias("row"), col(id_col).alias("id"), col(node).alias("node"))
        .groupBy("node")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"))
        .join(texts, "node")
        .groupBy("component")
        .agg(F.min("best").alias("best"))
    )
    keep = stored(best.select(F.col("best.row").alias(rid)), "kept")
    # fewer rows go than stay, and their numbers are small, so the texts stay where they are
    gone = stored(rows.select(col(rid)).join(keep, rid, "left_anti"), "gone")
    return rows.join(sent_if(gone, gone.count() <= BROADCAST_TEXTS), rid, "left_anti").select(*[col(c) for c in docs.columns])
