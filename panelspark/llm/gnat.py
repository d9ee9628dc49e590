"""Vector codes: every part of a vector is named by its nearest codebook entry, found by a GNAT over the entries.

A node of the tree (geometric near-neighbour access tree) holds split points, which are entries far from each other;
every other entry of the node hangs under its nearest split point. For every split point and every child the node
stores the range of distances from that point to the child's entries. A query whose distance to a split point, give
or take the best distance so far, misses that range can't have its nearest entry in the child, so the whole subtree
goes. Ranges and distances are rounded so that only entries that are strictly farther go; what is left is compared
in whole numbers, ties going to the lower index.

Codebooks are fitted by rounds of assignment and means rounded down. A task sums its own parts per entry, so a round
moves at most one row per entry and task however often a vector occurs, and the driver holds the codebooks only.

Defined cases: see ``whole_vectors`` for vectors that are left out; fewer vectors than entries make a smaller
codebook; equal ids are ordered by vector, null ids come last; repeated rows are coded each; equal entries leave all
parts to the lower index; an empty table has no rows and codebooks without entries.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.integer_vectors import whole_vectors
from panelspark.operators.joins import lookup
from panelspark.workspace import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node; nodes of at most ``LEAF`` entries are compared whole.
SPLITS, LEAF = 8, 32
#: Far more than the rounding of a square root and a sum of doubles.
_SLACK = 1e-12
_FAR = np.iinfo(np.int64).max


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, in whole numbers; by doubles where these hold every term exactly."""
    if 4 * a.shape[1] * float(max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))) ** 2 < 2**53:
        x, y = a.astype(float), b.astype(float)
        return ((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for d in range(a.shape[1]):
        step = a[:, d, None] - b[None, :, d]
        out += step * step
    return out


class Node:
    def __init__(self, entries: np.ndarray, names: np.ndarray):
        self.entries, self.names, self.children = entries, names, []
        if len(entries) <= LEAF:
            return
        centre = squared(entries, entries.mean(0, keepdims=True).astype(np.int64))[:, 0]
        chosen = [int(centre.argmax())]
        near = squared(entries, entries[chosen])[:, 0]
        while len(chosen) < SPLITS:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squared(entries, entries[chosen[-1:]])[:, 0])
        between = squared(entries, entries[chosen])
        under = between.argmin(1)
        rest = np.ones(len(entries), bool)
        rest[chosen] = False
        groups = [np.flatnonzero(rest & (under == j)) for j in range(SPLITS)]
        root = np.sqrt(between.astype(float))
        self.splits, self.split_names = entries[chosen], names[chosen]
        self.low = np.array([[root[g, i].min() if len(g) else np.inf for g in groups] for i in range(SPLITS)]) * (1 - _SLACK)
        self.high = np.array([[root[g, i].max() if len(g) else -np.inf for g in groups] for i in range(SPLITS)]) * (1 + _SLACK)
        self.children = [Node(entries[g], names[g]) if len(g) else None for g in groups]


def tree(entries: np.ndarray) -> Node:
    """A GNAT over the entries; of equal ones only the first can be the answer."""
    first = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    return Node(entries[first], first)


class Search:
    """Nearest entries of many queries, which go down the tree together."""

    def __init__(self, queries: np.ndarray):
        self.queries = queries
        self.best, self.name = np.full(len(queries), _FAR), np.full(len(queries), _FAR)
        self.compared = 0

    def take(self, rows: np.ndarray, found: np.ndarray, names: np.ndarray) -> None:
        self.compared += found.size
        least = found.min(1)
        name = np.where(found == least[:, None], names, _FAR).min(1)
        better = (least < self.best[rows]) | ((least == self.best[rows]) & (name < self.name[rows]))
        self.best[rows[better]], self.name[rows[better]] = least[better], name[better]

    def alive(self, node: Node, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which children may hold an entry that is no farther than the best so far."""
        reach = np.sqrt(self.best[rows].astype(float))[:, None, None] * (1 + _SLACK)
        outside = (low[:, :, None] > (reach + node.high) * (1 + _SLACK)) | ((high[:, :, None] + reach) * (1 + _SLACK) < node.low)
        return ~outside.any(1)

    def visit(self, node: Node, rows: np.ndarray) -> None:
        if not node.children:
            return self.take(rows, squared(self.queries[rows], node.entries), node.names)
        found = squared(self.queries[rows], node.splits)
        self.take(rows, found, node.split_names)
        root = np.sqrt(found.astype(float))
        low, high, nearest = root * (1 - _SLACK), root * (1 + _SLACK), found.argmin(1)
        for own in (True, False):  # each query's own child first: it brings the best down
            for j, child in enumerate(node.children):
                if child is not None:
                    on = np.flatnonzero((nearest == j) == own)
                    on = on[self.alive(node, rows[on], low[on], high[on])[:, j]]
                    if len(on):
                        self.visit(child, rows[on])
        return None


def nearest(queries: np.ndarray, root: Node, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and the squared distance, for every query."""
    names, best = np.empty(len(queries), np.int64), np.empty(len(queries), np.int64)
    for at in range(0, len(queries), block):
        search = Search(queries[at : at + block])
        search.visit(root, np.arange(len(search.queries)))
        names[at : at + block], best[at : at + block] = search.name, search.best
    return names, best


def _parts(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, PARTS, dims // PARTS)


def _sums(dims: int, books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part and entry: how many parts, and their sums as high and low halves, which can't overflow."""
    trees = [tree(b) for b in books]
    sums, many = np.zeros((*books.shape, 2), np.int64), np.zeros(books.shape[:2], np.int64)
    for batch in batches:
        parts = _parts(batch.column(0), dims)
        for p, root in enumerate(trees):
            names = nearest(parts[:, p], root)[0]
            many[p] += np.bincount(names, minlength=books.shape[1])
            for half, value in enumerate((parts[:, p] >> 31, parts[:, p] & (2**31 - 1))):
                np.add.at(sums[p, :, :, half], names, value)
    part, entry = np.nonzero(many)
    if len(part):
        found = sums[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(many[part, entry]), pa.array(found[..., 0].tolist(), pa.list_(pa.int64())), pa.array(found[..., 1].tolist(), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "high", "low"],
        )


def _codes(dims: int, books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees = [tree(b) for b in books]
    for batch in batches:
        parts = _parts(batch.column(0), dims)
        found = [nearest(parts[:, p], root) for p, root in enumerate(trees)]
        names = np.stack([n for n, _ in found], 1)
        code = pa.array(["".join(f"{n:02x}" for n in row) for row in names], pa.string())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], code, pa.array(sum(best for _, best in found))], names=[*batch.schema.names[1:], "code", "error"]
        )


def fit(vectors: DataFrame, dims: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks [part, entry, component] of a stored table ``id, v``."""
    start = vectors.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), PARTS, dims // PARTS).transpose(1, 0, 2)
    for _ in range(rounds if len(start) else 0):
        partial = vectors.select("v").mapInArrow(
            functools.partial(_sums, dims, books), "part int, entry int, n long, high array<long>, low array<long>"
        )
        width = range(dims // PARTS)
        each = [F.sum(F.col(half)[i]).alias(f"{half}{i}") for half in ("high", "low") for i in width]
        books = books.copy()
        for r in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each).collect():
            books[r["part"], r["entry"]] = [((r[f"high{i}"] << 31) + r[f"low{i}"]) // r["n"] for i in width]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def coded(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``id_col, code, error, label_error`` for every vector, and the codebooks.

    ``label_error`` is the error summed over rows of equal labels; it is null where the sum would not fit in a long.
    """
    rows, dims = whole_vectors(vectors, SCALE, id_col, vector_col, {label_col: "label"}, PARTS)
    books = fit(rows, dims)
    schema = T.StructType([*rows.select("id", "label").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    # a label as text, null apart from every other, so that rows without one meet their sum too
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    found = stored(rows.select("v", "id", "label").mapInArrow(functools.partial(_codes, dims, books), schema).withColumn("label", label), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = found.groupBy("label").agg(F.when(total < F.lit(str(2**63)).cast("decimal(38,0)"), total).cast("long").alias("label_error"))
    return lookup(found, stored(sums, "label-errors"), ["label"]).select(F.col("id").alias(id_col), "code", "error", "label_error"), books
