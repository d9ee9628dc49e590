"""Near-duplicate vectors by int8 tiles with rigorous error bounds.

A vector of length 1 is its quantised form (int8 codes times a scale) plus a rest whose length is known exactly. The
inner product of two vectors therefore differs from that of the codes by at most |a||s| + |r||b| + |r||s|, where a, b
are the quantised forms and r, s the rests. A tile is the product of the codes of two blocks, with four more columns
that add the bound and take off the threshold; pairs that the bound leaves open are computed again, in double
precision.

Equal vectors are one class before anything is compared. A block has about ``BLOCK_BYTES`` of the vectors of one
length; every pair of blocks is one tile. A task reads the blocks of two parts of the table of blocks from the shared
folder, so blocks are written once and not sent to every tile: what is written grows with the vectors, only the work
with their square. A task returns a count of links for each class and a spanning label, never its pairs.

Defined cases: vectors that are null, zero or hold null, NaN or infinite components link with nothing, nor do
vectors of different lengths; vectors whose squared length is no positive finite double link with their copies only;
repeated rows are linked with each other; a null id counts as a vector, though it never names a component that has
other ids.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.graph import components
from panelspark.llm.tables import col
from panelspark.workspace import stored

THRESHOLD = 0.9
#: Bytes of the vectors of a block, and of the blocks of a part that a task holds, unless one file has more.
BLOCK_BYTES, PART_BYTES = 2 << 20, 32 << 20
#: Classes whose products are computed at once; pairs and links after which they are summed up; blocks a task keeps prepared.
STEP, MANY, KEPT = 1024, 1 << 20, 24
#: Dimensions whose products of codes are summed at once: below this the sums are exact in 32-bit floats.
EXACT = (1 << 24) // (127 * 127)
_SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, lengths of the quantised forms and of the rests (rounded up) of vectors of length 1."""
    scale = np.abs(unit).max(1, keepdims=True) / 127
    codes = np.rint(unit / scale)
    form = codes * scale
    return codes.astype(np.int8), scale[:, 0], np.linalg.norm(form, axis=1) * (1 + _SLACK), np.linalg.norm(unit - form, axis=1) + _SLACK


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    parts = range(0, a.shape[1], EXACT)
    one = (a[:, k : k + EXACT].astype(np.float32, copy=False) @ b[:, k : k + EXACT].astype(np.float32, copy=False).T for k in parts)
    return next(one) if len(parts) == 1 else sum(x.astype(float) for x in one)


class Block(NamedTuple):
    """Vectors as stored; ``terms`` are codes and four more columns, whose product with those of the other side is at
    least 0 for each pair that can reach the threshold. ``rest`` is infinite where the bound proves nothing."""

    nodes: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    terms: np.ndarray
    scale: np.ndarray
    form: np.ndarray
    rest: np.ndarray


def _rounding(dims: int) -> float:
    """No product of terms, times both scales, is further off in 32-bit floats: a side times its scale is no longer than 3.4."""
    return 12 * (dims + 8) * 2.0**-24


def block(nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray, first: bool, threshold: float = THRESHOLD) -> Block:
    """``first``: the block is the first side of its tiles."""
    x, dims = vectors.astype(float), vectors.shape[1]
    with np.errstate(all="ignore"):
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        length = np.linalg.norm(unit, axis=1)
    usable = np.isfinite(length) & (length > 0)  # not where squares leave the range of doubles
    unit[~usable] = 1
    codes, scale, form, rest = quantised(unit)
    codes[~usable], scale[~usable], form[~usable], rest[~usable] = 0, 1, 0, 0
    low = threshold - _SLACK - _rounding(dims)
    more = (form, rest, rest, np.ones(len(x))) if first else (rest, form, rest, np.full(len(x), -low))
    terms = np.concatenate([codes.astype(np.float32), *((m / scale).astype(np.float32)[:, None] for m in more)], axis=1)
    return Block(nodes, copies, vectors, terms, scale, form, np.where(np.abs(length - 1) < _SLACK, rest, np.inf))


def tile_links(a: Block, b: Block, same: bool, threshold: float = THRESHOLD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the linked pairs of two blocks, some at a time; of one block with itself each pair once."""
    slack = 2 * (_SLACK + _rounding(a.vectors.shape[1]))
    for p in range(0, len(a.nodes), STEP):
        for q in range(p if same else 0, len(b.nodes), STEP):
            reach = code_products(a.terms[p : p + STEP], b.terms[q : q + STEP])
            some = np.flatnonzero(reach.max(1) >= 0)
            i, j = np.nonzero(reach[some] >= 0)
            i = some[i]
            if same and p == q:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            over = reach[i, j].astype(float)
            i, j = i + p, j + q
            bound = a.form[i] * b.rest[j] + a.rest[i] * b.form[j] + a.rest[i] * b.rest[j]
            keep = over * a.scale[i] * b.scale[j] >= 2 * bound + slack
            unsure = np.flatnonzero(~keep)
            for at in range(0, len(unsure), 1 << 16):
                k = unsure[at : at + (1 << 16)]
                x, y = a.vectors[i[k]].astype(float), b.vectors[j[k]].astype(float)
                dot = np.einsum("nd,nd->n", x, y)
                keep[k] = dot / (np.sqrt(np.einsum("nd,nd->n", x, x)) * np.sqrt(np.einsum("nd,nd->n", y, y))) >= threshold
            yield i[keep], j[keep]


def _spanned(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the pairs are joined: each place has the smallest that it is joined with."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not ((low := label[label]) == label).all():
            label = low


def _tile(a: Block, b: Block, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``node, near, links`` of the classes that have links."""
    nodes = a.nodes if same else np.concatenate([a.nodes, b.nodes])
    shift, links, label = 0 if same else len(a.nodes), np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    found = tile_links(a, b, same)
    while True:
        new = next(found, None)
        if new:
            pairs.append(new)
        if pairs and (new is None or sum(len(i) for i, _ in pairs) >= MANY):
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            links += np.bincount(i, b.copies[j], len(nodes)).astype(np.int64) + np.bincount(j + shift, a.copies[i], len(nodes)).astype(np.int64)
            label, pairs = _spanned(label, i, j + shift), []
        if new is None:
            return nodes[links > 0], nodes[label[links > 0]], links[links > 0]


def _summed(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same links and components in one row for each class."""
    node, near, links = (np.concatenate(x) for x in zip(*found, strict=True))
    names, at = np.unique(np.concatenate([node, near]), return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, at[: len(node)], links)
    label = _spanned(np.arange(len(names)), at[: len(node)], at[len(node) :])
    return names, names[label], total


def _tiles(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of all tiles of a task. Small blocks that meet the same block are compared with it at once."""
    kept: dict[tuple[str, int], Block] = {}
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def side(batch: pa.RecordBatch, name: str, row: int) -> Block:
        of = lambda c: batch.column(f"{name}_{c}")[row]
        key = (name, of("first").as_py())
        if key not in kept:
            while len(kept) >= KEPT:
                del kept[next(iter(kept))]
            nodes, copies = (np.array(of(c).values) for c in ("nodes", "copies"))
            kept[key] = block(nodes, copies, np.frombuffer(of("vectors").as_buffer(), kind).reshape(len(nodes), -1).copy(), name == "a")
        return kept[key]

    def add(a: Block, b: Block, same: bool) -> None:
        found.append(_tile(a, b, same))
        if sum(len(x) for x, _, _ in found) >= MANY:
            found[:] = [_summed(found)]

    for batch in batches:
        last, others = None, []
        for row in range(batch.num_rows):
            a, b = side(batch, "a", row), side(batch, "b", row)
            if others and (a is not last or sum(x.vectors.nbytes for x in others) >= BLOCK_BYTES):
                add(last, Block(*map(np.concatenate, zip(*others, strict=True))), False)
                others = []
            if a.nodes[0] == b.nodes[0]:
                add(a, b, True)
            else:
                last, others = a, [*others, b]
        if others:
            add(last, Block(*map(np.concatenate, zip(*others, strict=True))), False)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(found)], names=["node", "near", "links"])


def _packed(kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the classes of each length."""
    held: dict[int, list[pa.RecordBatch]] = {}
    width = np.dtype(kind).itemsize

    def out(length: int, all_rows: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held.pop(length))
        size = max(1, BLOCK_BYTES // (length * width))
        for at in range(0, len(rows), size):
            some = rows.slice(at, size)
            if len(some) < size and not all_rows:
                held[length] = some.to_batches()
                return
            listed = lambda c: pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some[c].combine_chunks())  # noqa: B023, E731
            vectors = some["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).tobytes()
            head = [pa.array([length], pa.int32()), some["node"].combine_chunks()[:1]]
            yield pa.RecordBatch.from_arrays(
                [*head, *(listed(c) for c in ("node", "copies", "least", "key")), pa.array([vectors], pa.binary())],
                names=["length", "first", "nodes", "copies", "least", "keys", "vectors"],
            )

    for batch in batches:
        lengths = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
        for n in np.unique(lengths).tolist():
            held.setdefault(n, []).append(batch if (lengths == n).all() else batch.filter(pa.array(lengths == n)))
            if sum(map(len, held[n])) * n * width >= BLOCK_BYTES:
                yield from out(n, False)
        if len(held) > KEPT and sum(len(x) * n * width for n, some in held.items() for x in some) >= KEPT * BLOCK_BYTES:
            for n in [*held]:
                yield from out(n, True)
    for n in [*held]:
        yield from out(n, True)


def _key(v: str) -> Column:
    """What stands for a vector where classes meet their rows: a hash of all digits of its components."""
    return F.unhex(F.sha2(F.array_join(F.col(v).cast("array<string>"), ","), 256))


def _pairs(blocks: DataFrame, width: int) -> DataFrame:
    """Each pair of blocks of one length once, each block also with itself. A task takes two parts of the table, both
    read where it lies; parts are about as large as a task can hold, unless there are too few tasks then."""
    sizes = blocks.agg(F.count("*").alias("n"), F.sum(F.size("nodes") * F.col("length").cast("long")).alias("numbers")).first()
    few = math.ceil(math.sqrt(16 * blocks.sparkSession.sparkContext.defaultParallelism))
    parts = blocks.coalesce(max(1, min(sizes["n"], max(few, -(-(sizes["numbers"] or 0) * width // PART_BYTES)))))
    a, b = (parts.select(*[F.col(c).alias(f"{side}_{c}") for c in ("length", "first", "nodes", "copies", "vectors")]) for side in "ab")
    return a.hint("shuffle_replicate_nl").join(b, (F.col("a_length") == F.col("b_length")) & (F.col("a_first") <= F.col("b_first"))).drop("a_length", "b_length")


def linked(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, n_links, component_id, kept`` for every row."""
    v = col(vector_col)
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    v, kind = (v, "<f4") if single else (v.cast("array<double>"), "<f8")  # components keep all their digits
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(col(id_col).alias("id"), F.when(usable, F.transform(v, lambda x: x + F.lit(0.0).cast("float" if single else "double"))).alias("v"))
    rows = rows.withColumn("key", _key("v"))
    classes = (
        rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
        .select(F.monotonically_increasing_id().alias("node"), "copies", "least", _key("v").alias("key"), "v")
    )
    many = lambda c: T.ArrayType(classes.schema[c].dataType)
    fields = {
        "length": T.IntegerType(), "first": T.LongType(), "nodes": many("node"), "copies": many("copies"),
        "least": many("least"), "keys": many("key"), "vectors": T.BinaryType(),
    }
    blocks = stored(
        classes.mapInArrow(functools.partial(_packed, kind), T.StructType([T.StructField(n, t) for n, t in fields.items()])), "blocks"
    )
    found = stored(_pairs(blocks, 4 if single else 8).mapInArrow(functools.partial(_tiles, kind), "node long, near long, links long"), "links")
    joined = components(found.select("node", "near"), "node", "near")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    distinct = blocks.select(F.explode(F.arrays_zip("nodes", "copies", "least", "keys")).alias("c")).select(
        F.col("c.nodes").alias("node"), "c.copies", "c.least", F.col("c.keys").alias("key")
    )
    named = distinct.join(joined, "node", "left").join(degree, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(
        named.join(least, "component").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")), "named"
    )
    return rows.select("id", "key").join(named, "key", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(col(id_col) == F.col("component_id"), F.lit(False)))
