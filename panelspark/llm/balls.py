"""Exact top-k inner products by branch and bound in ball trees, one tree per shard.

Vectors are whole numbers. Shards hold about ``SHARD`` vectors each: a vector goes to its nearest of a few pivots, and
a pivot's vectors are dealt by a hash of the row over as many shards as it takes, so that a vector that occurs very
often fills many shards and not one task. A ball tree halves a shard along the axis between two far vectors until
leaves are small; a node keeps the centre and radius of its vectors and their smallest id.

No vector of a ball has a larger inner product with q than q.centre + |q| radius, rounded up. A query follows the
highest bound to a first leaf, then takes nodes in the order of their bound and leaves out those whose bound is below
its k-th score so far, or equal to it with no smaller id in the node. Queries go in blocks: first to a shard of their own pivot, which gives a k-th score; this score goes with them
to all other shards, and shards whose bound can't reach it are not visited.

The pivots come from at most ``SAMPLE`` vectors, those of the smallest hash; they say where a vector is stored and
never what is found. The driver holds pivots and one line per pivot.

Defined cases: see ``whole_vectors`` for vectors that take no part; rows without an id take no part either; repeated
rows are candidates each, rows of the query's own id are no candidates, and a query that is there twice gets its rows
twice; ties go to the smaller id; with fewer candidates than k a query gets all; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.integer_vectors import whole_vectors
from panelspark.workspace import stored

K, SCALE = 5, 256
SHARD, BLOCK, SAMPLE, PIVOTS, LEAF = 4096, 512, 2048, 64, 64
#: Far more than the rounding of the doubles in a bound, as a share of its terms.
_SLACK = 1e-11
#: Scores are above this; it stands for no score yet.
NONE = -(2**63) + 1
NO_ID = 2**63 - 1


def far_apart(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` vectors of the sample, each the farthest from those before it."""
    chosen = [0]
    near = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def ball_tree(v: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The order of the vectors in the tree, and its nodes: the places they cover (``lo``, ``hi``), ``left`` and
    ``right`` child (-1: leaf), ``centre``, ``radius``, ``least`` id."""
    order = np.arange(len(v))
    lo, hi, left, right = [0], [len(v)], [-1], [-1]
    node = -1
    while (node := node + 1) < len(lo):
        own = order[lo[node] : hi[node]]
        if len(own) <= LEAF:
            continue
        x = v[own].astype(float)
        a = x[np.linalg.norm(x - x.mean(0), axis=1).argmax()]
        b = x[np.linalg.norm(x - a, axis=1).argmax()]
        order[lo[node] : hi[node]] = own[np.argsort(x @ (b - a), kind="stable")]
        half = (lo[node] + hi[node]) // 2
        left[node], right[node] = len(lo), len(lo) + 1
        lo += [lo[node], half]
        hi += [half, hi[node]]
        left += [-1, -1]
        right += [-1, -1]
    spans = [order[a:b] for a, b in zip(lo, hi)]
    centre = np.stack([v[s].astype(float).mean(0) for s in spans])
    radius = np.array([np.linalg.norm(v[s] - c, axis=1).max() for s, c in zip(spans, centre)])
    slack = _SLACK * (np.abs(v).max(initial=0) * v.shape[1] ** 0.5 + 1)
    return order, {
        "lo": np.array(lo), "hi": np.array(hi), "left": np.array(left), "right": np.array(right), "centre": centre,
        "radius": radius + slack, "least": np.array([ids[s].min() for s in spans]),
    }


def bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For every query and ball a number no inner product exceeds."""
    q = q.astype(float)
    size, far = np.linalg.norm(q, axis=1)[:, None], np.linalg.norm(centre, axis=1)[None, :]
    return q @ centre.T + size * radius + _SLACK * (size * (far + radius) + 1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in whole numbers; by doubles where these hold every sum exactly."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) of every query so far, and the pair that a further one has to beat."""

    def __init__(self, kth_score: np.ndarray, kth_id: np.ndarray, k: int = K):
        self.score, self.id = np.full((len(kth_score), k), NONE), np.full((len(kth_score), k), NO_ID)
        self.kth_score, self.kth_id = kth_score.copy(), kth_id.copy()

    def take(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        some = (score >= self.kth_score[rows, None]).any(1)
        rows, score, ids = rows[some], score[some], ids[some]
        s, i = np.concatenate([self.score[rows], score], 1), np.concatenate([self.id[rows], ids], 1)
        first = np.lexsort((i, -s))[:, : self.score.shape[1]]
        s, i = np.take_along_axis(s, first, 1), np.take_along_axis(i, first, 1)
        self.score[rows], self.id[rows] = s, i
        better = (s[:, -1] > self.kth_score[rows]) | ((s[:, -1] == self.kth_score[rows]) & (i[:, -1] < self.kth_id[rows]))
        self.kth_score[rows[better]], self.kth_id[rows[better]] = s[better, -1], i[better, -1]

    def reached(self, rows: np.ndarray, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        kth = self.kth_score[rows]
        top = np.floor(bound)
        return (top > kth) | ((top >= kth) & (least < self.kth_id[rows]))


def search(q: np.ndarray, own: np.ndarray, tree: dict[str, np.ndarray], v: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Branch and bound through one shard, all queries side by side. Gives the number of inner products.

    Each query first goes down to a leaf, always to the child of the higher bound. Then nodes are opened from the
    root on where their bound still reaches the query's k-th score, and the leaves that stay are taken in the order
    of their highest bound, each by the queries that it can still serve by then.
    """
    bound, every = bounds(q, tree["centre"], tree["radius"]), np.arange(len(q))
    left, right, least = tree["left"], tree["right"], tree["least"]
    nodes, done = np.flatnonzero(left >= 0), 0
    for node in nodes:  # parents come before their children
        for child in (left[node], right[node]):
            np.minimum(bound[:, child], bound[:, node], out=bound[:, child])

    def scan(leaf: int, who: np.ndarray) -> int:
        span = slice(tree["lo"][leaf], tree["hi"][leaf])
        score, names = products(q[who], v[span]), np.broadcast_to(ids[span], (len(who), tree["hi"][leaf] - tree["lo"][leaf]))
        mine = names == own[who][:, None]
        best.take(who, np.where(mine, NONE, score), np.where(mine, NO_ID, names))
        return score.size

    at = np.zeros(len(q), np.int64)
    while (left[at] >= 0).any():
        better = np.where(bound[every, left[at]] >= bound[every, right[at]], left[at], right[at])
        at = np.where(left[at] >= 0, better, at)
    for leaf in np.unique(at):
        who = np.flatnonzero(at == leaf)
        done += scan(leaf, who[best.reached(who, bound[who, leaf], least[leaf])])
    is_open = np.ones(bound.shape, bool)
    for node in nodes:
        on = is_open[:, node] & best.reached(every, bound[:, node], least[node])
        is_open[:, left[node]] = is_open[:, right[node]] = on
    is_open[every, at] = False
    leaves = np.flatnonzero((left < 0) & is_open.any(0))
    for leaf in leaves[np.argsort(-np.where(is_open, bound, -np.inf)[:, leaves].max(0), kind="stable")]:
        who = np.flatnonzero(is_open[:, leaf])
        who = who[best.reached(who, bound[who, leaf], least[leaf])]
        if len(who):
            done += scan(leaf, who)
    return done


_TREE = {"lo": "<i8", "hi": "<i8", "left": "<i8", "right": "<i8", "centre": "<f8", "radius": "<f8", "least": "<i8"}


def _one_row(key: tuple, parts: list[np.ndarray], columns: list[str]) -> pa.Table:
    values = [*[pa.array([k.as_py()], k.type) for k in key], *[pa.array([p.tobytes()], pa.binary()) for p in parts]]
    return pa.table(values, names=columns)


def _packed_tree(key: tuple, rows: pa.Table, columns: list[str]) -> pa.Table:
    ids = rows.column("id").to_numpy()
    v = rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    order, tree = ball_tree(v, ids)
    parts = [ids[order].astype("<i8"), v[order].astype("<i8"), *[tree[n].astype(t) for n, t in _TREE.items()]]
    return _one_row(key, parts, columns)


def _packed_block(key: tuple, rows: pa.Table, columns: list[str]) -> pa.Table:
    v = rows.column("v").combine_chunks().flatten().to_numpy().astype("<i8")
    parts = [rows.column(c).to_numpy().astype("<i8") for c in ("row", "id", "kth_score", "kth_id")]
    return _one_row(key, [*parts, v], columns)


def _tiles(k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block through the tree it meets: what it finds there that is among a query's k best so far."""
    for batch in batches:
        for t in batch.to_pylist():
            row, own, kth_score, kth_id = (np.frombuffer(t[c], "<i8") for c in ("q_row", "q_id", "q_kth_score", "q_kth_id"))
            ids, v = np.frombuffer(t["ids"], "<i8"), np.frombuffer(t["v"], "<i8")
            tree = {n: np.frombuffer(t[n], kind) for n, kind in _TREE.items()}
            tree["centre"] = tree["centre"].reshape(len(tree["lo"]), -1)
            best = Best(kth_score, kth_id, k)
            search(np.frombuffer(t["q_v"], "<i8").reshape(len(row), -1), own, tree, v.reshape(len(ids), -1), ids, best)
            kept = (best.id != NO_ID) & (
                (best.score > kth_score[:, None]) | ((best.score == kth_score[:, None]) & (best.id <= kth_id[:, None]))
            )
            i, j = np.nonzero(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[i]), pa.array(own[i]), pa.array(best.id[i, j]), pa.array(best.score[i, j])],
                names=["row", "query_id", "vec_id", "score"],
            )


def _assigned(pivots: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = (pivots * pivots).sum(1)
    for batch in batches:
        v = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy().reshape(batch.num_rows, -1).astype(float)
        cell = (size[None, :] - 2 * v @ pivots.T).argmin(1)
        far = np.linalg.norm(v - pivots[cell], axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], names=[*batch.schema.names, "cell", "far"])


def _reachable(pivots: np.ndarray, radius: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells in which some query of the block may find a score that is as good as its k-th."""
    for batch in batches:
        cells = []
        for t in batch.select(["q_v", "q_kth_score"]).to_pylist():
            kth = np.frombuffer(t["q_kth_score"], "<i8")
            top = np.floor(bounds(np.frombuffer(t["q_v"], "<i8").reshape(len(kth), -1), pivots, radius))
            cells.append(np.flatnonzero((top >= kth[:, None]).any(0)).tolist())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])


def _dealt(groups: int | Column) -> Column:
    return F.pmod(F.xxhash64("row"), groups).cast("int")


def blocks_of(queries: DataFrame, many: DataFrame) -> DataFrame:
    """Queries of one pivot in blocks of about ``BLOCK``; ``many`` says how many blocks a pivot has."""
    columns = ["cell", "block", "q_row", "q_id", "q_kth_score", "q_kth_id", "q_v"]
    dealt = queries.join(F.broadcast(many), "cell").withColumn("block", _dealt(F.col("blocks")))
    return dealt.select("cell", "block", "row", "id", "v", "kth_score", "kth_id").groupBy("cell", "block").applyInArrow(
        lambda key, rows: _packed_block(key, rows, columns), "cell int, block int, " + ", ".join(f"{c} binary" for c in columns[2:])
    )


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; each task keeps its own k best before anything moves."""
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_products(vectors: DataFrame, every: int, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for each query, which are the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows, dims = whole_vectors(vectors.filter(F.col(id_col).isNotNull()), SCALE, id_col, vector_col)
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").collect()
    result = "row long, query_id long, vec_id long, score long"
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    wanted = min(PIVOTS, -(-rows.count() // SHARD))
    pivots = far_apart(np.array([r["v"] for r in sample], float), wanted)
    is_query = F.col("id") % every == 0
    assigned = rows.select("id", "v", "row").mapInArrow(functools.partial(_assigned, pivots), "id long, v array<long>, row long, cell int, far double")
    placed = stored(assigned, "placed-vectors")
    blocks = F.ceil(F.count(F.when(is_query, 1)) / BLOCK).cast("int").alias("blocks")
    cells = stored(placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("pieces"), blocks, F.max("far").alias("far")), "cells")
    radius = np.zeros(len(pivots))
    for r in cells.collect():  # one row a pivot
        radius[r["cell"]] = r["far"] * (1 + _SLACK) + _SLACK * np.abs(pivots).max(initial=1)
    columns = ["cell", "piece", "ids", "v", *_TREE]
    dealt = placed.join(F.broadcast(cells), "cell").withColumn("piece", _dealt(F.col("pieces")))
    trees = stored(
        dealt.select("cell", "piece", "id", "v").groupBy("cell", "piece").applyInArrow(
            lambda key, shard: _packed_tree(key, shard, columns), "cell int, piece int, " + ", ".join(f"{c} binary" for c in columns[2:])
        ),
        "ball-trees",
    )
    many, pieces = cells.select("cell", "blocks"), cells.select("cell", "pieces")
    queries = placed.filter(is_query).select("row", "id", "v", "cell")
    work = functools.partial(_tiles, k)
    home = F.pmod(F.col("block"), F.col("pieces"))
    unset = queries.withColumn("kth_score", F.lit(NONE)).withColumn("kth_id", F.lit(NO_ID))
    first = blocks_of(unset, many).join(F.broadcast(pieces), "cell").withColumn("piece", home).drop("block", "pieces")
    near = stored(best_of(first.join(trees, ["cell", "piece"]).mapInArrow(work, result), k), "first-scores")
    kth = near.filter(F.col("rank") == k).select("row", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    known = queries.join(kth, "row", "left").withColumn("kth_score", F.coalesce("kth_score", F.lit(NONE))).withColumn("kth_id", F.coalesce("kth_id", F.lit(NO_ID)))
    again = blocks_of(known, many)
    reach = again.mapInArrow(functools.partial(_reachable, pivots, radius), T.StructType([*again.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))]))
    own = reach.join(F.broadcast(pieces), "cell").withColumn("own", home).withColumnsRenamed({"cell": "own_cell"}).drop("pieces")
    other = own.withColumn("cell", F.explode("cells")).drop("cells").join(F.broadcast(pieces), "cell")
    other = other.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces", "block")
    other = other.filter((F.col("cell") != F.col("own_cell")) | (F.col("piece") != F.col("own"))).drop("own_cell", "own")
    found = other.join(trees, ["cell", "piece"]).mapInArrow(work, result).unionByName(near.drop("rank"))
    return best_of(found, k).select("query_id", "rank", "vec_id", "score")
