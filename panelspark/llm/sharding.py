"""Sharding by histogram sort: shards of near-equal bytes that follow each other in the order of the key.

The key is the id, then the row's number in the written table, so no key occurs twice and a repeated id can be
split. Each round counts the exact bytes below some candidate keys, in one pass over key and size; a boundary
that isn't yet within its tolerance gets new candidates between the nearest keys on both sides. When all are
settled, rows move once, to the pieces of the shards, where they are sorted and numbered.

The driver holds at most ``PROBES`` counts a round. Defined cases: null ids come first; null and empty texts have
size 1; repeated rows are rows of their own; with fewer rows than shards, some shards stay empty; a text larger
than the tolerance goes to the side that leaves the boundary nearer to its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.tables import col, fresh
from panelspark.workspace import stored

SHARDS, PIECES, PROBES = 8, 8, 400
#: How far, as a share of a shard (of a piece), the bytes before a boundary may be from its target.
TOLERANCE, LOOSE = 0.0005, 0.2
_ROWS = 10**19


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def interval(key: Column, bounds: Sequence[int]) -> Column:
    """How many bounds are at most the key: a binary search as nested conditions."""

    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(str(bounds[mid])).cast("decimal(38,0)"), between(lo, mid)).otherwise(between(mid + 1, hi))

    return between(0, len(bounds))


def boundaries(keyed: DataFrame, key: str, size: str, targets: Sequence[tuple[float, float]]) -> list[int]:
    """For each target (bytes, tolerance) a key below which about so many bytes lie; ``keyed`` is a written table."""
    ends = keyed.agg(F.min(key), F.max(key), F.sum(size)).first()
    if ends[0] is None:
        return [0] * len(targets)
    known = {int(ends[0]): 0, int(ends[1]) + 1: int(ends[2])}
    while True:
        keys = sorted(known)
        gaps: dict[tuple[int, int], None] = {}
        chosen = []
        for bytes_before, tolerance in targets:
            above = next(k for k in keys if known[k] >= bytes_before)
            below = max((k for k in keys if k < above), default=above)
            best = min((above, below), key=lambda k: (abs(known[k] - bytes_before), k))
            chosen.append(best)
            if abs(known[best] - bytes_before) > tolerance and above - below > 1:
                gaps[below, above] = None
        if not gaps:
            return chosen
        each = max(1, PROBES // len(gaps))
        probes = sorted({lo + (hi - lo) * i // (each + 1) for lo, hi in gaps for i in range(1, each + 1)} - known.keys())
        counts = keyed.groupBy(interval(col(key), probes).alias("at")).agg(F.sum(size).alias("bytes")).collect()
        found = {r["at"]: r["bytes"] for r in counts}
        below = 0
        for i, probe in enumerate(probes):
            below += found.get(i, 0)
            known[probe] = below


def sharded(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, pieces: int = PIECES) -> DataFrame:
    """The rows, or the columns to keep of them, with ``size, shard, slot``: the place within the shard, from 0."""
    kept = docs.columns if keep is None else keep
    size, shard, slot, row, key, piece = fresh(kept, "size", "shard", "slot", "_row", "_key", "_piece")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    place = F.coalesce(col(id_col), F.lit(-(2**63))).cast("decimal(19,0)") * F.lit(str(_ROWS)).cast("decimal(20,0)")
    keyed = stored(
        numbered.select(
            *[col(c) for c in kept], size_of(col(text_col)).alias(size), (place + col(row).cast("decimal(19,0)")).cast("decimal(38,0)").alias(key)
        ),
        "keyed",
    )
    total = keyed.agg(F.sum(size)).first()[0] or 0
    parts = shards * pieces
    targets = [
        (total * k / parts, total / parts * LOOSE if k % pieces else total / shards * TOLERANCE) for k in range(1, parts)
    ]
    bounds = boundaries(keyed, key, size, targets)
    for i in range(1, len(bounds)):
        bounds[i] = max(bounds[i], bounds[i - 1])
    placed = keyed.withColumn(piece, interval(col(key), bounds))
    counts = {r[0]: r[1] for r in placed.groupBy(piece).count().collect()}
    before = [sum(counts.get(p, 0) for p in range(k // pieces * pieces, k)) for k in range(parts)]
    nth = F.row_number().over(Window.partitionBy(piece).orderBy(key)).cast("long") - 1
    return placed.select(
        *[col(c) for c in kept], size, F.floor(col(piece) / pieces).cast("int").alias(shard),
        (nth + F.get(F.array(*[F.lit(b).cast("long") for b in before]), col(piece))).alias(slot),
    )
