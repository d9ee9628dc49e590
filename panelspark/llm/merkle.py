"""A Merkle manifest of a dataset, with a proof for every row, by nested-interval labels.

Each group of rows (a source) is a tree: its leaves ascend by key, and while a level has several nodes, every
``FAN`` consecutive ones become their hash. The trees' tops, in order of the group, are the leaves of one more such
tree, whose top is the root. A node carries the interval ``[lo, hi)`` of the leaf ranks it covers. Node and
ancestor meet in a join on (group, bucket of the level) that also demands that one interval contains the other; a
node's siblings are what is left of its parent's interval without its own. Paths to the root are handed down level
by level, so no join key has more than ``FAN`` rows, and a leaf gets its whole path in one join.

A hash covers its inputs one after the other; digests enter as lowercase hex text. A column enters as ``-`` where it
is null, else as its length in UTF-8 bytes, ``:`` and its value.

Ranks come from one exchange by ranges of (group, key, leaf, row number), so a group or a key that holds most rows
spans many tasks. The driver gets the root and the number of levels' end, nothing else that grows.

Defined cases: rows of one key ascend by their leaf's hash, so equal rows are leaves of their own; null keys come
first; a null group is a group of its own and comes first; null, empty and very long texts are hashed like any other;
an empty table has no rows; columns of the input beyond the hashed ones are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.tables import col, sent_if
from panelspark.workspace import stored

FAN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Offsets of ranks are sent to every executor up to so many rows.
BROADCAST_OFFSETS = 200_000
#: A step up: the digests left and right of a node within its parent.
UP = "array<struct<left: string, right: string>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def node_hash(digests: Column) -> Column:
    return F.sha2(joined(digests).cast("binary"), 256)


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``rank``, from 0 within their group; ``order`` must tell any two rows of a group apart.

    One exchange by ranges; a row's place in its sorted partition less that of its group's first row there, and
    the group's rows in earlier partitions, make the rank.
    """
    keys = [F.col(group).asc(), *[F.col(c).asc_nulls_first() for c in order]]
    place = F.monotonically_increasing_id()
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", place), "placed")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    starts = placed.groupBy("_part", F.col(group).alias("_group")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        starts.select("_part", "_group", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "offsets"
    )
    offsets = sent_if(offsets, offsets.count() <= BROADCAST_OFFSETS).withColumnRenamed("_part", "_of")
    return placed.join(offsets, (F.col(group) == F.col("_group")) & (F.col("_part") == F.col("_of"))).select(
        *[c for c in rows.columns], (F.col("_at") + F.col("_shift")).alias("rank")
    )


def grown(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """From ``group, rank, h``: the nodes of each level above the leaves, and the nodes of each level that are a
    group's top. A node is ``group, at, lo, hi, h, children``: its place in the level, its interval, its hash."""
    child = F.struct("lo", "hi", "h")
    level = leaves.select("group", F.col("rank").alias("at"), F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "h")
    levels, tops = [], []
    while True:
        parents = level.groupBy("group", F.floor(F.col("at") / FAN).alias("at")).agg(F.array_sort(F.collect_list(child)).alias("children"))
        made = stored(
            parents.select(
                "group", "at", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
                node_hash(F.col("children.h")).alias("h"), "children",
            ),
            "nodes",
        )
        # a first run of one node is all its group has at this level, so that node is the top
        single = (F.col("at") == 0) & (F.size("children") == 1)
        tops.append(made.filter(single).select("group", F.col("children")[0].alias("top")).select("group", "top.*"))
        more = made.filter(~single)
        if more.isEmpty():
            return levels, tops
        levels.append(more)
        level = more


def siblings(lo: Column, hi: Column) -> Column:
    """What a parent's interval holds beside the child's: the digests before it and those after it."""

    def hashes(test) -> Column:
        return joined(F.transform(F.filter("children", test), lambda s: s["h"]))

    return F.struct(hashes(lambda s: s["hi"] <= lo).alias("left"), hashes(lambda s: s["lo"] >= hi).alias("right"))


def under(nodes: DataFrame, parents: DataFrame, span: int) -> DataFrame:
    """The nodes (``group, lo, hi`` and more) with ``children``, ``up`` and ``top`` of the one among ``parents`` that
    contains each: same bucket of ``span`` leaves, interval within interval. Nodes under none of them are left out."""
    above = parents.select("group", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "children", "up", "top")
    bucket = lambda lo: F.floor(F.col(lo) / span)
    met = nodes.withColumn("_bucket", bucket("lo")).join(above.withColumn("_bucket", bucket("_lo")), ["group", "_bucket"])
    return met.filter("_lo <= lo AND hi <= _hi").drop("_bucket", "_lo", "_hi")


def handed_down(levels: list[DataFrame], tops: list[DataFrame], crown: DataFrame) -> DataFrame:
    """What the leaves hang on: the nodes just above them, and in place of a parent the crown of a leaf that is a top.

    ``crown`` is (group, up, top): the way from a group's top to the root, and that top. Nodes get their parent's
    way with one step more; nodes that are tops get their group's.
    """
    above = None
    for k in range(len(levels), 0, -1):
        parts = [levels[k - 1].join(tops[k].select("group").join(crown, "group"), "group")]
        if above is not None:
            step = F.concat(F.array(siblings(F.col("lo"), F.col("hi"))), "up")
            passed = under(levels[k - 1].withColumnRenamed("children", "own"), above, FAN ** (k + 1))
            parts.append(passed.withColumn("up", step).drop("children").withColumnRenamed("own", "children"))
        columns = ["group", "lo", "hi", "children", "up", "top"]
        above = stored(functools.reduce(DataFrame.unionByName, [p.select(*columns) for p in parts]), "paths")
    none = F.lit(None).cast("array<struct<lo: bigint, hi: bigint, h: string>>")
    lone = tops[0].select("group").join(crown, "group").select(
        "group", F.lit(0).cast("bigint").alias("lo"), F.lit(1).cast("bigint").alias("hi"), none.alias("children"), "up", "top"
    )
    return lone if above is None else above.unionByName(lone)


def ways_up(leaves: DataFrame, levels: list[DataFrame], tops: list[DataFrame], crown: DataFrame) -> DataFrame:
    """The leaves (``group, rank`` and more) with ``up``, their siblings at each level up to the root, and ``top``."""
    placed = leaves.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1)
    met = under(placed, handed_down(levels, tops, crown), FAN)
    step = F.array(siblings(F.col("lo"), F.col("hi")))
    return met.withColumn("up", F.when(F.col("children").isNull(), F.col("up")).otherwise(F.concat(step, "up"))).drop("lo", "hi", "children")


def fold(leaf: Column, up: Column) -> Column:
    """The root that a leaf and its siblings on the way up give."""
    return F.aggregate(up, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]).cast("binary"), 256))


def proof(up: Column) -> Column:
    """All siblings' digests, level by level from the leaf to the root, left to right."""
    return joined(F.transform(up, lambda s: F.concat(s["left"], s["right"])))


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    key_col: str = "doc_id",
    group_col: str = "source",
    others: dict[str, tuple[dict[str, Column], Column]] | None = None,
) -> DataFrame:
    """``key_col, leaf, subroot, root, up`` for every row; ``up`` holds the siblings' digests, step by step.

    ``others`` adds leaves of the same row to be held against the proof: name -> (columns that change, where).
    Elsewhere such a leaf is the row's own.
    """
    group = F.coalesce(F.concat(F.lit("="), col(group_col).cast("string")), F.lit(""))
    more = {
        name: F.when(where, row_hash([changed.get(c, col(c)) for c in columns])) for name, (changed, where) in (others or {}).items()
    }
    leaves = docs.select(
        col(key_col).alias("key"), group.alias("group"), row_hash([col(c) for c in columns]).alias("h"),
        F.monotonically_increasing_id().alias("row"), F.array(*more.values()).cast("array<string>").alias("others"),
    )
    leaves = stored(ranked(stored(leaves, "leaves"), "group", ["key", "h", "row"]).drop("row"), "ranked")
    levels, tops = grown(leaves)
    subroots = functools.reduce(DataFrame.unionByName, [t.select("group", "h") for t in tops])
    subroots = stored(subroots.select(F.lit("").alias("group"), F.col("group").alias("of"), "h"), "subroots")
    subroots = stored(ranked(subroots, "group", ["of"]), "subroots-ranked")
    high, highest = grown(subroots)
    root = highest[-1].first()
    root = F.lit(root["h"] if root else None).cast("string")
    above_all = docs.sparkSession.range(1).select(F.lit("").alias("group"), F.array().cast(UP).alias("up"), root.alias("top"))
    crown = stored(ways_up(subroots, high, highest, above_all).select(F.col("of").alias("group"), "up", F.col("h").alias("top")), "crown")
    return ways_up(leaves, levels, tops, crown).select(
        F.col("key").alias(key_col), F.col("h").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), "up",
        *[F.coalesce(F.get("others", F.lit(i)), "h").alias(name) for i, name in enumerate(more)],
    )
