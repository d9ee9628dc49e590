"""The manifest against a tree built by hand, on odd tables."""

import hashlib
import random

from pyspark.sql import functions as F

from panelspark.llm import merkle, queries, twins
from tests.llm.shared import DOCS, documents
from workload.check import differences, duck


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return h(*[field(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)])


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16 :][:16]
        out.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        i //= 16
    return out


def by_hand(rows):
    """Sorted (leaf, subroot, root, proof, root folded from the changed leaf)."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = grow([leaf(r, r["text"]) for r in groups[s]])
    crown = grow([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            up = way(trees[s], i) + way(crown, k)
            folded = leaf(r, None if r["text"] is None else r["text"].lower())
            for left, right in up:
                folded = h(left, folded, right)
            out.append((trees[s][0][i], trees[s][-1][0], crown[-1][0], h(*[x for step in up for x in step]), folded))
    return sorted(out)


def of_spark(df):
    found = merkle.manifest(df, others={"other": ({"text": F.lower("text")}, F.lit(True))})
    shown = found.select("leaf", "subroot", "root", F.sha2(merkle.proof(F.col("up")), 256), merkle.fold(F.col("other"), F.col("up")))
    return sorted(map(tuple, shown.collect()))


def test_odd_rows(spark):
    texts = [None, "", "Abé\U0001f600", "x" * 200_000, "same", "same", "SAME"]
    rows = [(i % 5 if i else None, t, None, s, None, "x", "y") for i, t in enumerate(texts) for s in (None, "", "é", "z", "Z")]
    df = spark.createDataFrame(rows + rows[:3], DOCS)
    assert of_spark(df) == by_hand(df.collect())


def test_depths_of_trees(spark):
    """Lone leaves, full and partial runs, runs of one, three levels, and more sources than one run holds."""
    rng = random.Random(4)
    sizes = [1, 2, 15, 16, 17, 32, 33, 255, 256, 257, 300, *[rng.randint(1, 20) for _ in range(30)]]
    rows = [(rng.randint(-50, 400), f"T{rng.randint(0, 99)}", "en", f"s{k}", n, "x", "y") for k, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert of_spark(df) == by_hand(df.collect())


def test_one_source_one_row_and_none(spark):
    for n in (0, 1, 17):
        df = documents(spark, ["a"] * n) if n else documents(spark, ["a"]).limit(0)
        assert of_spark(df) == by_hand(df.collect())


def test_a_hot_key_spans_tasks_of_the_ranking(spark):
    rows = spark.range(4000).selectExpr("'g' g", "if(id % 3 = 0, 7L, id) k", "id row")
    found = merkle.ranked(rows, "g", ["k", "row"])
    want = sorted(((7 if i % 3 == 0 else i), i) for i in range(4000))
    assert [r["rank"] for r in found.orderBy("k", "row").collect()] == list(range(4000))
    assert [tuple(r) for r in found.orderBy("rank").select("k", "row").collect()] == want


def test_the_query_equals_its_sql(spark):
    name, sf = "op13_merkle_intervals", "/root/testdata/sf0.001"
    assert differences(queries.QUERIES[name](spark, sf), duck(sf), twins.OP13) == []
