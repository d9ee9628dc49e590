"""Exact top-k search against all inner products."""

import numpy as np
import pytest

from panelspark.llm import balls, queries, twins
from workload.check import differences, duck


def by_hand(rows, every, k=balls.K):
    out = []
    for q in rows:
        if q[0] % every == 0:
            scored = sorted((-int(np.dot(q[1], c[1])), c[0]) for c in rows if c[0] != q[0])[:k]
            out += [(q[0], i + 1, name, -s) for i, (s, name) in enumerate(scored)]
    return sorted(out)


def whole(rows):
    return [(i, np.floor(np.array(v, float) * 256).astype(np.int64)) for i, v in rows]


@pytest.mark.parametrize("spread, n", [(2, 700), (1000, 700), (2**24, 300), (1, 40)])
def test_one_tree(spread, n):
    rng = np.random.default_rng(n + spread)
    v = rng.integers(-spread, spread + 1, (n, 5))
    v[: n // 3] = v[0]
    ids = rng.permutation(n * 2)[:n]
    order, tree = balls.ball_tree(v, ids)
    leaves = sorted((tree["lo"][i], tree["hi"][i]) for i in np.flatnonzero(tree["left"] < 0))
    assert [a for a, _ in leaves] + [n] == [0] + [b for _, b in leaves]
    q = rng.integers(-spread, spread + 1, (50, 5))
    top = balls.bounds(q, tree["centre"], tree["radius"])
    for node, (a, b) in enumerate(zip(tree["lo"], tree["hi"])):
        assert (top[:, node] >= (q @ v[order[a:b]].T).max(1)).all()
    best = balls.Best(np.full(50, balls.NONE), np.full(50, balls.NO_ID))
    balls.search(q, np.full(50, -1), tree, v[order], ids[order], best)
    for i in range(50):
        want = sorted((-int(s), int(d)) for s, d in zip(q[i] @ v.T, ids))[: balls.K]
        assert [(-int(s), int(d)) for s, d in zip(best.score[i], best.id[i])] == want


def test_clusters_are_passed_over():
    rng = np.random.default_rng(1)
    v = (rng.integers(-900, 900, (40, 1, 8)) + rng.integers(-9, 9, (40, 100, 8))).reshape(-1, 8)
    ids = np.arange(len(v))
    order, tree = balls.ball_tree(v, ids)
    best = balls.Best(np.full(100, balls.NONE), np.full(100, balls.NO_ID))
    assert balls.search(v[::40], ids[::40], tree, v[order], ids[order], best) < 0.3 * 100 * len(v)


def test_odd_vectors_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(balls, "SHARD", 60)
    monkeypatch.setattr(balls, "BLOCK", 8)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).round(2).tolist()) for i in range(500)]
    rows += [(500 + i, [0.5, 0.5, 0.5, 0.25, 0.0, -1.0]) for i in range(250)] + rows[:3] + [rows[10]] * 2
    left_out = [(-10, None), (-20, [float("nan")] * 6), (-30, [float("inf")] * 6), (-40, [None] * 6), (10, [1.0] * 4), (20, []), (30, [1e200] * 6), (None, [1.0] * 6)]
    names = "vec_id long, embedding array<double>, score string, Rank string"
    df = spark.createDataFrame([(*r, "s", "r") for r in rows + left_out], names)
    assert sorted(map(tuple, balls.top_products(df, 10).collect())) == by_hand(whole(rows), 10)


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 2.0]), (3, [0.5, 0.0]), (10, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, balls.top_products(df, 10).collect())) == by_hand(whole(rows), 10)
    assert balls.top_products(df.limit(0), 10).count() == 0
    assert balls.top_products(df.limit(1), 10).count() == 0


def test_the_query_equals_its_sql(spark):
    name, sf = "op11_ball_trees", "/root/testdata/sf0.001"
    assert differences(queries.QUERIES[name](spark, sf), duck(sf), twins.OP11) == []
