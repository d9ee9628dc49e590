"""Vector codes against plain nearest entries."""

import numpy as np
import pytest

from panelspark.llm import gnat, queries, twins
from workload.check import differences, duck


def plain(q, entries):
    far = ((q[:, None, :] - entries[None]) ** 2).sum(2)
    return far.argmin(1), far.min(1)


@pytest.mark.parametrize("spread, size, copies", [(1, 256, 0), (3, 256, 100), (1000, 300, 20), (2**25, 256, 10), (5, 7, 3), (5, 1, 0)])
def test_nearest_with_ties_and_copies(spread, size, copies):
    rng = np.random.default_rng(size + spread)
    entries = rng.integers(-spread, spread + 1, (size, 6))
    entries = np.concatenate([entries, entries[:copies]])[rng.permutation(size + copies)]
    q = np.concatenate([rng.integers(-spread, spread + 1, (500, 6)), entries])
    names, far = gnat.nearest(q, gnat.tree(entries), block=200)
    want = plain(q, entries)
    assert (names == want[0]).all() and (far == want[1]).all()


def test_subtrees_are_eliminated_where_entries_cluster():
    rng = np.random.default_rng(3)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    entries = (centres[:, None] + rng.integers(-50, 50, (16, 16, 8))).reshape(-1, 8)
    search = gnat.Search(entries[rng.integers(0, 256, 1000)] + rng.integers(-9, 9, (1000, 8)))
    search.visit(gnat.tree(entries), np.arange(1000))
    assert (search.name == plain(search.queries, entries)[0]).all()
    assert search.compared < 0.3 * 1000 * 256


def by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in rows]) * 1024).astype(np.int64).reshape(len(rows), 4, -1)
    books = x[:256].transpose(1, 0, 2).copy()
    for _ in range(4):
        for p in range(4):
            names = plain(x[:, p], books[p])[0]
            for k in set(names.tolist()):
                own = x[names == k, p]
                books[p, k] = own.sum(0) // len(own)
    found = [plain(x[:, p], books[p]) for p in range(4)]
    error = sum(f[1] for f in found)
    labels = {}
    for r, e in zip(rows, error):
        labels[r[2]] = labels.get(r[2], 0) + int(e)
    key = lambda t: (t[0] is None, t)
    return sorted(((r[0], "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), labels[r[2]]) for i, r in enumerate(rows)), key=key), gnat.digest(books)


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    some = [(i, rng.standard_normal(8).round(2).tolist(), None if i % 7 == 0 else i % 3) for i in range(400)]
    same = [(1000 + i, [0.5] * 8, 1) for i in range(300)] + some[:4] + [(None, [0.25] * 8, None)]
    left_out = [(-1, None, 1), (-2, [float("nan")] * 8, 1), (-3, [float("inf")] * 8, 1), (-4, [None] * 8, 1), (2, [1.0] * 4, 1), (3, [], 1), (4, [1e200] * 8, 1)]
    names = "vec_id long, embedding array<double>, label int, code string, Error_ string"
    df = spark.createDataFrame([(*r, "c", "e") for r in some + same + left_out], names)
    found, books = gnat.coded(df)
    rows = sorted(map(tuple, found.collect()), key=lambda t: (t[0] is None, t))
    assert (rows, gnat.digest(books)) == by_hand(some + same)


def test_few_vectors_and_none(spark):
    df = spark.createDataFrame([(2, [0.5, 1.5, -0.5, 2.0], 1), (9, [0.25, 1.0, -0.75, 2.0], None)], "vec_id long, embedding array<float>, label int")
    found, books = gnat.coded(df)
    assert sorted(map(tuple, found.collect())) == by_hand([tuple(r) for r in df.collect()])[0] and books.shape == (4, 2, 1)
    assert gnat.coded(df.limit(0))[0].count() == 0


def test_the_query_equals_its_sql(spark):
    name, sf = "op12_gnat_codes", "/root/testdata/sf0.001"
    assert differences(queries.QUERIES[name](spark, sf), duck(sf), twins.OP12) == []
