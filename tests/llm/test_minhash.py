"""Near-duplicates against a brute-force version, and the signature's estimate against the exact similarity."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from panelspark.llm import minhash
from panelspark.llm.kernels import U64
from tests.llm.shared import documents, read

WHITE = "\t\n\x0b\x0c\r "


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in WHITE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return tuple(out)


def bag(ws):
    return Counter(ws[i : i + 5] for i in range(max(1, len(ws) - 4))) if ws else Counter()


def brute(rows):
    """Class by row number and links by distinct text, from the exact similarity of all pairs that share a shingle."""
    texts = sorted({words(t) for _, t in rows})
    bags = {t: bag(t) for t in texts}
    holders = defaultdict(list)
    for t in texts:
        for s in bags[t]:
            holders[s].append(t)
    parent, links, done = {t: t for t in texts}, Counter(), set()

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for group in holders.values():
        for a, b in combinations(group, 2):
            if (a, b) not in done:
                done.add((a, b))
                x, y = bags[a], bags[b]
                low = sum((x & y).values())
                if low >= 0.8 * (sum(x.values()) + sum(y.values()) - low):
                    links[a] += 1
                    links[b] += 1
                    parent[root(b)] = root(a)
    least = {}
    for i, t in rows:
        r = root(words(t))
        if i is not None:
            least[r] = min(i, least.get(r, i))
    copies = Counter(words(t) for _, t in rows)
    return sorted((i, least.get(root(words(t))), links[words(t)], copies[words(t)]) for i, t in rows if i is not None)


def found(df):
    return sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in df.collect() if r["doc_id"] is not None)


def test_all_documents_against_brute_force(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(minhash.near_duplicates(docs)) == brute(rows)


@pytest.fixture(scope="module")
def odd_texts():
    base = [f"w{i}" for i in range(100)]
    near = [" ".join(base[:k] + [f"other{k}"] + base[k + 1 :]) for k in range(5, 95, 3)]
    return [" ".join(base), *near, " ".join(base).upper(), None, "", "  \n", "one two", "one\ttwo", "a b c d e", "long " * 30000, "long " * 29000]


def test_odd_texts(spark, odd_texts):
    docs = documents(spark, odd_texts)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = found(minhash.near_duplicates(docs))
    assert got == brute(rows)
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _, _ in got})


def test_repeated_rows_and_null_ids(spark):
    docs = documents(spark, ["a b c d e f"] * 2).union(documents(spark, ["a b c d e f", None, "x y"])).selectExpr(
        "if(text = 'x y', null, doc_id) doc_id", "text"
    )
    got = sorted(map(tuple, minhash.near_duplicates(docs).collect()), key=str)
    assert got == [(0, 0, 0, 3, True), (0, 0, 0, 3, True), (1, 0, 0, 3, False), (1, 1, 0, 1, True), (None, None, 0, 1, False)]
    assert minhash.without_near_duplicates(docs).count() == 3


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.without_near_duplicates(docs).count() == 0


def test_blocks_of_one_cluster_lose_no_link(spark, odd_texts, monkeypatch):
    docs = documents(spark, odd_texts[:32])
    whole = found(minhash.near_duplicates(docs))
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", 4)
    assert found(minhash.near_duplicates(docs)) == whole
    assert {c for _, c, _, _ in whole} == {0}


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    shingles = rng.integers(0, 2**63, 400).astype(U64)
    a, b = rng.integers(0, 40, 400), rng.integers(0, 40, 400)
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    texts = np.repeat([0, 1], 400)
    weights = np.concatenate([a, b])
    some = weights > 0
    m = 4096
    s = minhash.signatures(texts[some], np.tile(shingles, 2)[some], weights[some], 2, m)
    assert abs((s[0] == s[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / m)


def test_signature_does_not_depend_on_the_other_texts_of_a_slice():
    rng = np.random.default_rng(6)
    shingles, weights = rng.integers(0, 2**63, 60000).astype(U64), rng.integers(1, 9, 60000)
    texts = np.repeat(np.arange(3), [59900, 90, 10])
    together = minhash.signatures(texts, shingles, weights, 3)
    alone = minhash.signatures(np.zeros(10, int), shingles[-10:], weights[-10:], 1)
    assert (together[2] == alone[0]).all()
