"""Classes of words that are seen too seldom to be moved by sweeps."""

import pickle
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from panelspark.llm import brown
from tests.llm.shared import documents


def hashed(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(brown.Words(raw, np.array([0, len(raw)])).hashes.view(np.int64)[0])


def test_every_training_word_has_a_class(spark, monkeypatch):
    monkeypatch.setattr(brown, "SEEDS", 20)
    monkeypatch.setattr(brown, "FREQUENT", 150)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    lines = [" ".join(rng.choices(words[i % 3 :: 3], weights=[1 / (k + 2) for k in range(300)], k=rng.randint(0, 60))) for i in range(150)]
    texts = documents(spark, lines).select("text").repartition(4)
    model, late = brown.fit(texts)
    table = {r["word"]: r for r in late.collect()}
    seen = Counter(w for t in lines for w in t.split())
    rarer = {w for w, n in seen.items() if n < brown.LEAST}
    assert {hashed(w): seen[w] for w in rarer} == {w: r["n"] for w, r in table.items()} and len(rarer) > 300
    assert 0 < sum(r["sent"] for r in table.values()) < len(table)

    place = {int(w): int(p) for w, p in zip(model.lexicon.words.view(np.int64), model.lexicon.places)}
    of = {w: table[hashed(w)]["class"] + brown.KINDS if w in rarer else int(model.of[place[hashed(w)]]) for w in seen}
    plain = {w: brown.CLASSES if w in rarer else of[w] for w in seen}
    g, pairs, places = np.zeros((brown.KINDS, brown.KINDS)), np.zeros((brown.ALL, brown.ALL)), defaultdict(list)
    end = brown.CLASSES + 1
    for line in lines:
        tokens = line.split()
        for kinds, total in ((plain, g), (of, pairs)):
            run = [end, *(kinds[w] for w in tokens), end]
            np.add.at(total, (run[:-1], run[1:]), 1)
        run = [end, *(plain[w] for w in tokens), end]
        for i, w in enumerate(tokens):
            places[w].append((run[i], run[i + 2]))
    _, counted = brown.late_words(texts, model.lexicon, model.of, g)
    assert np.array_equal(counted, pairs)
    share, after = brown._smoothed(g, np.full(brown.KINDS, 0.5))
    for w in rarer:
        gain = [sum(np.log(after[b, k] / share[k]) + np.log(after[k, a]) for b, a in places[w]) for k in range(brown.CLASSES)]
        assert gain[of[w] - brown.KINDS] >= max(gain) - 1e-6
    assert len({of[w] for w in rarer}) > 5

    # after any class all words, with those never seen as one, are a distribution
    within = np.zeros(brown.ALL)
    for w, n in seen.items():
        within[of[w]] += (n - model.discount) / model.late[of[w] - brown.KINDS] if w in rarer else 10 ** model.log_in[place[hashed(w)]]
    assert np.allclose(within[: brown.CLASSES][within[: brown.CLASSES] > 0], 1)
    within[: brown.KINDS] = 1  # a class without words has a small share, as does the end
    assert np.allclose((10**model.log_next) @ within, 1)


def test_scores_of_runs_of_late_words(spark, monkeypatch):
    monkeypatch.setattr(brown, "SEEDS", 5)
    monkeypatch.setattr(brown, "FREQUENT", 6)
    lines = ["a b c " * 30, "x y z", "x y a q", "", None, "b x y z c", "z"]
    docs = documents(spark, lines)
    model, late = brown.fit(docs.select("text"))
    table = {r["word"]: r for r in late.collect()}
    place = {int(w): int(p) for w, p in zip(model.lexicon.words.view(np.int64), model.lexicon.places)}
    tests = [*lines, "new x new new z", "y never"]
    got = {r["doc_id"]: r["score"] for r in brown.score(documents(spark, tests), model, late, keep=["doc_id"]).collect()}
    for i, t in enumerate(tests):
        before, score = brown.CLASSES + 1, 0.0
        for w in [*(t or "").split(), None]:
            if w is None:
                kind, inner = brown.CLASSES + 1, 0.0
            elif hashed(w) in table:
                r = table[hashed(w)]
                kind, inner = brown.KINDS + r["class"], np.log10((r["n"] - model.discount) / model.late[r["class"]])
            elif hashed(w) in place:
                kind, inner = int(model.of[place[hashed(w)]]), model.log_in[place[hashed(w)]]
            else:
                kind, inner = brown.CLASSES, 0.0
            score += model.log_next[before, kind] + inner
            before = kind
        assert abs(got[i] - score) < 1e-9


def test_neighbours_are_so_many_rows_whatever_the_words():
    n = 300 * brown.BLOCKS + 7
    rng = np.random.default_rng(1)
    of = np.append(rng.integers(0, brown.CLASSES, n), [brown.CLASSES, brown.CLASSES + 1])
    movable = rng.random(n) < 0.7
    symbol = np.append(np.repeat(rng.permutation(n), 2), n + 1)
    rows = list(brown._beside(of, movable, iter([pa.RecordBatch.from_arrays([pa.array([symbol.astype("<i4").tobytes()])], names=["symbols"])])))
    assert 0 < sum(r.num_rows for r in rows) <= brown.BLOCKS
    counts = np.zeros((brown.BLOCKS, -(-n // brown.BLOCKS), brown.WIDTH), np.int64)
    for block, inner, many in zip(*(rows[0].column(c).to_pylist() for c in range(3))):
        counts[block].ravel()[np.frombuffer(inner, "<i4")] = np.frombuffer(many, "<i8")
    expected = np.zeros((n, brown.WIDTH), np.int64)
    before = np.append(n + 1, symbol[:-1])
    for at, beside in ((before, of[symbol]), (symbol, brown.KINDS + of[before])):
        np.add.at(expected, (at[at < n], beside[at < n]), 1)
    expected[symbol[(symbol == before) & (symbol < n)], 2 * brown.KINDS] = 1
    expected[~movable] = 0
    word = np.arange(n)
    assert np.array_equal(counts[word % brown.BLOCKS, word // brown.BLOCKS], expected)
    assert counts.sum() == expected.sum()


def test_gains_of_many_words_are_those_of_each():
    rng = np.random.default_rng(2)
    of = np.append(rng.integers(0, brown.CLASSES + 1, 300), [brown.CLASSES, brown.CLASSES + 1])
    symbol = np.append(np.minimum(rng.zipf(1.3, 5000), 302) - 1, 301)
    before = brown._before(symbol, 301)
    pairs = np.zeros((302, 302))
    np.add.at(pairs, (before, symbol), 1)
    member = np.eye(brown.KINDS)[of]
    g, self_pair, was = member.T @ pairs @ member, np.diagonal(pairs)[:300], of[:300]
    right, left = (pairs @ member)[:300], (pairs.T @ member)[:300]
    right[np.arange(300), was] -= self_pair
    left[np.arange(300), was] -= self_pair
    got = brown._many_gains(g, was, right, left, self_pair)
    for w in range(300):
        without = brown._without(g, was[w], right[w], left[w], self_pair[w])
        assert np.allclose(got[w], brown._gains(without, right[w], left[w], self_pair[w])[: brown.CLASSES], atol=1e-9)


def test_words_with_the_same_first_bits_are_found():
    words = np.sort(np.concatenate([np.arange(40, dtype=np.uint64) * 3, [2**63, 2**64 - 1]]).astype(np.uint64))
    lexicon = brown.Lexicon(words, np.ones(42, np.int64), np.arange(42), 0)
    asked = np.array([0, 1, 3, 117, 118, 2**62, 2**63, 2**63 + 1, 2**64 - 1], np.uint64)
    at, there = lexicon.find(asked)
    assert there.tolist() == [True, False, True, True, False, False, True, False, True] and np.array_equal(words[at[there]], asked[there])
    sent = pickle.dumps(lexicon)
    assert len(sent) == len(pickle.dumps(brown.Lexicon(words, lexicon.counts, lexicon.places, 0)))
    assert np.array_equal(pickle.loads(sent).find(asked)[1], there)
