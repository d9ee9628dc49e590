"""Decontamination against an alignment of every item at every place."""

import random
import re

from panelspark.llm import decontamination as dec
from tests.llm.shared import documents, read

SEPARATORS = re.compile(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return [w for w in SEPARATORS.split((text or "").lower()) if w]


def best(ws, item, shift):
    now = top = same = 0
    for i, w in enumerate(item):
        equal = 0 <= shift + i < len(ws) and ws[shift + i] == w
        same += equal
        now = max(0, now + (1 if equal else -2))
        top = max(top, now)
    return top, same


def accepted(item, score, same):
    return score >= dec.LEAST or len(item) - same <= (len(item) // 5 if len(item) >= dec.WHOLE else 0)


def brute(rows, items):
    """Every item at every place of every text, without any seed."""
    out = set()
    for d, t in rows:
        ws = words(t)
        for b, x in items:
            item = words(x)
            found = [s for shift in range(-len(item), len(ws) + 1) if item and accepted(item, *(s := best(ws, item, shift)))]
            if found:
                out.add((d, b, *max(found)))
    return out


def test_against_all_alignments(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate((8, 9, 12, 20, 40, 60))]
    rows = []
    for i in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        leak = words(rng.choice(items)[1])
        leak = [rng.choice(vocabulary) if rng.random() < i % 4 * 0.1 else w for w in leak][: rng.randint(5, 60)]
        rows.append((i, "  ".join(text + leak + text[:5]).upper() if i % 2 else ", ".join(leak)))
    rows += [(60, None), (61, ""), (62, "w1 " * 30000), (63, rows[0][1])]
    docs = documents(spark, [t for _, t in rows])
    bench = spark.createDataFrame([*items, (6, None), (7, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["score"], r["n_same"]) for r in dec.leaks(docs, bench).collect()}
    assert got == brute(rows, items)
    kept = dec.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {g[0] for g in got}


def test_fifth_of_words_substituted_is_found(spark):
    items = read(spark, "benchmark").collect()
    rng = random.Random(4)
    texts = []
    for r in items:
        ws = words(r["text"])
        for k in rng.sample(range(len(ws)), len(ws) // 5):
            ws[k] = "other"
        texts.append("before it " * 20 + " ".join(ws) + " and after" * 20)
    found = {(r["doc_id"], r["item_id"]) for r in dec.leaks(documents(spark, texts), read(spark, "benchmark")).collect()}
    assert all((i, r["item_id"]) in found for i, r in enumerate(items))
    assert all(i == list(r["item_id"] for r in items).index(b) for i, b in found)


def test_shuffled_and_sent_test_sides_agree_and_empty_tables(spark, monkeypatch):
    docs, bench = read(spark, "documents", "/root/testdata/sf0.01"), read(spark, "benchmark", "/root/testdata/sf0.01")
    sent = sorted(map(tuple, dec.leaks(docs, bench).collect()))
    monkeypatch.setattr(dec, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, dec.leaks(docs, bench).collect())) == sent and sent
    assert dec.leaks(docs.limit(0), bench).count() == 0
    assert dec.leaks(docs, bench.limit(0)).count() == 0
    assert dec.without_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_null_ids_and_repeated_rows(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (1, "a b c d e f g h i j k l")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "x a b c d e f g h i j k l"), (None, "x a b c d e f g h i j k l")], "doc_id long, text string")
    assert [tuple(r) for r in dec.leaks(docs, bench).collect()] == [(None, 1, 12, 12, 12)]
    assert dec.without_contaminated(docs, bench).count() == 0


def test_what_verification_accepts_is_found_at_every_length(spark):
    # whatever places are substituted, up to a fifth of the words: against the stretch alone, without any seed
    rng = random.Random(6)
    texts, bench = [], []
    for n in range(8, 32):
        item = [f"i{n}x{k}" for k in range(n)]
        bench.append((n, " ".join(item)))
        spread = [set(range(p, n, q)) for q in (3, 4, 5) for p in range(q)]
        for gone in [set(rng.sample(range(n), n // 5)) for _ in range(20)] + spread:
            texts.append(" ".join("other" if k in gone else w for k, w in enumerate(item)))
    items = {b: words(t) for b, t in bench}
    expected = {(d, n) for d, t in enumerate(texts) for n in [len(words(t))] if accepted(items[n], *best(words(t), items[n], 0))}
    got = dec.leaks(documents(spark, texts), spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected
    assert len(expected) >= 24 * 20


def test_short_items_are_found_whole(spark):
    bench = spark.createDataFrame([(n, " ".join(f"s{n}x{k}" for k in range(n))) for n in range(1, 8)], "item_id long, text string")
    whole = [f"so {t} it is" for (_, t) in bench.collect()]
    cut = [f"so {t.rsplit(' ', 1)[0]} other" for (n, t) in bench.collect() if n > 1]
    got = {(r["doc_id"], r["item_id"], r["score"], r["n_item"]) for r in dec.leaks(documents(spark, whole + cut), bench).collect()}
    assert got == {(n - 1, n, n, n) for n in range(1, 8)}


def test_masks_are_spaced_and_see_five_places_of_which_one_differs():
    assert all(m[-1] + 1 > len(m) for m in dec.MASKS)
    for gone in range(5):
        assert any(gone not in {at + k for k in m} for m in dec.MASKS for at in range(5 - m[-1]))


def test_dense_stretches_hold_five_places_of_which_at_most_one_differs():
    # all patterns of matching and other words up to 18 words that the verification accepts
    for n in range(dec.WHOLE, 19):
        for bits in range(1 << n):
            same = [bits >> k & 1 for k in range(n)]
            now = top = 0
            for x in same:
                now = max(0, now + (1 if x else -2))
                top = max(top, now)
            if accepted(same, top, sum(same)):
                assert any(sum(same[k : k + 5]) >= 4 for k in range(n - 4))


def test_a_part_of_a_short_item_is_no_leak(spark):
    bench = spark.createDataFrame([(1, "which river flows through the city of vienna"), (2, "a b c d e f g h i j")], "item_id long, text string")
    texts = ["he walked through the city of vienna at night", "which river flows through the town of vienna", "a b c d e f g h", "a b c d e f g"]
    got = {(r["doc_id"], r["item_id"]) for r in dec.leaks(documents(spark, texts), bench).collect()}
    assert got == {(1, 1), (2, 2)}
