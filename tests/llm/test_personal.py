"""Personal data: the rules against Python's expressions, bootstrapping, redaction."""

import re

from pyspark.sql import functions as F

from panelspark.llm import personal
from tests.llm.shared import documents, read

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    d = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 12 <= len(d) <= 19 and total % 10 == 0
    return True


def brute(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


def base_of(df):
    return {r[0]: r[1] for r in df.select("doc_id", personal.listing(F.filter("spans", lambda s: s["rank"] < 4))).collect()}


ODD = [
    None, "", "x", "a@b.cx_y@z.w", "a@b.c@d.e", "é\U00020000 me@host.example.org, 1.2.3.4.5.6.7.8 +1 (017) 555-7713",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 0000000000000", "256.1.1.1 001.002.003.0004 1.2.3", "+12345 +1234567890123456 +1 2 3 4 5 6 7 8 9",
    "9" * 60000, "a." * 30000 + "@b.c", "1.1.1.1 " * 3000, "@@@ ...", "+1.2.3.4-5 6(7)8",
]


def test_rules_on_odd_texts(spark):
    assert base_of(personal.find(documents(spark, ODD))) == {i: brute(t) for i, t in enumerate(ODD)}


def test_rules_on_all_documents(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    assert base_of(personal.find(docs)) == {r["doc_id"]: brute(r["text"]) for r in docs.collect()}


def test_patterns_of_seeds_find_unseen_identifiers(spark):
    seeds = [f"card no: 4{i:02d}0 0000 0000 0000 end" for i in range(100)]
    seeds = [t for t in seeds if brute(t)]
    texts = [*seeds, *["card no: 123456789 end"] * 2, "page 123456 of", "of 2024/11/30 the", "card no: 12 end"]
    got = {r["doc_id"]: personal_listing for r, personal_listing in (
        (r, r["l"]) for r in personal.find(documents(spark, texts)).select("doc_id", personal.listing(F.col("spans")).alias("l")).collect()
    )}
    n = len(seeds)
    assert [got[n], got[n + 1]] == ["id:9:18"] * 2
    assert [got[n + 2], got[n + 3], got[n + 4]] == ["", "", ""]
    assert [got[i] for i in range(n)] == [brute(t) for t in seeds]


def test_redaction_keeps_columns_and_other_texts(spark):
    texts = ["a me@x.yz b", "+1.2.3.4-5 6(7)8 z", None, "", "plain"]
    docs = documents(spark, texts)
    out = personal.without_personal_data(docs, length_col="n_chars")
    assert out.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got[0] == ("a [EMAIL] b", 11)
    assert [got[i] for i in (2, 3, 4)] == [(None, None), ("", None), ("plain", None)]


def test_empty_table_and_repeated_rows(spark):
    docs = documents(spark, ["me@x.yz"])
    assert personal.find(docs.limit(0)).count() == 0
    assert [r["doc_id"] for r in personal.find(docs.union(docs)).collect()] == [0, 0]


def test_discovered_identifiers_are_seeds_of_further_patterns(spark):
    seeds = [t for t in (f"card no: 4{i:03d} 0000 0000 0000 end" for i in range(300)) if brute(t)]
    first = [f"card no: 70000{i} end" for i in range(10)]
    second = [f"member ref: 70000{i} done" for i in range(10)]
    third = [f"staff key: 71234{i} here" for i in range(10)]
    texts = [*seeds, *first, *second, *[f"member ref: 71234{i} done" for i in range(2)], *third, "staff key: 719999 here", "page 719998 of"]
    rows = personal.find(documents(spark, texts)).select("doc_id", personal.listing(F.col("spans")).alias("l")).collect()
    got = {r["doc_id"]: r["l"] for r in rows}
    n = len(seeds)
    assert [got[i] for i in range(n)] == [brute(t) for t in seeds]
    assert {got[i] for i in range(n, n + 10)} == {"id:9:15"}
    assert {got[i] for i in range(n + 10, n + 22)} == {"id:12:18"}  # a second step: no rule takes anything there
    assert {got[i] for i in range(n + 22, n + 34)} == {""}  # two of eleven are too few to trust the third


def test_identifiers_of_any_form_are_found_in_sure_contexts(spark):
    seeds = [t for t in (f"card no: 4{i:03d} 0000 0000 0000 end" for i in range(300)) if brute(t)]
    forms = ["C01X00T47", "GB82WEST12345698765432", "AB123456", "EMP-20418", "12 34 56 78", "GB82 WEST 1234 5698 7654 32", "77/B.4"]
    texts = [*seeds, *[f"card no: {f} end" for f in forms], *[f"version {f} of" for f in forms], "card no: none end"]
    rows = personal.find(documents(spark, texts)).select("doc_id", personal.listing(F.col("spans")).alias("l")).collect()
    got = {r["doc_id"]: r["l"] for r in rows}
    n = len(seeds)
    assert [got[n + i] for i in range(len(forms))] == [f"id:9:{9 + len(f)}" for f in forms]
    assert {got[i] for i in range(n + len(forms), len(texts))} == {""}


def test_texts_of_very_many_matches(spark):
    line = "host 10.0.0.1 took 12345 ms for a1-b2 c3, é\U00020000x9; mail me@x.yz "
    texts = [line * 2000, "1.1.1.1" + " 7" * 20000, "+1.2.3.4-5 6(7)8 " * 1500]
    docs = documents(spark, texts)
    assert base_of(personal.find(docs)) == {i: brute(t) for i, t in enumerate(texts)}
    got = {r["doc_id"]: r["text"] for r in personal.without_personal_data(docs).collect()}
    assert got[0].count("[IP]") == got[0].count("[EMAIL]") == 2000 and got[0].endswith("; mail [EMAIL] ")


def test_spans_apart_from_taken_ones(spark):
    kind = "array<struct<start:int,end:int,found:string>>"
    spans = lambda *pairs: [(a, b, f"{a}-{b}") for a, b in pairs]
    loose = spans((0, 3), (0, 20), (4, 6), (9, 12), (12, 13), (30, 40), (31, 33))
    taken = spans((3, 5), (10, 12), (32, 34))
    row = spark.createDataFrame([(loose, taken), ([], taken), (loose, [])], f"a {kind}, b {kind}")
    got = [sorted((s["start"], s["end"]) for s in r[0]) for r in row.select(personal.apart(F.col("a"), F.col("b"))).collect()]
    free = lambda t: sorted((a, b) for a, b, _ in loose if all(d <= a or b <= c for c, d, _ in t))
    assert got == [free(taken), [], free([])]
