"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Four kinds are found by rules (``RULES``). Their spans are the seeds. What stands around them makes lexical
patterns: the word before with the shape of the span, the word after with the shape, the two words. A
pattern also meets other tokens with a digit, and runs of tokens, that no rule took. Over the graph of patterns and instances scores go
round: a pattern is as good as the mean score of its instances, smoothed; an instance that is no seed has the
combined score of its good patterns. An instance whose score reaches ``SURE`` becomes a seed itself, in all its
patterns, so identifiers may be found over any number of steps. Rounds end when no pattern or instance is added.
Patterns that end above ``SURE`` mark the unseen instances they meet as kind ``id``. Spans of the rules stay as they
are.

Defined cases: null and empty texts have no spans; very long texts are taken whole, at a cost close to their length; of a
neighbouring word longer than ``CONTEXT`` the characters next to the span count; each row counts by itself, also where rows repeat; a pattern
needs ``SUPPORT`` different seeds; one or two characters are no identifier; the input may have further columns of any name.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import col, fresh, sent_if
from panelspark.workspace import stored

#: Kinds in the order in which spans of one place are listed.
KINDS = ("email", "ip", "card", "phone", "id")
# The patterns of the rules. Possessive repeats and the starts that are left out don't change what
# matches; they keep the work in proportion to the text. \G lets a match begin where the one before ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
RULES = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
#: What each rule can't do without, tested first.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
#: What may be an identifier: a token of letters and digits, whole or in groups, that holds a digit; and a run of such
#: tokens, or groups of up to four capitals between them, with single spaces. Confidence decides, not the form.
_PART = r"[A-Za-z0-9]++(?:[-/.][A-Za-z0-9]++)*+"
_ALONE = r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][-/.])"
TOKEN = _ALONE + r"(?=[A-Za-z./-]*+[0-9])" + _PART
_WITH_DIGIT = r"(?=[A-Za-z./-]*+[0-9])" + _PART
#: Up to so many tokens follow the first one of a run.
MORE = 8
RUN = _ALONE + _WITH_DIGIT + r"(?:\x20(?:[A-Z]{1,4}\x20)?" + _WITH_DIGIT + "){1,%d}" % MORE
LEAST_CHARACTERS, CONTEXT = 3, 40
#: Matches gathered before they are joined with the others; code points of a piece that contexts are cut from.
BLOCK, PIECE = 256, 1000
SMOOTH, SUPPORT, GOOD, SURE = 2.0, 3, 0.5, 0.8
#: Rounds go on while a score still rises by this much, even if it has added nothing yet.
RISE = 0.001
#: Up to so many added spans (some 50 bytes each) are sent to all executors; beyond it texts are shuffled.
BROADCAST_SPANS = 500_000
SPAN = "struct<start:int,end:int,found:string>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether 12 to 19 digits pass the check sum."""
    d = digits(text)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 1, twice).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add)
    return F.length(d).between(12, 19) & (total % 10 == 0)


def byte_parts(text: Column) -> Column:
    """Whether the parts between dots are at most 255, whatever zeros they begin with."""

    def fits(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=.)", "")
        return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)

    return F.forall(F.split(text, r"\."), fits)


VALID = {
    "email": lambda found: F.lit(True),
    "ip": byte_parts,
    "card": luhn,
    "phone": lambda found: F.length(digits(found)).between(9, 15),
}


def scanned(items: Column, zero: Column, step, result: str) -> Column:
    """What ``step(carry, item)``, a struct of ``carry`` and ``out``, leaves for each item from left to right. Results
    are gathered in blocks, so what is copied grows with the items to the power of one and a half at most."""
    none = lambda kind: F.array().cast(f"array<{kind}>")

    def add(state: Column, item: Column) -> Column:
        def append(done: Column) -> Column:
            return F.struct(done["carry"].alias("carry"), F.concat(state["out"], F.array(done["out"])).alias("out"))

        return bound(step(state["carry"], item), append)

    def block(state: Column, at: Column) -> Column:
        def close(s: Column) -> Column:
            return F.struct(s["carry"].alias("carry"), F.concat(state["out"], F.array(s["out"])).alias("out"))

        return F.aggregate(
            F.slice(items, at + 1, F.lit(BLOCK)), F.struct(state["carry"].alias("carry"), none(result).alias("out")), add, close
        )

    begins = F.sequence(F.lit(0), F.size(items) - 1, F.lit(BLOCK))
    start = F.struct(zero.alias("carry"), none(f"array<{result}>").alias("out"))
    return F.when(F.size(items) > 0, F.aggregate(F.when(F.size(items) > 0, begins), start, block, lambda s: F.flatten(s["out"]))).otherwise(none(result))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str, hint: str | None = None) -> Column:
    """Place (code points, end exclusive) and text of all matches from left to right."""
    cut = F.arrays_zip(
        F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("found")
    )

    def step(at: Column, c: Column) -> Column:
        start = at + F.length(c["between"])
        end = start + F.length(c["found"])
        span = F.struct(start.alias("start"), end.alias("end"), c["found"].alias("found"))
        return F.struct(end.alias("carry"), span.alias("out"))

    def placed(zipped: Column) -> Column:  # the last piece has no match after it
        return scanned(F.slice(zipped, F.lit(1), F.size(zipped) - 1), F.lit(0), step, SPAN)

    return F.when(text.rlike(hint or pattern), bound(cut, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def apart(spans: Column, taken: Column) -> Column:
    """The spans that overlap none of the taken ones, by start: one pass from the left knows how far taken spans that
    begin before reach, one from the right where the next one begins."""
    event = lambda rank: lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), s["found"].alias("found"), F.lit(True).alias("free")
    )
    kind = "struct<start:int,rank:int,end:int,found:string,free:boolean>"

    def checked(reach, free):
        def step(carry: Column, e: Column) -> Column:
            now = F.when(e["rank"] == 0, reach(carry, e)).otherwise(carry)
            out = F.struct(e["start"].alias("start"), e["rank"].alias("rank"), e["end"].alias("end"), e["found"].alias("found"), (e["free"] & free(carry, e)).alias("free"))
            return F.struct(now.alias("carry"), out.alias("out"))

        return step

    forward = checked(lambda c, e: F.greatest(c, e["end"]), lambda c, e: c <= e["start"])
    back = checked(lambda c, e: F.least(c, e["start"]), lambda c, e: c >= e["end"])
    events = F.array_sort(F.concat(F.transform(taken, event(0)), F.transform(spans, event(1))))
    first = bound(events, lambda x: scanned(x, F.lit(0), forward, kind))
    both = bound(F.reverse(first), lambda x: scanned(x, F.lit(2**31 - 1), back, kind))
    left = F.filter(both, lambda e: (e["rank"] == 1) & e["free"])
    return F.transform(F.reverse(left), lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["found"].alias("found")))


def pieces_of(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), 0)


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from start to end, at a cost that depends on their number and not on the text's."""

    def part(j: Column) -> Column:
        first = F.greatest(start - j * PIECE, F.lit(0))
        return F.substring(F.get(pieces, j), first + 1, F.least(end - j * PIECE, F.lit(PIECE)) - first)

    which = F.sequence(F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int"))
    return F.when(end > start, F.array_join(F.transform(F.when(end > start, which), part), "")).otherwise(F.lit(""))


def rule_spans(text: Column) -> list[Column]:
    """One array for each kind: start, end and text of the spans that its rule takes."""
    def of(kind: str) -> Column:
        return F.filter(matches(text, RULES[kind], HINTS[kind]), lambda s: VALID[kind](s["found"]))

    return [of(k).alias(k) for k in RULES]


def shape(found: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(found, "[A-Za-z]+", "a"), "[0-9]", "9")


def patterns(pieces: Column, span: Column) -> Column:
    """The lexical patterns that a span stands in."""
    before = F.lower(F.regexp_extract(cut(pieces, F.greatest(span["start"] - CONTEXT, F.lit(0)), span["start"]), r"(\S+)\s*$", 1))
    after = F.lower(F.regexp_extract(cut(pieces, span["end"], span["end"] + CONTEXT), r"^\s*(\S+)", 1))
    sides = F.struct(before.alias("before"), after.alias("after"), shape(span["found"]).alias("form"))
    return bound(
        sides,
        lambda s: F.array(
            F.concat_ws("\t", F.lit("before"), s["before"], s["form"]),
            F.concat_ws("\t", F.lit("after"), s["after"], s["form"]),
            F.concat_ws("\t", F.lit("both"), s["before"], s["after"]),
        ),
    )


def scored_patterns(uses: DataFrame) -> DataFrame:
    """``pattern, confidence`` from ``pattern, instance, seed``, one row for each pair."""
    edges = stored(uses.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    # what meets fewer than SUPPORT instances can't have as many seeds, whatever is found later
    size = stored(
        edges.groupBy("pattern").agg(F.count("*").alias("n"), F.sum(F.col("seed").cast("int")).alias("rule_seeds"))
        .filter(F.col("n") >= SUPPORT),
        "sizes",
    )
    loose = stored(edges.filter("NOT seed").join(size, "pattern", "left_semi").select("pattern", "instance"), "loose")
    # an instance that a rule takes at one place is a seed at the others too
    scores = (
        loose.join(edges.filter("seed").select("instance").distinct(), "instance", "left_semi").select("instance").distinct()
        .select("instance", F.lit(1.0).alias("score"), F.lit(1.0).alias("rise"))
    )
    reached = None
    while True:
        held = stored(scores, "scores")
        found = held.agg(F.count_if(F.col("score") == 1), F.max("rise")).first()
        gained = loose.join(held, "instance").groupBy("pattern").agg(
            F.sum("score").alias("more"), F.count_if(F.col("score") == 1).alias("new_seeds")
        )
        confidence = stored(
            size.join(gained, "pattern", "left")
            .filter(F.col("rule_seeds") + F.coalesce("new_seeds", F.lit(0)) >= SUPPORT)
            .select("pattern", ((F.col("rule_seeds") + F.coalesce("more", F.lit(0.0))) / (F.col("n") + SMOOTH)).alias("confidence")),
            "patterns",
        )
        ranks = confidence.agg(F.count_if(F.col("confidence") >= GOOD), F.count_if(F.col("confidence") >= SURE)).first()
        now = (found[0], *ranks)
        if now == reached and (found[1] or 0.0) < RISE:
            return confidence
        reached = now
        seen = (
            loose.join(confidence.filter(F.col("confidence") >= GOOD), "pattern")
            .groupBy("instance").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("new"))
        )
        old, new = F.coalesce("score", F.lit(0.0)), F.when(F.col("new") >= SURE, 1.0).otherwise(F.coalesce("new", F.lit(0.0)))
        best = F.greatest(old, new)
        scores = held.join(seen, "instance", "full").select("instance", best.alias("score"), (best - old).alias("rise"))


def find(docs: DataFrame, text_col: str = "text", spans_col: str = "spans", keep: list[str] | None = None) -> DataFrame:
    """The rows, or the columns to keep of them, with one more: all spans (``start, rank, end, kind``) by start
    and then kind."""
    kept = [col(c) for c in (docs.columns if keep is None else keep)]
    text, row, rules, maybe, taken, parts, loose = fresh([*docs.columns, spans_col], "_whole", "_row", "_rules", "_maybe", "_taken", "_parts", "_loose")
    t = col(text)
    struct = lambda s, k: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end"), F.lit(KINDS[k]).alias("kind"))
    arrays = fresh([*docs.columns, text, row, rules, maybe, taken, parts, loose], *[f"_{k}" for k in RULES])
    based = docs.withColumn(text, F.coalesce(col(text_col), F.lit(""))).withColumn(row, F.monotonically_increasing_id())
    based = based.select("*", *[c.alias(a) for c, a in zip(rule_spans(t), arrays)])
    tokens = F.filter(
        F.concat(matches(t, TOKEN, "[0-9]"), matches(t, RUN, r"[0-9][A-Za-z./-]*\x20")),
        lambda s: (F.length(F.regexp_replace(s["found"], "[^A-Za-z0-9]", "")) >= LEAST_CHARACTERS) & s["found"].rlike("[0-9]"),
    )
    based = based.select("*", F.concat(*[col(a) for a in arrays]).alias(taken), tokens.alias(loose), pieces_of(t).alias(parts))
    use = lambda seed: lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["found"].alias("found"), patterns(col(parts), s).alias("patterns"), F.lit(seed).alias("seed"))
    uses = F.concat(F.transform(col(taken), use(True)), F.transform(apart(col(loose), col(taken)), use(False)))
    listed = F.array_sort(F.concat(*[F.transform(col(a), functools.partial(lambda k, s: struct(s, k), k)) for k, a in enumerate(arrays)]))
    rows = stored(
        based.select(*kept, row, listed.alias(rules), uses.alias(maybe)), "spans"
    )
    each = rows.select(col(row).alias("row"), F.explode(maybe).alias("u")).select(
        "row", "u.start", "u.end", "u.seed", F.col("u.found").alias("instance"), F.explode("u.patterns").alias("pattern")
    )
    sure = stored(scored_patterns(each).filter(F.col("confidence") >= SURE), "sure")
    new = stored(
        each.filter("NOT seed").join(sure, "pattern", "left_semi").select("row", "start", "end").distinct()
        .groupBy("row").agg(F.collect_list(struct({"start": F.col("start"), "end": F.col("end")}, 4)).alias("new")),
        "found",
    )
    few = (new.agg(F.sum(F.size("new"))).first()[0] or 0) <= BROADCAST_SPANS
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    both = F.array_sort(F.concat(col(rules), F.coalesce("new", none)))
    return rows.join(sent_if(new.withColumnRenamed("row", row), few), row, "left").select(*kept, both.alias(spans_col))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or each run of spans that overlap, replaced by the first one's kind in brackets."""

    def whole(pieces: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            mark = F.concat(cut(pieces, at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            out = F.struct(F.when(s["start"] >= at, mark).otherwise("").alias("text"), s["end"].alias("end"))
            return F.struct(F.greatest(at, s["end"]).alias("carry"), out.alias("out"))

        def joined(done: Column) -> Column:
            return F.concat(
                F.array_join(F.transform(done, lambda d: d["text"]), ""),
                cut(pieces, F.array_max(F.transform(done, lambda d: d["end"])), F.size(pieces) * PIECE),
            )

        return bound(scanned(spans, F.lit(0), step, "struct<text:string,end:int>"), joined)

    return F.when(F.size(spans) > 0, bound(pieces_of(text), whole)).otherwise(text)


def without_personal_data(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows with personal data in their text replaced; a length column, if named, follows the new text."""
    (spans,) = fresh(docs.columns, "_spans")
    new = redacted(col(text_col), col(spans))
    length = {length_col: F.when(F.size(col(spans)) > 0, F.length(new).cast("long")).otherwise(col(length_col))} if length_col else {}
    return find(docs, text_col, spans).select(
        *[(new if c == text_col else length.get(c, col(c))).alias(c) for c in docs.columns]
    )
