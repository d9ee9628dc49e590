"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask looks at some words of a window and ignores the others. The windows of every mask slide over test items and
texts; equal hashes are hits. Around each hit text and item are laid side by side and compared: a matching word counts
1, another one -2. A text is contaminated by an item if its best stretch counts ``LEAST``, or if at most one in
``SUBSTITUTED`` of the item's words differ.

No overlap that this accepts is without a hit. It has five places in a row of which at most one differs: an item of 5k
to 5k + 4 words has k runs of five and at most k words that differ; a stretch of which every five places held two that
differ would count 4 at most. Of such five places one of the ``MASKS`` sees only words that match, wherever the other is:
the first and last place leave four in a row, the second falls on the gap of 1011, the fourth on that of 1101 one place
on, the third on that of 1101.

Words are runs of letters and digits in lower case; separators are white space and ASCII punctuation. Items of fewer
words than ``WHOLE`` contaminate a text that holds all their words in a row, even if it is a single word; the hash of
all their words is looked up. Defined cases: null and empty texts and items hold nothing; very long texts are taken
whole; of several places of one item the best is given (ties: all the same values); repeated items and rows each count;
a null id is kept as a row's id; the tables may have further columns of any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import col, fresh, sent_if
from panelspark.workspace import stored

#: Places of a window that count.
MASKS = ((0, 1, 3), (0, 2, 3))
#: Items of so many words may differ from the text, shorter ones must be there whole.
WHOLE = 8
LEAST, SUBSTITUTED = 12, 5
#: The test side goes to every executor up to so many bytes in its two tables; beyond it both sides are shuffled.
BROADCAST_BYTES = 64 << 20
#: Of a row of those tables without its words.
ROW_BYTES = 64
#: So do the digests (32 bytes) of contaminated texts; beyond it texts are shuffled.
BROADCAST_TEXTS = 500_000
#: Of the bitmap of the items' seeds, which is part of the plan: 128 kB.
MAX_BITS = 1 << 20
SEPARATORS = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"


def word_hashes(text: Column) -> Column:
    split = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")
    return F.transform(split, lambda w: F.xxhash64(w))


def seed(words: Column, at: Column, mask: tuple[int, ...]) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in mask], F.lit(sum(1 << k for k in mask)))


def places(words: Column, span: int) -> Column:
    """Where windows of so many words begin; empty for a text that is shorter."""
    last = F.size(words) - span
    return F.when(last >= 0, F.sequence(F.lit(0), F.when(last >= 0, last))).otherwise(F.array().cast("array<int>"))


def planted_seeds(words: Column) -> Column:
    """Place and hash of the seeds of an item; one of all its words where it must be there whole."""

    def of(mask: tuple[int, ...]) -> Column:
        return F.transform(places(words, mask[-1] + 1), lambda i: F.struct(i.alias("at"), seed(words, i, mask).alias("seed")))

    out = F.when(F.size(words) >= WHOLE, F.concat(*[of(m) for m in MASKS]))
    for n in range(1, WHOLE - 1):
        out = out.when(F.size(words) == n, of(tuple(range(n))))
    return out.otherwise(of(tuple(range(WHOLE - 1))))


def seed_filter(planted: DataFrame) -> tuple[Column, int]:
    """A bitmap of the seeds of the items as a constant, and how many bits of a hash it looks at. It lets through
    all their seeds and, of others, one in 64 (more where the items have over ``MAX_BITS`` / 64 seeds)."""
    n = planted.agg(F.approx_count_distinct("seed")).first()[0]
    bits = min(MAX_BITS, max(1 << 14, 1 << (64 * int(n)).bit_length()))
    place = F.col("seed").bitwiseAND(F.lit(bits - 1))
    rows = (
        planted.select(F.shiftright(place, 6).cast("int").alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    )
    packed = np.zeros(bits // 64, np.int64)  # at most MAX_BITS / 64 rows come
    for r in rows:
        packed[r["at"]] = r["bits"]
    return F.lit(packed), bits


def may_be_planted(hashed: Column, bitmap: Column, bits: int) -> Column:
    place = hashed.bitwiseAND(F.lit(bits - 1))
    return F.getbit(F.get(bitmap, F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1


def around(words: Column, mask: tuple[int, ...], reach: int, bitmap: Column, bits: int) -> Column:
    """Hash, place and surroundings of every window that may be a seed of an item; ``reach`` is the longest item's words."""
    maybe = F.filter(places(words, mask[-1] + 1), lambda i: may_be_planted(seed(words, i, mask), bitmap, bits))

    def near(i: Column) -> Column:
        begin = F.greatest(i - reach, F.lit(0))
        part = F.slice(words, begin + 1, F.lit(2 * reach))
        return F.struct((i - begin).alias("place"), seed(words, i, mask).alias("seed"), part.alias("words"))

    return F.transform(maybe, near)


def stretch(words: Column, item: Column, shift: Column) -> Column:
    """Best stretch (score, matches) of the item laid over the words from ``shift`` on."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("same"))

    def step(state: Column, i: Column) -> Column:
        same = F.coalesce(F.get(words, shift + i) == F.get(item, i), F.lit(False))
        now = F.greatest(state["now"] + F.when(same, 1).otherwise(-2), F.lit(0))
        return F.struct(
            now.alias("now"), F.greatest(state["best"], now).alias("best"), (state["same"] + same.cast("int")).alias("same")
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), zero, step)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id, item, score, n_same, n_item``: for each row and item that contaminates it the best stretch, the words
    that match over the whole item laid at that place, and the item's words."""
    found = _hits(docs.select(col(id_col).alias("id"), col(text_col).alias("text")), benchmark, item_col, item_text)
    return (
        found.groupBy("id", "item")
        .agg(F.max(F.struct("score", "n_same", "n_item")).alias("best"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.*")
    )


def _hits(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """A row for each place where an item contaminates a text; ``docs`` has a column ``text``, the others are kept."""
    items = benchmark.select(col(item_col).alias("item"), word_hashes(col(item_text)).alias("item_words"))
    items = stored(items.filter(F.size("item_words") > 0).withColumn("key", F.monotonically_increasing_id()), "items")
    sizes = items.agg(
        F.count("*").alias("all"), F.max(F.size("item_words")).alias("longest"), F.sum(F.size("item_words")).alias("words"),
        F.count_if(F.size("item_words") >= WHOLE).alias("long"),
        *[F.count_if(F.size("item_words") == k).alias(f"of_{k}") for k in range(1, WHOLE)],
    ).first()
    planted = stored(items.select("key", F.explode(planted_seeds(F.col("item_words"))).alias("s")).select("key", "s.*"), "seeds")
    # an item's words go once, not with each seed; a word has at most a seed of each mask
    rows = (sizes["words"] or 0) * len(MASKS) + sizes["all"]
    small, reach = rows * ROW_BYTES + (sizes["words"] or 0) * 8 <= BROADCAST_BYTES, int(sizes["longest"] or 0)
    masks = [tuple(range(k)) for k in range(1, WHOLE) if sizes[f"of_{k}"]]
    masks += MASKS if sizes["long"] or not masks else ()
    bitmap, bits = seed_filter(planted)
    kept = [c for c in docs.columns if c != "text"]
    words = docs.select(*kept, word_hashes(F.col("text")).alias("words"))
    found = F.concat(*[around(F.col("words"), m, reach, bitmap, bits) for m in masks])
    # not the plain explode(): for that one the optimizer adds a filter that computes all seeds once more
    placed = words.select(*kept, F.explode_outer(found).alias("s")).select(*kept, "s.*")
    hits = placed.join(sent_if(planted, small), "seed").join(sent_if(items, small), "key")
    n = F.col("n_item")
    differing = F.when(n < WHOLE, 0).otherwise(F.floor(n / SUBSTITUTED))
    return (
        hits.withColumn("n_item", F.size("item_words"))
        .withColumn("found", stretch(F.col("words"), F.col("item_words"), F.col("place") - F.col("at")))
        .filter((F.col("found.best") >= LEAST) | (n - F.col("found.same") <= differing))
        .select(*kept, "item", F.col("found.best").alias("score"), F.col("found.same").alias("n_same"), "n_item")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows that no item contaminates, with the columns they had. Equal texts share one verdict, so rows are
    left out by the 256-bit digest of their text and need no id."""
    (digest,) = fresh(docs.columns, "_digest")
    marked = docs.withColumn(digest, F.unhex(F.sha2(F.coalesce(col(text_col), F.lit("")), 256)))
    texts = marked.select(col(digest).alias("digest"), col(text_col).alias("text"))
    bad = stored(_hits(texts, benchmark, item_col, item_text).select(F.col("digest").alias(digest)).distinct(), "contaminated")
    return marked.join(sent_if(bad, bad.count() <= BROADCAST_TEXTS), digest, "left_anti").drop(digest)
