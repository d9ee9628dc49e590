"""Language-model scores by a class-based bigram model with Brown classes.

Words are counted over all training texts, and each of them gets one of ``CLASSES`` classes by exchange, which gives a word the
class that raises the likelihood of the class bigrams most. The ``SEEDS`` most frequent words are exchanged first, one after the
other, on their table of pairs. Then ``SWEEPS`` jobs over all texts count, for each further word seen at least ``LEAST`` times, and
once in ``RARITY`` tokens, the classes before and after it: the first gives every such word its best class, later ones move one half
of all words and then the other, as long as the likelihood rises. By arithmetic at most ``RARITY`` words are moved that way, as their
classes go to the tasks. All other words, the late ones, are grouped by a shuffle: each gets the class that is best for the
classes before and after all places where it occurs, other late words there being one class. As so few places tell less, late words
of a class are a class apart from its other words. The end of a text is another, words never seen are the last.

A token's probability is that of its class after the class before it, smoothed towards the class's share, times that of the
word in its class, smoothed by counts. Each late word gives a discount, estimated from the words seen once and twice, to the words
never seen, which count as one word. All counts come from all training texts; the driver gets pairs of seeds, pairs of classes and the
class of each word that goes to the tasks.

The words that are moved, and beyond them the most frequent ones up to ``FREQUENT`` in all, go to the tasks with their counts and classes
(26 bytes each, and up to 16 more in a task that indexes them); all others are looked up by a join with the table of late words, one row
for each place of such a word in a text.

Tokens are runs of bytes other than space and ASCII 9 to 13, with A-Z in lower case, then one end. Words are known by
64-bit hashes. Defined cases: null and empty texts consist of their end alone; repeated rows count each time; without
training texts every word has the same share and classes are equally likely; a null id is scored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.kernels import U64, Words
from panelspark.llm.kernels import text_slices as slices_of
from panelspark.llm.tables import col, fresh, in_batches
from panelspark.workspace import stored

SEEDS, CLASSES, SEED_SWEEPS, SWEEPS = 1000, 64, 8, 3
LEAST, RARITY = 20, 4_000_000
FREQUENT = 400_000
ADD, BACK_OFF = 0.1, 20.0
END = U64(0xE4D0FE4D0FE4D0F1)
#: Distinct words a task holds before it counts them together.
HELD = 1 << 20
#: Bytes of texts hashed at once, so that a slice's arrays stay in a core's cache.
SLICE = 1 << 17
#: Blocks that all words are dealt to for their neighbours, whatever their number, so that a task's counts are so many rows at most
#: each time they are sent on; and what is counted of each word: classes after it, before it, itself.
BLOCKS, KINDS = 512, CLASSES + 2
#: Words whose gains are computed together.
MOVED = 16
#: With a class of late words beside each class.
ALL = KINDS + CLASSES
WIDTH = 2 * KINDS + 1

text_slices = functools.partial(slices_of, max_bytes=SLICE)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, texts = [], 0, 0

    def together() -> tuple[np.ndarray, np.ndarray]:
        words, many = (np.concatenate(x) for x in zip(*held))
        words, at = np.unique(words, return_inverse=True)
        return words, np.bincount(at, many, len(words)).astype(np.int64)

    def rows(words: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(many)], names=["word", "n"])

    for batch in batches:
        for at, to, data, offsets in text_slices(batch.column(0)):
            words, many = np.unique(Words(data, offsets).hashes, return_counts=True)
            held.append((words, many))
            size, texts = size + len(words), texts + to - at
            if size > HELD:
                held = [together()]
                size = len(held[0][0])
                if size > HELD:  # even together they are many: they are sent on as they are
                    yield rows(*held[0])
                    held, size = [], 0
    if texts:
        held.append((np.array([END]), np.array([texts])))
        yield rows(*together())


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` of a table with one column of texts, the end included."""
    return texts.mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lexicon:
    """The frequent words by hash, with counts and places by frequency; sweeps move the ``clustered`` first places."""

    words: np.ndarray
    counts: np.ndarray
    places: np.ndarray
    clustered: int

    def __reduce__(self) -> tuple:
        return Lexicon, (self.words, self.counts, self.places, self.clustered)  # each task indexes the words itself

    @functools.cached_property
    def _begins(self) -> tuple[U64, np.ndarray]:
        """By how much a hash is shifted to its first bits, and the index at which the words with such bits begin."""
        bits = max(len(self.words).bit_length() + 1, 8)
        many = np.bincount((self.words >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
        return U64(64 - bits), np.append(0, np.cumsum(many)[:-1]).astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each hash and whether it is there."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        shift, begins = self._begins
        last = len(self.words) - 1
        at = np.minimum(begins[(hashes >> shift).astype(np.int64)], last).astype(np.int64)
        on = np.flatnonzero(self.words[at] < hashes)
        while len(on):  # the words with the same first bits are few
            on = on[at[on] < last]
            at[on] += 1
            on = on[self.words[at[on]] < hashes[on]]
        return at, self.words[at] == hashes


def _symbols(lexicon: Lexicon, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts, each followed by its end: hash, index in the lexicon, whether there, symbol."""
    n = words.texts
    tokens = np.empty(len(words.hashes) + n, U64)
    ends = words.ends + np.arange(n)
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = words.hashes, END
    at, there = lexicon.find(tokens)
    symbol = np.full(len(tokens), lexicon.clustered)
    if len(lexicon.words):
        symbol = np.where(there, np.minimum(lexicon.places[at], lexicon.clustered), lexicon.clustered)
    symbol[ends] = lexicon.clustered + 1
    return tokens, at, there, symbol


def _before(symbol: np.ndarray, end: int) -> np.ndarray:
    """The symbol before each; a text begins after an end."""
    return np.append(end, symbol[:-1])


def _encoded(lexicon: Lexicon, batches: Iterator[pa.RecordBatch], late: bool = False) -> Iterator[pa.RecordBatch]:
    """Symbols of slices of texts and, if asked for, the hashes of their late words."""
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            tokens, _, _, symbol = _symbols(lexicon, Words(data, offsets))
            held = [symbol.astype("<i4"), *([tokens[symbol == lexicon.clustered].astype("<u8")] if late else [])]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in held], names=["symbols", "late"][: len(held)])


def encoded(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """The written table ``symbols, late`` of a table with one column of texts."""
    return stored(texts.mapInArrow(functools.partial(_encoded, lexicon, late=True), "symbols binary, late binary"), "symbols")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Symbols of whole texts, one after the other."""
    for batch in batches:
        for run in batch.column(0):
            yield np.frombuffer(run.as_buffer(), "<i4").astype(np.int64)


def _pairs(of: np.ndarray, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(width * width, np.int64)
    held, size = [], 0
    for symbol in _runs(batches):
        kind = of[symbol]
        held.append(_before(kind, of[-1]) * width + kind)
        size += len(kind)
        if size >= len(total):  # a table is added as seldom as its size asks for
            total += np.bincount(np.concatenate(held), minlength=len(total))
            held, size = [], 0
    if size:
        total += np.bincount(np.concatenate(held), minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])


def pair_counts(encoded: DataFrame, of: np.ndarray, width: int) -> np.ndarray:
    """How often a kind follows another, where ``of`` names the kind of each symbol."""
    found = encoded.mapInArrow(functools.partial(_pairs, of, width), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(width * width)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    return pairs.reshape(width, width)


def _beside(of: np.ndarray, movable: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For blocks of movable words, how often each class comes after and before each of them, and the word itself after it."""
    n = len(of) - 2
    word = np.arange(n)
    span = -(-n // BLOCKS) * WIDTH
    begin = np.append(word % BLOCKS * span + word // BLOCKS * WIDTH, [0, 0])  # frequent words are neighbours, so they are dealt out
    counted = np.append(movable, [False, False])
    held, raw, size, more = [], [], 0, 0

    def together() -> tuple[np.ndarray, np.ndarray]:
        keys, many = np.unique(np.concatenate(raw), return_counts=True) if raw else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not held:
            return keys, many
        keys, many = np.append(held[0], keys), np.append(held[1], many)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(many[order], first)

    def rows(keys: np.ndarray, many: np.ndarray) -> pa.RecordBatch:
        block, inner = np.divmod(keys, span)
        cut = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
        spans = list(zip(cut[:-1], cut[1:]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[cut[:-1]], pa.int32()),
                pa.array([inner[a:b].astype("<i4").tobytes() for a, b in spans], pa.binary()),
                pa.array([many[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
            ],
            names=["block", "inner", "many"],
        )

    for symbol in _runs(batches):
        before, kind = _before(symbol, n + 1), of[symbol]
        ours, theirs = counted[symbol], counted[before]
        raw += [
            begin[before[theirs]] + kind[theirs],
            begin[symbol[ours]] + KINDS + _before(kind, of[-1])[ours],
            begin[symbol[ours & (symbol == before)]] + 2 * KINDS,
        ]
        more += sum(len(x) for x in raw[-3:])
        if size + more > HELD:
            held, raw, more = together(), [], 0
            size = len(held[0])
            if size > HELD // 2:
                yield rows(*held)
                held, size = [], 0
    if size + more:
        yield rows(*together())


def _beside_gains(
    table: np.ndarray, f: np.ndarray, was: np.ndarray, out: np.ndarray, into: np.ndarray, self_pair: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each word with each neighbour that it has, and what f of every class's counts with this neighbour gains by the word's.
    ``table`` has a row for each neighbour and still counts the word in class ``was``."""
    w, k = np.nonzero(out)
    here, fs = table[k, :CLASSES], f[k, :CLASSES]
    own = np.flatnonzero(k == was[w])
    here[own] -= into[w[own], :CLASSES]
    at = np.flatnonzero(was[w] < CLASSES)
    to = was[w[at]]
    here[at, to] -= out[w[at], k[at]] + np.where(k[at] == to, self_pair[w[at]], 0)
    fs[own], fs[at, to] = _f(here[own]), _f(here[at, to])
    return w, k, _f(here + out[w, k][:, None]) - fs


def _many_gains(g: np.ndarray, was: np.ndarray, right: np.ndarray, left: np.ndarray, self_pair: np.ndarray) -> np.ndarray:
    """``_gains`` of many words for the classes that words go to, where ``g`` still counts each word in its class ``was``."""
    f = _f(g)
    after, before = np.zeros((len(was), CLASSES, KINDS)), np.zeros((len(was), KINDS, CLASSES))
    w, k, gained = _beside_gains(g.T, f.T, was, right, left, self_pair)
    after[w, :, k] = gained
    w, k, gained = _beside_gains(g, f, was, left, right, self_pair)
    before[w, k] = gained
    gain = after.sum(2) + before.sum(1)
    i, own = np.arange(len(was)), was[:, None] == np.arange(CLASSES)
    r, l, s = right[:, :CLASSES], left[:, :CLASSES], self_pair[:, None]
    total_right, total_left = right.sum(1, keepdims=True) + s, left.sum(1, keepdims=True) + s
    d = np.diagonal(g)[:CLASSES] - np.where(own, r + l + s, 0)
    gain += _f(d + r + l + s) - _f(d + r) - _f(d + l) + _f(d)
    rows, cols = g.sum(1)[:CLASSES] - l - np.where(own, total_right, 0), g.sum(0)[:CLASSES] - r - np.where(own, total_left, 0)
    return gain - (_f(rows + total_right) - _f(rows) + _f(cols + total_left) - _f(cols))


def _moves(g: np.ndarray, of: np.ndarray, movable: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The better class of each word that moves; rows come ordered by block, so one block's counts are held at a time."""
    n = len(of) - 2
    span = -(-n // BLOCKS) * WIDTH

    def best(block: int, counts: np.ndarray) -> pa.RecordBatch:
        table = counts.reshape(-1, WIDTH)
        words = np.arange(len(table)) * BLOCKS + block
        there = np.flatnonzero((words < n) & movable[np.minimum(words, n - 1)] & table.any(1))
        places, classes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(there), MOVED):
            row, w = table[there[a : a + MOVED]].astype(float), words[there[a : a + MOVED]]
            i, was = np.arange(len(w)), of[w]
            right, left, self_pair = row[:, :KINDS].copy(), row[:, KINDS:-1].copy(), row[:, -1]
            right[i, was] -= self_pair
            left[i, was] -= self_pair
            gain = _many_gains(g, was, right, left, self_pair)
            to = np.argmax(gain, 1)
            moves = (was >= CLASSES) | (gain[i, to] > gain[i, np.minimum(was, CLASSES - 1)] + 1e-9)
            places.append(w[moves])
            classes.append(to[moves])
        arrays = [pa.array(np.concatenate(x), pa.int32()) for x in (places, classes)]
        return pa.RecordBatch.from_arrays(arrays, names=["place", "class"])

    now, counts = -1, np.zeros(span, np.int64)
    for batch in batches:
        for block, inner, many in zip(*(batch.column(c) for c in ("block", "inner", "many"))):
            if block.as_py() != now:
                if now >= 0:
                    yield best(now, counts)
                now, counts = block.as_py(), np.zeros(span, np.int64)
            counts[np.frombuffer(inner.as_buffer(), "<i4")] += np.frombuffer(many.as_buffer(), "<i8")
    if now >= 0:
        yield best(now, counts)


def swept(encoded: DataFrame, of: np.ndarray, g: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """The classes after each movable word went to the class that is best for it while all others stay."""
    beside = encoded.mapInArrow(functools.partial(_beside, of, movable), "block int, inner binary, many binary")
    ordered = beside.repartition("block").sortWithinPartitions("block")
    moved = ordered.mapInArrow(functools.partial(_moves, g, of, movable), "place int, class int").toArrow()
    after = of.copy()
    after[moved["place"].to_numpy()] = moved["class"].to_numpy()
    return after


def likelihood(g: np.ndarray) -> float:
    """What the classes change of the log-likelihood of all texts."""
    return float(_f(g).sum() - _f(g.sum(0)).sum() - _f(g.sum(1)).sum())


def classes_of(encoded: DataFrame, clustered: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each symbol, and the counts of class pairs."""
    seeds = min(SEEDS, clustered)
    kinds = np.append(np.minimum(np.arange(clustered + 1), seeds), seeds + 1)
    pairs = pair_counts(encoded, kinds, seeds + 2)
    first = exchanged(pairs)
    of = np.concatenate([first[:seeds], np.full(clustered + 1 - seeds, CLASSES), [CLASSES + 1]]).astype(np.int64)
    member = np.eye(KINDS)[np.append(first[:seeds], [CLASSES, CLASSES + 1])]
    g = member.T @ pairs @ member
    for sweep in range(SWEEPS if clustered > seeds else 0):
        movable = of[:-2] == CLASSES if not sweep else np.arange(clustered) % 2 == sweep % 2
        after = swept(encoded, of, g, movable)
        counted = pair_counts(encoded, after, KINDS)
        if sweep and likelihood(counted) <= likelihood(g):
            break
        of, g = after, counted
    return of, g


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _without(g: np.ndarray, was: int, right: np.ndarray, left: np.ndarray, self_pair: float) -> np.ndarray:
    g = g.copy()
    g[was] -= right
    g[:, was] -= left
    g[was, was] -= self_pair
    return g


def _gains(g: np.ndarray, right: np.ndarray, left: np.ndarray, self_pair: float) -> np.ndarray:
    """What the likelihood gains when a word with these neighbours, not counted in ``g``, goes to each class."""
    rows, cols = g.sum(1), g.sum(0)
    f = _f(g)
    gain = (_f(g + right) - f).sum(1) + (_f(g + left[:, None]) - f).sum(0)
    d = np.diagonal(g)
    gain += _f(d + right + left + self_pair) - _f(d + right) - _f(d + left) + _f(d)
    total_right, total_left = right.sum() + self_pair, left.sum() + self_pair
    return gain - (_f(rows + total_right) - _f(rows) + _f(cols + total_left) - _f(cols))


def exchanged(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SEED_SWEEPS) -> np.ndarray:
    """Class of each word from the counts of pairs; the last two symbols keep classes of their own."""
    n = len(pairs) - 2
    of = np.append(np.arange(n) % classes, [classes, classes + 1])
    k = classes + 2
    seen = np.flatnonzero(pairs[:n].sum(1) + pairs[:, :n].sum(0))
    member = np.eye(k)[of]
    g = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for w in seen:
            was, self_pair = of[w], pairs[w, w]
            right = np.bincount(of, pairs[w], k)
            left = np.bincount(of, pairs[:, w], k)
            right[was] -= self_pair
            left[was] -= self_pair
            g = _without(g, was, right, left, self_pair)
            gain = _gains(g, right, left, self_pair)
            to = int(np.argmax(gain[:classes]))
            if gain[to] <= gain[was] + 1e-9:
                to = was
            moved += to != was
            of[w] = to
            g[to] += right
            g[:, to] += left
            g[to, to] += self_pair
        if not moved:
            break
    return of


def _smoothed(pairs: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of each kind, where ``weight`` is what counts add to it, and of each kind after each."""
    share = pairs.sum(0) + weight
    share = share / share.sum()
    return share, (pairs + BACK_OFF * share) / (pairs.sum(1, keepdims=True) + BACK_OFF)


def _around(lexicon: Lexicon, of: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each place of a late word: the classes before and after it, whether tasks know the word, the late word after it."""
    for batch in batches:
        for run, late in zip(*batch.columns):
            kind = of[np.frombuffer(run.as_buffer(), "<i4")]
            tokens = np.frombuffer(late.as_buffer(), "<u8")
            at = np.flatnonzero(kind == CLASSES)
            before, after = _before(kind, CLASSES + 1)[at], kind[at + 1]  # a text closes with its end
            around = ((lexicon.find(tokens)[1] * KINDS + before) * KINDS + after).astype(np.int32)
            following = pa.array(np.append(tokens[1:], U64(0)).view(np.int64)[: len(at)], mask=after != CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(around), following], names=["word", "around", "following"])


#: What rows of the table of late words tell: a word's count and class, the class before a place of it, how often a class is beside another.
WORD, PLACE, BESIDE = range(3)
LATE = "what int, word long, n long, class int, sent boolean"


def _classed(before_gain: np.ndarray, after_gain: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best class of each late word; rows come ordered by word."""
    beside = np.zeros(2 * KINDS * CLASSES, np.int64)

    def rows(what: int, word: np.ndarray, n: np.ndarray, kind: np.ndarray, sent: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(np.full(len(word), what, np.int32)), pa.array(word), pa.array(n), pa.array(kind.astype(np.int32)), pa.array(sent)]
        return pa.RecordBatch.from_arrays(arrays, names=["what", "word", "n", "class", "sent"])

    def whole(word: np.ndarray, around: np.ndarray, following: np.ndarray) -> Iterator[pa.RecordBatch]:
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        n = np.diff(np.append(begin, len(word)))
        sent, around = np.divmod(around.astype(np.int64), KINDS * KINDS)
        before, after = np.divmod(around, KINDS)
        best = np.argmax(np.round(np.add.reduceat(before_gain[before] + after_gain[after], begin), 9), 1)
        kind = np.repeat(best, n)
        beside[:] += np.bincount(before * CLASSES + kind, minlength=len(beside))
        beside[:] += np.bincount((KINDS + after) * CLASSES + kind, minlength=len(beside))
        yield rows(WORD, word[begin], n, best, sent[begin] > 0)
        late = after == CLASSES
        if late.any():
            yield rows(PLACE, following[late], np.ones(int(late.sum()), np.int64), kind[late], np.zeros(int(late.sum()), bool))

    held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)]
    for batch in batches:
        new = [pc.fill_null(batch.column(c), 0).to_numpy() for c in ("word", "around", "following")]
        held = [np.concatenate(x) for x in zip(held, new)]
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last word may go on
        if cut:
            yield from whole(*(x[:cut] for x in held))
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield from whole(*held)
    some = np.flatnonzero(beside)
    yield rows(BESIDE, some, beside[some], np.zeros(len(some)), np.zeros(len(some), bool))


def late_words(
    texts: DataFrame, lexicon: Lexicon, of: np.ndarray, g: np.ndarray, symbols: DataFrame | None = None
) -> tuple[DataFrame, np.ndarray]:
    """The written table ``word, n, class, sent`` of all late words, and the counts of pairs of all classes; ``symbols`` are the
    encoded texts, where they are there already."""
    symbols = encoded(texts, lexicon) if symbols is None else symbols
    share, after = _smoothed(g, np.full(KINDS, 0.5))
    gains = np.log(after[:, :CLASSES] / share[:CLASSES]), np.log(after[:CLASSES].T)
    places = symbols.mapInArrow(functools.partial(_around, lexicon, of), "word long, around int, following long")
    ordered = places.repartition("word").sortWithinPartitions("word", "around")
    found = stored(ordered.mapInArrow(functools.partial(_classed, *gains), LATE), "late-words")
    words = found.filter(F.col("what") == WORD).select("word", "n", "class", "sent")
    beside = found.filter(F.col("what") == BESIDE).groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(2 * KINDS * CLASSES)
    count[beside["word"].to_numpy()] = beside["n"].to_numpy()
    before, behind = count.reshape(2, KINDS, CLASSES)
    first = found.filter(F.col("what") == PLACE).select("word", F.col("class").alias("first"))
    both = first.join(words, "word").groupBy("first", "class").agg(F.count("*").alias("n")).toArrow()
    pairs = np.zeros((ALL, ALL))
    pairs[:KINDS, :KINDS], pairs[:KINDS, KINDS:], pairs[KINDS:, :KINDS] = g, before, behind.T
    pairs[CLASSES], pairs[:, CLASSES] = 0, 0  # there each late word has its own class now
    pairs[KINDS + both["first"].to_numpy(), KINDS + both["class"].to_numpy()] = both["n"].to_numpy()
    return words, pairs


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    tokens: int  # all training tokens
    types: int  # distinct ones
    of: np.ndarray  # class by symbol, late words being one
    kinds: np.ndarray  # class by place in the lexicon
    log_next: np.ndarray  # log10 of a class after a class
    log_in: np.ndarray  # log10 of a clustered word, or the end, in its class; 0 for others
    late: np.ndarray  # by class, what counts of its late words, less the discount, are divided by
    discount: float  # what each late word gives to words never seen
    ends: int  # training texts


def least_count(tokens: int) -> int:
    """What a word must be seen to be moved by sweeps, whose words go to the tasks; rarer ones get their class by a shuffle."""
    return max(LEAST, -(-tokens // RARITY))


def frequent(counts: DataFrame, least: int, most: int | None = None) -> DataFrame:
    """The words seen ``least`` times, and those above the lowest count that leaves at most ``most`` words. Counts are looked
    at in steps of an eighth of a power of two, so the driver gets some hundred rows and no task sorts the words of all
    others; where more than ``SEEDS`` words share the step that is cut, the ``SEEDS`` first of all words are taken."""
    most = FREQUENT if most is None else most
    step = F.floor(F.log2("n") * 8).cast("int")
    many = {r["step"]: r["words"] for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()}
    cut, total = max(many, default=0) + 1, 0
    while cut - 1 >= min(many, default=0) and total + many.get(cut - 1, 0) <= most:
        cut -= 1
        total += many.get(cut, 0)
    often = F.col("n") >= least
    if total < SEEDS and sum(many.values()) > total:
        return counts.orderBy(F.desc("n"), "word").limit(SEEDS).union(counts.filter(often)).distinct()
    return counts.filter((step >= cut) | often)


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of a table with one column of texts, and the written table of late words with counts and classes."""
    counts = stored(word_counts(texts), "word-counts")
    end = int(END.view(np.int64))
    whole = counts.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    tokens, types = int(whole[0] or 0), int(whole[1])
    least = least_count(tokens)
    top = frequent(counts.filter(F.col("word") != end), least).toArrow()
    words, many = top["word"].to_numpy().view(U64), top["n"].to_numpy()
    by_count = np.lexsort((words.view(np.int64), -many))
    words, many = words[by_count], many[by_count]
    order = np.argsort(words)
    lexicon = Lexicon(words[order], many[order], order, int((many >= least).sum()))
    symbols = encoded(texts, lexicon)
    of, g = classes_of(symbols.select("symbols"), lexicon.clustered)
    late, pairs = late_words(texts, lexicon, of, g, symbols)
    kinds = of[np.minimum(lexicon.places, lexicon.clustered)].astype(np.int16)
    sent = late.filter("sent").select("word", "class").toArrow()
    kinds[lexicon.find(sent["word"].to_numpy().view(U64))[0]] = KINDS + sent["class"].to_numpy()
    discount = min(0.9, max(0.1, whole[2] / (whole[2] + 2 * whole[3]) if whole[2] else 0.5))
    seen, given = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in late.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        seen[r["class"]], given[r["class"]] = r["n"], discount * r["words"]
    likely = _smoothed(pairs, np.where(np.arange(ALL) == CLASSES, 0.0, 0.5))[1]
    likely[:, CLASSES] = likely[:, KINDS:] @ ((given + ADD) / (seen + ADD))
    likely[:, KINDS:] *= (seen - given) / (seen + ADD)
    log_next = np.log10(np.maximum(likely, 1e-300))
    clustered = many[: lexicon.clustered]
    c = np.append(clustered, [0, 0]).astype(float)
    real = np.arange(len(of)) < len(clustered)
    in_class = np.bincount(of, (c + ADD) * real, KINDS)
    log_in = np.where(real, np.log10((c + ADD) / np.maximum(in_class[of], ADD)), 0.0)
    ends = int(pairs[:, CLASSES + 1].sum())
    return Model(lexicon, tokens, types, of, kinds, log_next, log_in, np.maximum(seen - given, ADD), discount, ends), late


def _scored(m: Model, column: pa.Array) -> Iterator[list[pa.Array]]:
    divisor = m.tokens + ADD * (m.types + 1)
    for at, to, data, offsets in text_slices(column):
        words = Words(data, offsets)
        tokens, index, there, symbol = _symbols(m.lexicon, words)
        n = to - at
        text = np.repeat(np.arange(n), words.counts + 1)
        count, kind = np.zeros(len(tokens), np.int64), np.full(len(tokens), -1, np.int32)
        count[there], kind[there] = m.lexicon.counts[index[there]], m.kinds[index[there]]
        end = symbol == m.lexicon.clustered + 1
        count[end], kind[end] = m.ends, CLASSES + 1
        there = there | end
        before = _before(kind, CLASSES + 1)
        score = np.where(there & (before >= 0), m.log_next[before, kind], 0.0) + m.log_in[symbol]
        ours = kind >= KINDS
        score[ours] += np.log10((count[ours] - m.discount) / m.late[kind[ours] - KINDS])
        base = np.where(there, np.log10((count + ADD) / divisor), 0.0)
        rare = np.flatnonzero(~there)
        ends = pa.array(np.append(0, np.cumsum(np.bincount(text[rare], minlength=n))), pa.int32())
        around = (before[rare] + 1) * (ALL + 1) + kind[rare + 1] + 1
        yield [
            pa.array(words.counts + 1), pa.array(np.bincount(text, count > 0, n).astype(np.int64)), pa.array(np.bincount(text, base, n)),
            pa.array(np.bincount(text, score, n)), pa.ListArray.from_arrays(ends, pa.array(tokens[rare].view(np.int64))),
            pa.ListArray.from_arrays(ends, pa.array(rare.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(around.astype(np.int32))),
        ]


def _links(spark: SparkSession, model: Model) -> tuple[DataFrame, DataFrame]:
    """log10 of a class after a class, for a looked-up word (with what its count is divided by) and for what comes after one."""
    divided = np.zeros(ALL)
    divided[KINDS:] = np.log10(model.late)
    pair = np.indices((ALL, ALL), np.int32).reshape(2, -1)
    table = lambda x, *names: spark.createDataFrame(pa.table([pa.array(pair[0]), pa.array(pair[1]), pa.array(x.ravel())], names=[*names]))
    return F.broadcast(table(model.log_next - divided, "before", "kind", "into")), F.broadcast(table(model.log_next, "kind", "after", "on"))


def score(docs: DataFrame, model: Model, late: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows, or the columns to keep of them, with ``n_tokens, n_known, base_score, score, perplexity``."""
    kept = docs.columns if keep is None else keep
    own = ["_row", "_n", "_known", "_base", "_score", "_rare", "_at", "_around"]
    names = fresh([*docs.columns, "n_tokens", "n_known", "base_score", "score", "perplexity"], *own)
    row, n, known, base, part, *rare = names
    lists = [T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType()), T.ArrayType(T.IntegerType())]
    kinds = [T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), *lists]
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    fields = [T.StructField(c, k) for c, k in zip(names[1:], kinds)]
    first = stored(
        in_batches(numbered, text_col, fields, functools.partial(_scored, model)).select(*[col(c) for c in [*kept, *names]]), "scored"
    )
    places = first.select(col(row).alias("row"), F.inline(F.arrays_zip(*[col(c) for c in rare])).alias("word", "at", "around"))
    looked_up = places.join(late.select("word", "n", "class"), "word", "left").select(
        "row", "at", "n", F.coalesce(F.col("class") + KINDS, F.lit(CLASSES)).alias("kind"),
        (F.floor(F.col("around") / (ALL + 1)) - 1).cast("int").alias("before"), (F.col("around") % (ALL + 1) - 1).alias("after"),
    )
    # a word that is looked up comes right after another one where the class before it isn't known yet
    last = F.lag("kind").over(Window.partitionBy("row").orderBy("at"))
    linked = looked_up.withColumn("before", F.when(F.col("before") >= 0, F.col("before")).otherwise(last))
    into, on = _links(docs.sparkSession, model)
    c = F.coalesce(F.col("n"), F.lit(0))
    zero = lambda x: F.coalesce(x, F.lit(0))
    within = F.when(c > 0, F.log10(c - model.discount)).otherwise(0)
    more = (
        linked.join(into, ["before", "kind"], "left").join(on, ["kind", "after"], "left").groupBy("row").agg(
            F.count_if(c > 0).alias("known"),
            F.sum(F.log10((c + ADD) / (model.tokens + ADD * (model.types + 1)))).alias("base"),
            F.sum(F.col("into") + zero(F.col("on")) + within).alias("score"),
        )
    )
    whole = first.join(more.withColumnRenamed("row", row), row, "left")
    total: Column = col(part) + zero(F.col("score"))
    return whole.select(
        *[col(x) for x in kept], col(n).alias("n_tokens"), (col(known) + zero(F.col("known"))).alias("n_known"),
        (col(base) + zero(F.col("base"))).alias("base_score"), total.alias("score"), F.pow(F.lit(10.0), -total / col(n)).alias("perplexity"),
    )
