"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word enters the network as the sum of two learned inputs side by side: its own vector, where the training
sample holds it often enough, and the mean of the vectors of its hashed character triples. The network reads
windows of ``LENGTH`` words that overlap by half and cover the whole text; attention weighs the states of a
window, and a text's score is that of its highest window, turned into a probability on the training texts.

Training runs in numpy on the driver over a sample bounded by ``MAX_TEXTS`` texts a class of at most
``MAX_CHARS`` characters. Scoring runs in Spark tasks over every text, whole.

Defined cases: null and empty texts, and texts without words, are one empty window; labels that are null do
not count, a text with several labels counts as toxic if one is; without labels of both kinds every score is
the share of toxic ones among the labels (0 without labels). Columns of the input may have any names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm.kernels import NOT_ALNUM, U64, Words, mix, text_slices
from panelspark.llm.tables import col, fresh, in_batches
from panelspark.workspace import stored

LENGTH, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION, BUCKETS = 8, 8, 8, 8, 4096
#: Bounds of the training sample: texts of each class, characters of a text.
MAX_TEXTS, MAX_CHARS = 1500, 6000
#: A word has a vector of its own if so many texts of the sample hold it.
LEAST_TEXTS = 12
STEPS, BATCH, RATE = 300, 256, 0.01
#: Shares of a window's words that a step leaves out, and of words whose own vector it hides; decay of vectors.
DROPPED, UNKNOWN, DECAY = 0.1, 0.3, 0.1
CHUNK = 4096


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, for each word the place of its hash, and the character triples of the distinct
    ones: flat buckets and where each word's begin."""
    hashes, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
    n = words.lengths[first]
    bounds = np.cumsum(n) - n
    at = np.repeat(words.bounds[first] - bounds, n) + np.arange(int(n.sum()))
    here = words.bytes[at].astype(U64)
    before, after = np.empty_like(here), np.empty_like(here)
    before[1:], after[:-1] = here[:-1], here[1:]
    if len(here):
        before[bounds], after[bounds + n - 1] = 1, 2
    return hashes, place, (mix((before * U64(257) + here) * U64(257) + after) % U64(BUCKETS)).astype(np.int32), bounds


def windows(counts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of all windows; a text without words has one empty window."""
    many = np.maximum(0, -(-(counts - LENGTH) // STRIDE)) + 1
    text = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    begin = (ends - counts)[text] + nth * STRIDE
    return text, begin, np.minimum(begin + LENGTH, ends[text])


def initial(vocabulary: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": normal(vocabulary + 1, WORD_DIM, scale=0.1), "char": normal(BUCKETS, CHAR_DIM, scale=0.1)}
    p["word"][0] = 0
    for side in "fb":
        p[f"W{side}"] = normal(WORD_DIM + CHAR_DIM, 3 * HIDDEN, scale=0.4)
        p[f"U{side}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
        p[f"b{side}"] = np.zeros(3 * HIDDEN, np.float32)
    p |= {"A": normal(2 * HIDDEN, ATTENTION, scale=0.3), "a": np.zeros(ATTENTION, np.float32), "v": normal(ATTENTION, scale=0.3)}
    return p | {"o": normal(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}


def inputs(p: dict, known: np.ndarray, triples: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The network's input for distinct words: known is the row in the word table, 0 for none."""
    if not len(known):
        return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
    n = np.diff(np.append(bounds, len(triples)))[:, None]
    return np.hstack([p["word"][known], np.add.reduceat(p["char"][triples], bounds) / n]).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def recur(gates: np.ndarray, U: np.ndarray, mask: np.ndarray, order, keep: list | None = None) -> np.ndarray:
    """States of one direction, LENGTH x HIDDEN x windows; gates are windows x LENGTH x 3 HIDDEN, without the
    recurrent part, and mask is LENGTH x windows."""
    n = len(gates)
    h, out = np.zeros((HIDDEN, n), np.float32), np.empty((LENGTH, HIDDEN, n), np.float32)
    for t in order:
        g, u, m = np.ascontiguousarray(gates[:, t].T), U.T @ h, mask[t]
        zr = g[: 2 * HIDDEN] + u[: 2 * HIDDEN]
        np.exp(np.negative(zr, out=zr), out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:HIDDEN], zr[HIDDEN:]
        new = r * u[2 * HIDDEN :]
        new += g[2 * HIDDEN :]
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((t, h, z, r, new, u[2 * HIDDEN :], m))
        step = h - new
        step *= z
        step += new
        step -= h
        step *= m
        h = np.add(h, step, out=out[t])
    return out


def pooled(p: dict, states: np.ndarray, mask: np.ndarray):
    """Logits of windows from their states, LENGTH x 2 HIDDEN x windows, and what the gradients need."""
    hidden = np.tanh(p["A"].T @ states + p["a"][:, None])
    weight = np.exp(p["v"] @ hidden) * mask  # the factors of the exponent are bounded, so this can't overflow
    weight /= np.maximum(weight.sum(0), 1e-9)
    context = (weight[:, None] * states).sum(0)
    return p["o"] @ context + p["c"][0], hidden, weight, context


def logits(p: dict, table: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of windows over the words ``place``, each a row of the input table."""
    sides = {s: np.vstack([table @ p[f"W{s}"] + p[f"b{s}"], np.zeros((1, 3 * HIDDEN), np.float32)]) for s in "fb"}
    out, span, padded = np.empty(len(begin), np.float32), np.arange(LENGTH), np.append(place, len(table))
    for at in range(0, len(begin), CHUNK):
        index = begin[at : at + CHUNK, None] + span
        inside = index < end[at : at + CHUNK, None]
        index = padded[np.where(inside, index, len(place))]
        mask = np.ascontiguousarray(inside.T, np.float32)
        forward = recur(sides["f"][index], p["Uf"], mask, range(LENGTH))
        backward = recur(sides["b"][index], p["Ub"], mask, reversed(range(LENGTH)))
        out[at : at + CHUNK] = pooled(p, np.concatenate([forward, backward], 1), mask)[0]
    return out


def flat(x: np.ndarray) -> np.ndarray:
    return x.reshape(-1, x.shape[-1])


def gradients(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray]:
    """Of the mean log loss, by parameter and for the inputs (windows x LENGTH x dimensions)."""
    kept, states = {"f": [], "b": []}, {}
    for s, order in (("f", range(LENGTH)), ("b", reversed(range(LENGTH)))):
        states[s] = recur(x @ p[f"W{s}"] + p[f"b{s}"], p[f"U{s}"], mask, order, kept[s])
    both = np.concatenate([states["f"], states["b"]], 1)
    logit, hidden, weight, context = pooled(p, both, mask)
    d = ((sigmoid(logit) - y) / len(y)).astype(np.float32)
    g = {"o": context @ d, "c": d.sum(keepdims=True)}
    dc = p["o"][:, None] * d
    dw = (both * dc).sum(1)
    de = weight * (dw - (weight * dw).sum(0))
    dh = de[:, None] * p["v"][:, None] * (1 - hidden**2)
    rows = lambda a: flat(a.transpose(0, 2, 1))
    g |= {"v": rows(hidden).T @ de.ravel(), "A": rows(both).T @ rows(dh), "a": dh.sum((0, 2))}
    dstates = weight[:, None] * dc + p["A"] @ dh
    dx = np.zeros_like(x)
    for s, part in (("f", dstates[:, :HIDDEN]), ("b", dstates[:, HIDDEN:])):
        U, carry, dU = p[f"U{s}"], np.zeros((HIDDEN, len(x)), np.float32), 0
        dgates = np.empty((*x.shape[:2], 3 * HIDDEN), np.float32)
        for t, h, z, r, new, un, m in reversed(kept[s]):
            dh_t = carry + part[t]
            step = dh_t * m
            dnew = step * (1 - z) * (1 - new**2)
            dz = step * (h - new) * z * (1 - z)
            dr = dnew * un * r * (1 - r)
            du = np.vstack([dz, dr, dnew * r])
            dgates[:, t] = np.vstack([dz, dr, dnew]).T
            dU = dU + h @ du.T
            carry = dh_t * (1 - m) + step * z + U @ du
        g |= {f"U{s}": dU, f"W{s}": flat(x).T @ flat(dgates), f"b{s}": dgates.sum((0, 1))}
        dx += dgates @ p[f"W{s}"].T
    return g, dx


def gathered(rows: int, index: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values by row."""
    return np.stack([np.bincount(index, v, rows) for v in values.T], 1).astype(np.float32)


class Adam:
    def __init__(self, p: dict):
        self.p, self.t = p, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict, rate: float) -> None:
        self.t += 1
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            self.p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-6)


def trained(texts: list[str], toxic: np.ndarray, weights: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """The network for labelled texts. For the first third of the steps every window has its text's label;
    after that, of a toxic text only the windows that score high are held toxic and the others left out. The
    turn of scores into probabilities is fitted on a fifth of the texts that the network doesn't see."""
    rng = np.random.default_rng(seed)
    encoded = [t.encode() for t in texts]
    words = Words(
        np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)]), NOT_ALNUM
    )
    hashes, place, triples, bounds = distinct_words(words)
    seen = np.bincount(np.unique(place * words.texts + words.text) // max(words.texts, 1), minlength=len(hashes))
    own = np.flatnonzero(seen >= LEAST_TEXTS)
    known = np.zeros(len(hashes), np.int64)
    known[own] = 1 + np.arange(len(own))
    p = initial(len(own), rng) | {"vocabulary": hashes[own]}
    adam = Adam({k: x for k, x in p.items() if k != "vocabulary"})
    n_triples = np.diff(np.append(bounds, len(triples)))
    text, begin, end = windows(words.counts, words.ends)
    y, span = toxic[text].astype(np.float32), np.arange(LENGTH)
    held = rng.permutation(len(texts)) % 5 == 0
    if len(set(toxic[held])) < 2 or len(set(toxic[~held])) < 2:
        held[:] = False
    usable = ~held[text]
    pool = np.flatnonzero(usable)
    for step in range(STEPS):
        if step and step % (STEPS // 6) == 0 and step >= STEPS // 3:
            z = logits(p, inputs(p, known, triples, bounds), place, begin, end)
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, text, z)
            pool = np.flatnonzero(usable & ((y == 0) | (z >= np.minimum(top[text], 2))))
        share = [pool[y[pool] == k] for k in (0, 1)]
        pick = np.concatenate([rng.choice(share[0], BATCH * 2 // 3), rng.choice(share[1], BATCH // 3)])
        index = begin[pick, None] + span
        mask = index < end[pick, None]
        mask &= rng.random(mask.shape) >= DROPPED
        index = np.where(mask, place[np.minimum(index, len(place) - 1)] if len(place) else 0, -1)
        used, row = np.unique(index, return_inverse=True)
        real = used[used >= 0]
        cut = n_triples[real]
        chars = triples[np.repeat(bounds[real] - (np.cumsum(cut) - cut), cut) + np.arange(int(cut.sum()))]
        table = np.zeros((len(used), WORD_DIM + CHAR_DIM), np.float32)
        own_row = known[real] * (rng.random(len(real)) >= UNKNOWN)
        table[used >= 0] = inputs(p, own_row, chars, np.cumsum(cut) - cut)
        row = row.reshape(mask.shape)
        g, dx = gradients(p, table[row], np.ascontiguousarray(mask.T, np.float32), y[pick])
        order = np.argsort(row, axis=None)
        per = np.add.reduceat(flat(dx)[order], np.searchsorted(row.ravel()[order], np.arange(len(used))))[used >= 0]
        g["word"] = gathered(len(p["word"]), own_row, per[:, :WORD_DIM])
        g["char"] = gathered(BUCKETS, chars, np.repeat(per[:, WORD_DIM:] / cut[:, None], cut, axis=0))
        g["word"][0] = 0
        rate = RATE * (1 - 0.9 * step / STEPS)
        adam.step(g, rate)
        for k in ("word", "char"):
            p[k] *= 1 - rate * DECAY
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, logits(p, inputs(p, known, triples, bounds), place, begin, end))
    use = held if held.any() else ~held
    return p | {"scale": platt(top[use], toxic[use], weights[use])}


def platt(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Slope and offset that turn a text's highest logit into a probability, by damped Newton steps."""
    x, beta = np.stack([z, np.ones_like(z)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        q = sigmoid(np.clip(x @ beta, -30, 30))
        hess = (x * (w * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hess, x.T @ (w * (q - y)) + 1e-3 * (beta - [1, 0])), -1, 1)
    return np.array([max(beta[0], 1e-3), beta[1]])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", seed: int = 0) -> dict:
    """The trained network; ``docs`` and ``labels`` share the id column and hold only what may be learnt from."""
    marks = labels.groupBy(col(id_col).alias("id")).agg(F.max(col(label_col)).alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    # only ids and lengths meet the labels; texts are read for the ids of the sample alone
    known = stored(
        texts.select("id", F.length("text").alias("n")).join(marks, "id").groupBy("id", (F.col("y") > 0).cast("int").alias("y")).agg(F.max("n").alias("n")),
        "labelled",
    )
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return {"share": counts.get(1, 0) / total if total else 0.0}
    picked, y, w = [], [], []
    for k in (0, 1):
        sample = known.filter((F.col("y") == k) & (F.col("n") <= MAX_CHARS)).orderBy(F.xxhash64("id"), "id").limit(MAX_TEXTS * (2 - k))
        rows = texts.join(F.broadcast(sample.select("id")), "id").groupBy("id").agg(F.min("text").alias("text")).orderBy("id").collect()
        picked += [r["text"] for r in rows]
        y += [k] * len(rows)
        w += [counts[k] / total / max(len(rows), 1)] * len(rows)
    y = np.array(y, float)
    if len(set(y)) < 2:
        return {"share": counts[1] / total}
    return trained(picked, y, np.array(w) * len(w), seed)


def _scores(model: dict, column: pa.Array) -> Iterator[list[pa.Array]]:
    for at, to, data, offsets in text_slices(column, 2 << 20):  # sums of single precision depend on what is scored together
        if "share" in model:
            yield [pa.array(np.full(to - at, model["share"]))]
            continue
        words = Words(data, offsets, NOT_ALNUM)
        hashes, place, triples, bounds = distinct_words(words)
        vocabulary = model["vocabulary"]
        slot = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
        known = np.where(vocabulary[slot] == hashes, slot + 1, 0) if len(vocabulary) else np.zeros(len(hashes), int)
        text, begin, end = windows(words.counts, words.ends)
        top = np.full(to - at, -np.inf)
        np.maximum.at(top, text, logits(model, inputs(model, known, triples, bounds), place, begin, end))
        yield [pa.array(sigmoid(np.clip(model["scale"][0] * top + model["scale"][1], -30, 30)))]


def score(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The rows with one more column, the probability that the text is toxic."""
    return in_batches(docs, text_col, [T.StructField(score_col, T.DoubleType(), False)], functools.partial(_scores, model))


def without_toxic(docs: DataFrame, model: dict, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text scores below the threshold, with the columns they had."""
    (name,) = fresh(docs.columns, "_toxicity")
    return score(docs, model, text_col, name).filter(col(name) < threshold).drop(name)
