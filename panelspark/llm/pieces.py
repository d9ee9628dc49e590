"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut where a space (or another word's start) follows something else: no piece of a model whose pieces hold
spaces only in front reaches over such a place. The distinct words of a slice of texts lie in flat numpy arrays
of symbols. In each round every word finds its best-ranked pair of neighbours (a segmented minimum) and merges
it at all places, from the left; arrays are compacted, words without a pair are done. Merging all places at once
gives what merging one at a time gives unless a longer piece that begins or ends with the merged one ranks before
it; for such pieces only the leftmost place is merged.

Characters that the model has no piece for become the pieces of their UTF-8 bytes. Decoding is a lookup of
bytes by id and one pass over them; bytes that are no UTF-8 become U+FFFD, one for each.

Defined cases: null and empty texts have no ids and decode to the empty text; ids outside the model raise.
The input may have further columns of any name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from panelspark.llm.kernels import U64, mix, powers, text_slices
from panelspark.llm.tables import in_batches

SPACE = "▁"
NEVER = np.int32(2**31 - 1)
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5
#: Words of this many bytes go through the rounds by themselves, so that a long one doesn't keep the others.
LONG = 256


@dataclass(frozen=True)
class Model:
    """Tables of a BPE model. Symbols are piece ids, and further numbers for characters that only pieces hold."""

    char: np.ndarray  # symbol by code point; -1: no piece holds it
    keys: np.ndarray  # pairs of symbols, sorted
    merged: np.ndarray  # the symbol that a pair becomes
    rank: np.ndarray  # of a pair, best first
    together: np.ndarray  # by symbol: whether it may be merged at all places at once
    code: np.ndarray  # code point of the symbols beyond the pieces
    pieces: int
    byte: np.ndarray  # id by byte
    dummy: bool  # whether a space is put in front
    out: tuple[bytes, ...]  # what an id decodes to
    is_byte: np.ndarray
    skipped: np.ndarray  # control ids decode to nothing
    spaced: np.ndarray  # pieces that begin with a space


@functools.cache
def load(path: str) -> Model:
    """The model file; it is a small local file of each machine, its path a parameter."""
    proto = model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
        raise ValueError("only BPE models with byte fallback that leave the text as it is")
    if any(p.type in (_USER, _UNUSED) for p in proto.pieces):
        raise ValueError("models with user-defined or unused pieces aren't supported")
    ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
    if any(SPACE in p.lstrip(SPACE) for p in ids):
        raise ValueError("a piece holds a space after its start")
    n, extra = len(proto.pieces), sorted({c for p in ids for c in p} - ids.keys())
    symbols = ids | {c: n + i for i, c in enumerate(extra)}
    char = np.full(0x110000, -1, np.int32)
    for c in {c for p in ids for c in p}:
        char[ord(c)] = symbols[c]
    order = {s: r for r, s in enumerate(sorted({-proto.pieces[i].score for i in ids.values()}))}
    rank_of = {p: order[-proto.pieces[i].score] for p, i in ids.items()}
    pairs, together = {}, np.ones(n + len(extra), bool)
    for p, i in ids.items():
        for k in range(1, len(p)):
            if p[:k] in symbols and p[k:] in symbols:
                pairs[symbols[p[:k]] * len(together) + symbols[p[k:]]] = (i, rank_of[p])
            for part in (p[:k], p[k:]):
                if part in ids and rank_of[part] >= rank_of[p]:
                    together[ids[part]] = False
    keys = np.array(sorted(pairs), np.int64)
    merged, rank = (np.array([pairs[k][j] for k in keys.tolist()], np.int32) for j in (0, 1))
    byte = np.full(256, -1, np.int32)
    is_byte, skipped, out = np.zeros(n, bool), np.zeros(n, bool), []
    for i, p in enumerate(proto.pieces):
        if p.type == _BYTE:
            byte[int(p.piece[3:5], 16)] = i
            is_byte[i] = True
            out.append(bytes([int(p.piece[3:5], 16)]))
        elif p.type == _CONTROL:
            skipped[i] = True
            out.append(b"")
        else:
            text = proto.trainer_spec.unk_surface if p.type == _UNKNOWN else p.piece.replace(SPACE, " ")
            out.append(text.encode())
    return Model(char, keys, merged, rank, together, np.array([ord(c) for c in extra], np.int32), n, byte, spec.add_dummy_prefix, tuple(out), is_byte, skipped, np.array([p.piece[:1] == SPACE for p in proto.pieces]))


def _pairs(m: Model, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank (NEVER: no such piece) and result of pairs of symbols."""
    key = left.astype(np.int64) * len(m.together) + right
    key[(left < 0) | (right < 0)] = -1
    at = np.minimum(np.searchsorted(m.keys, key), len(m.keys) - 1)
    hit = m.keys[at] == key
    return np.where(hit, m.rank[at], NEVER), m.merged[at]


def merge_rounds(m: Model, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as flat code points and where each starts (none is empty). Returns the symbols that are left (or -1
    minus the code point) and the word of each."""
    symbol = m.char[codes]
    symbol = np.where(symbol >= 0, symbol, -1 - codes)
    word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(codes))))
    place = np.arange(len(codes))  # the order in which symbols go back together in the end
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    last = np.append(word[1:] != word[:-1], True)
    rank, result = _pairs(m, symbol, np.append(symbol[1:], -1))
    rank[last] = NEVER
    while len(symbol):
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        size = np.diff(np.append(begin, len(word)))
        best = np.minimum.reduceat(rank, begin)
        live = np.repeat(best < NEVER, size)
        if not live.all():
            over = ~live
            done.append((place[over], word[over], symbol[over]))
            symbol, word, place, rank, result = symbol[live], word[live], place[live], rank[live], result[live]
            continue
        take = rank == np.repeat(best, size)
        at = np.flatnonzero(take)
        # of overlapping places every other one from the left; of pieces that aren't safe together the first in the word
        run = np.append(True, at[1:] != at[:-1] + 1)
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        first = np.append(True, word[at][1:] != word[at][:-1])
        at = at[np.where(m.together[result[at]], nth % 2 == 0, first)]
        symbol[at] = result[at]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        place_of = np.cumsum(keep) - 1
        symbol, word, place, rank, result = symbol[keep], word[keep], place[keep], rank[keep], result[keep]
        now = place_of[at]
        changed = np.unique(np.concatenate([now, now[now > 0] - 1]))
        right = np.minimum(changed + 1, len(symbol) - 1)
        same = (right > changed) & (word[right] == word[changed])
        r, z = _pairs(m, symbol[changed], symbol[right])
        rank[changed], result[changed] = np.where(same, r, NEVER), z
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    places, words, symbols = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(places)
    return symbols[order], words[order]


def ids_of(m: Model, symbols: np.ndarray, words: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of symbols, and of how many ids each word consists: characters without a piece become bytes."""
    piece = (symbols >= 0) & (symbols < m.pieces)
    if piece.all():
        return symbols.astype(np.int32), np.bincount(words, minlength=n_words)
    code = np.where(symbols < 0, -1 - symbols, 0)
    held = symbols >= m.pieces
    code[held] = m.code[symbols[held] - m.pieces]
    width = np.where(piece, 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
    begin = np.cumsum(width) - width
    out = np.empty(int(width.sum()), np.int32)
    out[begin[piece]] = symbols[piece]
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
    for w in (1, 2, 3, 4):
        at = np.flatnonzero(~piece & (width == w))
        for k in range(w):
            bits = code[at] >> (6 * (w - 1 - k))
            out[begin[at] + k] = m.byte[(lead[w] | bits) if k == 0 else (0x80 | (bits & 0x3F))]
    return out, np.bincount(words, width, minlength=n_words).astype(np.int64)


def _words(data: np.ndarray, offsets: np.ndarray, dummy: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with a space in front of each text that isn't empty, where words start, the text of each."""
    if dummy:
        some = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[some], 0x20)
        offsets = offsets + np.append(0, np.cumsum(np.diff(offsets) > 0))
    space = data == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(start)
    return data, starts, np.searchsorted(offsets, starts, "right") - 1


def encode_slice(m: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts in a row, and how many each has."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(n, np.int64)
    data, starts, text = _words(data, offsets, m.dummy)
    length = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.repeat(starts, length)
    value = (data.astype(U64) + U64(1)) * powers(int(length.max()))[place]
    _, first, word = np.unique(mix(np.add.reduceat(value, starts) + length.astype(U64)), return_index=True, return_inverse=True)
    counts = np.zeros(len(first), np.int64)
    parts = []
    for some in (np.flatnonzero(length[first] <= LONG), np.flatnonzero(length[first] > LONG)):
        if not len(some):
            parts.append((np.zeros(0, np.int32), some))
            continue
        size = length[first[some]]
        bound = np.cumsum(size) - size
        raw = data[np.repeat(starts[first[some]] - bound, size) + np.arange(int(size.sum()))]
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.int32)
        begin = np.cumsum((raw & 0xC0) != 0x80)[bound] - 1
        codes = np.where(codes == 0x20, ord(SPACE), codes)
        symbols, words = merge_rounds(m, codes, begin)
        ids, many = ids_of(m, symbols, words, len(some))
        counts[some] = many
        parts.append((ids, some))
    pool = np.concatenate([p[0] for p in parts])
    where = np.empty(len(first), np.int64)
    at = 0
    for ids, some in parts:
        where[some] = at + np.cumsum(counts[some]) - counts[some]
        at += len(ids)
    many = counts[word]
    begin = np.cumsum(many) - many
    out = pool[np.repeat(where[word] - begin, many) + np.arange(int(many.sum()))]
    return out, np.bincount(text, many, minlength=n).astype(np.int64)


def decode_slice(m: Model, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of runs of ids."""
    out, at = [], 0
    table, byte = m.out, m.is_byte
    plain = not byte[ids].any() if len(ids) else True
    for n in counts.tolist():
        part = ids[at : at + n]
        at += n
        if n and m.dummy:
            head = np.flatnonzero(~m.skipped[part])
            strip = len(head) and m.spaced[part[head[0]]]
        else:
            strip = False
        text = []
        cuts = () if plain else np.flatnonzero(m.skipped[part])
        for run in np.split(part, cuts) if len(cuts) else (part,):  # no character reaches over a control id
            raw = b"".join(map(table.__getitem__, run.tolist()))
            if strip and raw:
                raw, strip = raw[1:], False
            try:
                text.append(raw.decode())
            except UnicodeDecodeError:
                if plain:
                    raise
                text.append(_lenient(raw))
        out.append("".join(text))
    return out


def _lenient(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        b = raw[at]
        n = 1 if b < 0x80 else 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
        try:
            out.append(raw[at : at + n].decode() if n else "�")
        except UnicodeDecodeError:
            out.append("�")
            n = 1
        at += max(n, 1)
    return "".join(out)


def _encoded(path: str, decoded: bool, column: pa.Array) -> Iterator[list[pa.Array]]:
    m = load(path)
    for at, to, _, _ in text_slices(column):
        spaced = pc.replace_substring(pc.fill_null(column.slice(at, to - at), ""), SPACE, " ")
        for _, _, data, offsets in text_slices(spaced):  # one slice: no text is longer than before
            ids, counts = encode_slice(m, data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids))
            yield [lists, pa.array(decode_slice(m, ids, counts), pa.string())] if decoded else [lists]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """The rows with the ids of the text and, if a name for it is given, what the ids decode to."""
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_col:
        added.append(T.StructField(decoded_col, T.StringType(), False))
    return in_batches(docs, text_col, added, functools.partial(_encoded, model_path, bool(decoded_col)))


def _decoded(path: str, column: pa.Array) -> Iterator[list[pa.Array]]:
    m = load(path)
    lists = column.fill_null([]) if column.null_count else column
    counts = pc.list_value_length(lists).to_numpy()
    yield [pa.array(decode_slice(m, lists.flatten().to_numpy(), counts), pa.string())]


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text that the ids decode to; null ids are none."""
    return in_batches(rows, ids_col, [T.StructField(text_col, T.StringType(), False)], functools.partial(_decoded, model_path))
