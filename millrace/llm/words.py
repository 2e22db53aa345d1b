"""Vectorised tokenising and hashing of whole Arrow text columns with numpy.

All functions work on the UTF-8 bytes of a batch at once, so that no Python
code runs per word. A hash of a word depends on its bytes alone, a hash of a
window on its words alone, whatever batch, task or machine they are read in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _lut(member) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


#: `[^\x20\x09-\x0D]+` on UTF-8 bytes.
SPACED = _lut(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z are lower-cased.
ALNUM = _lut(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)

_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_FOLDED = _BYTE.copy()
_FOLDED[0x41:0x5B] = _BYTE[0x61:0x7B]
_POWERS = np.ones(64, dtype=U64)
_BASE = U64(0xD6E8FEB86659FD93)


def _powers(n: int) -> np.ndarray:
    """The first n powers of the base; the table grows with the longest word seen."""
    global _POWERS
    if len(_POWERS) < n or _POWERS[1] != _BASE:
        p = np.full(max(n, 64), _BASE, dtype=U64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


@dataclass
class Words:
    """Words of several texts: bounds in the bytes, hashes, and where each text's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of len(texts) + 1: words first[i] to first[i + 1] are of text i

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(texts: pa.Array, member: np.ndarray = SPACED, fold: bool = False) -> Words:
    """Split every text into maximal runs of member bytes. fold: A-Z count as a-z."""
    data, offsets = raw(texts)
    inside = member[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    if len(data):
        before[0] = False
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(data):
        after[-1] = False
        cuts = offsets[1:-1]
        after[cuts[cuts > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    if len(start):
        length = end - start
        begin = np.cumsum(length) - length
        kind = np.int32 if len(data) < 1 << 31 else np.int64
        rel = np.arange(int(length.sum()), dtype=kind) - np.repeat(begin.astype(kind), length)
        value = (_FOLDED if fold else _BYTE)[data[inside]]
        value *= _powers(int(length.max()) + 1)[rel]
        hashed = mix(np.add.reduceat(value, begin) + length.astype(U64))
    else:
        hashed = np.zeros(0, U64)
    return Words(data, start, end, hashed, np.searchsorted(start, offsets))


def windows(hashed: np.ndarray, n: int, base: int = 0x9FB21C651E98DF25) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes, by doubling: one for each start but the last n - 1."""
    if len(hashed) < n:
        return np.zeros(0, U64)
    total, have, power, done = None, mix(hashed ^ U64(base)), U64(base | 1), 0
    width, step = 1, power
    bits = n
    while bits:
        if bits & 1:
            part = have[done : len(have)]
            total = part.copy() if total is None else total[: len(part)] * step + part[: len(total)]
            done += width
        bits >>= 1
        if bits:
            have = have[: len(have) - width] * step + have[width:]
            width *= 2
            with np.errstate(over="ignore"):
                step = U64((int(step) * int(step)) & 0xFFFFFFFFFFFFFFFF)
    return mix(total[: len(hashed) - n + 1])


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Which word starts a window of n words that stays in its text, as a mask over all words but the last n - 1."""
    total = int(first[-1])
    ok = np.zeros(total + 1, dtype=np.int32)
    count = np.diff(first)
    long = count >= n
    np.add.at(ok, first[:-1][long], 1)
    np.add.at(ok, first[1:][long] - n + 1, -1)
    return np.cumsum(ok[:-1])[: max(0, total - n + 1)].astype(bool)


def cover(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """A mask of the words that lie in a window of n words that begins at one of starts."""
    edge = np.zeros(total + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + n, total), -1)
    return np.cumsum(edge[:-1]) > 0


def chunks(batches, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has about `most` bytes of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size) // most
        edges = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else []
        for a, b in zip(edges, [*edges[1:], len(size)], strict=True):
            yield batch.slice(int(a), int(b - a))
