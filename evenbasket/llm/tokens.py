"""Words of Arrow string columns as NumPy arrays.

All work is on the UTF-8 bytes: both word grammars of the operators are unions
of ASCII characters and of everything above ASCII, so a byte test is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Words are runs of anything but white space (space, tab, LF, VT, FF, CR).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words are runs of ASCII letters, digits and everything above ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Bytes handled at once; a longer single text is handled alone.
CHUNK = 1 << 20

_RNG = np.random.default_rng(20240229)
_TABLE = _RNG.integers(1, 2**64 - 1, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, base, np.uint64))), dtype=np.uint64)


_cache: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("p", ())) < n:
        size = max(n, CHUNK + 1)
        tables = _powers(_BASE, size), _powers(_INVERSE, size)
        if size > 4 * CHUNK:  # of one giant text: not kept
            return tables
        _cache["p"], _cache["q"] = tables
    return _cache["p"], _cache["q"]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64); a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of consecutive texts."""

    buf: np.ndarray  # lower-cased (A-Z) bytes of all texts
    start: np.ndarray  # byte offsets of each word
    end: np.ndarray
    hash: np.ndarray  # 64-bit hash of each word
    first: np.ndarray  # index of each text's first word, and the number of words at the end

    def text(self, i: int) -> bytes:
        return self.buf[self.start[i] : self.end[i]].tobytes()

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets of the rows in them) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def split_words(data: np.ndarray, offsets: np.ndarray, grammar: np.ndarray) -> Words:
    """Lower-cased words of texts that lie one after the other in ``data``."""
    buf = _LOWER[data]
    inside = grammar[buf]
    n = len(buf)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(buf, empty, empty, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    edge = offsets[(offsets > 0) & (offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edge - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    power, inverse = _power_tables(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_TABLE[buf] * power[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * inverse[start])
    return Words(buf, start, end, hashes, np.searchsorted(start, offsets))


class Spans(NamedTuple):
    """Words of consecutive texts, without the bytes."""

    start: np.ndarray  # byte offsets of each word
    end: np.ndarray
    hash: np.ndarray  # 64-bit hash of each word
    first: np.ndarray  # index of each text's first word, and the number of words at the end


def word_spans(data: np.ndarray, offsets: np.ndarray, grammar: np.ndarray, lower: bool = True, section: int = CHUNK) -> Spans:
    """Words of texts that lie one after the other in ``data``, with the hashes of ``split_words``.

    Goes through the bytes in sections, so that what is held of a long text
    besides its bytes grows with its words alone. A word across sections is put
    together from its parts: the hash is a polynomial of the bytes.
    """
    power, inverse = _power_tables(min(len(data), section) + 1)
    starts, ends, values = [], [], []
    for at in range(0, len(data), section):
        buf = data[at : at + section]
        buf = _LOWER[buf] if lower else buf
        inside, n = grammar[buf], len(buf)
        edge = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, at + n, "left")] - at
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        before[edge] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        after[edge - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        if not len(start):
            continue
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[buf] * power[:n], out=sums[1:])
        value = (sums[end] - sums[start]) * inverse[start]
        start, end = start + at, end + at
        if ends and ends[-1][-1] == start[0] == at and offsets[np.searchsorted(offsets, at)] != at:
            far = pow(_BASE, int(at - starts[-1][-1]), 2**64)
            values[-1][-1] = (int(values[-1][-1]) + int(value[0]) * far) % 2**64
            ends[-1][-1] = end[0]
            start, end, value = start[1:], end[1:], value[1:]
        if len(start):
            starts.append(start)
            ends.append(end)
            values.append(value)
    if not starts:
        none = np.zeros(0, np.int64)
        return Spans(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    start = np.concatenate(starts)
    return Spans(start, np.concatenate(ends), mix(np.concatenate(values)), np.searchsorted(start, offsets))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive words (order counts)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, 0x243F6A8885A308D3 + n, np.uint64)
    for k in range(n):
        out = (out ^ hashes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix(out)
