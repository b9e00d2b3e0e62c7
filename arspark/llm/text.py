"""Words and shingles of whole Arrow text columns, as numpy arrays.

A text column arrives as one byte buffer plus offsets, so words are found and
hashed for a whole block of documents at once; there is no Python loop per
word. Blocks hold at most ``BLOCK_BYTES`` of text (at least one document), so
memory in a task does not follow the batch size.

Word hashes are 64 bits, built from 8-byte lanes of the word. Equal words have
equal hashes; two different words share one with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
#: Words of more lanes than this are hashed one by one.
MAX_LANES = 32

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xBF58476D1CE4E5B9)
_C3 = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h *= _C2
    h ^= h >> np.uint64(27)
    h *= _C3
    h ^= h >> np.uint64(31)
    return h


def odd(k: int) -> np.uint64:
    """The k-th odd multiplier of a fixed sequence."""
    return np.uint64(((k + 1) * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF | 1)


def ascii_lower() -> np.ndarray:
    """Byte table that lower-cases A-Z and nothing else."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


#: Bytes of a word: everything but space and \x09-\x0D.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of a word: 0-9, a-z (after lower-casing) and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
LOWER = ascii_lower()


def as_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and int64 offsets (n + 1) of a string or binary column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)):
        col = col.cast(pa.large_binary() if pa.types.is_binary(col.type) else pa.large_string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges [i, j) of at most ``most`` bytes, or one row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def hash_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice of ``data``, whose last 8 bytes are padding."""
    lens = ends - starts
    lanes = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    h = mix((lanes[starts] & _MASKS[np.minimum(lens, 8)]) + (lens.astype(np.uint64) * _C1))
    more, k = np.flatnonzero(lens > 8), 1
    while len(more):
        if k > MAX_LANES:
            import xxhash
            buf = data.tobytes()
            for w in more.tolist():
                h[w] = xxhash.xxh3_64_intdigest(buf[starts[w]:ends[w]])
            break
        part = lanes[starts[more] + 8 * k] & _MASKS[np.minimum(lens[more] - 8 * k, 8)]
        h[more] = mix((h[more] ^ part) * _C1 + np.uint64(k))
        k += 1
        more = more[lens[more] > 8 * k]
    return h


class Words:
    """Words of rows [i, j) of a text column.

    ``hash``: 64-bit hash of each word; ``first``: index of each row's first
    word, with the total at the end; ``starts`` and ``ends``: byte positions in
    ``data``.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, i: int, j: int, keep: np.ndarray, table: np.ndarray = LOWER):
        lo, hi = int(offsets[i]), int(offsets[j])
        n = hi - lo
        self.data = data = np.zeros(n + 8, dtype=np.uint8)
        np.take(table, raw[lo:hi], out=data[:n])
        off = offsets[i:j + 1] - lo
        k = keep[data[:n]]
        s, e = k.copy(), k.copy()
        s[1:] &= ~k[:-1]
        e[:-1] &= ~k[1:]
        at = off[:-1][off[:-1] < off[1:]]  # rows that aren't empty
        s[at] = k[at]
        at = off[1:][off[:-1] < off[1:]] - 1
        e[at] = k[at]
        self.starts = np.flatnonzero(s)
        self.ends = np.flatnonzero(e) + 1
        self.first = np.searchsorted(self.starts, off)
        self.off = off
        self.hash = hash_slices(self.data, self.starts, self.ends)

    def rows_of(self, first: np.ndarray | None = None) -> np.ndarray:
        """Row of each word (or of each item counted by ``first``)."""
        first = self.first if first is None else first
        return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes, rows not regarded; len(h) - n + 1 values."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    out = h[:len(h) - n + 1] * odd(0)
    for k in range(1, n):
        out += h[k:len(h) - n + 1 + k] * odd(k)
    out += np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mix(out)


def shingle_sets(w: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each row: (values, first), sorted by value inside a row.

    A row of fewer than n words, but not none, has its whole sequence as its one shingle.
    """
    count = np.diff(w.first)
    g = grams(w.hash, n)
    take = np.maximum(count - n + 1, 0)
    rows = np.repeat(np.arange(len(count)), take)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take) + np.repeat(w.first[:-1], take)
    vals = g[at]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.array([grams(w.hash[w.first[r]:w.first[r + 1]], int(count[r]))[0] for r in short], dtype=np.uint64)
        rows, vals = np.concatenate([rows, short]), np.concatenate([vals, extra])
    order = np.lexsort((vals, rows))
    rows, vals = rows[order], vals[order]
    if len(vals):
        keep = np.ones(len(vals), dtype=bool)
        keep[1:] = (vals[1:] != vals[:-1]) | (rows[1:] != rows[:-1])
        rows, vals = rows[keep], vals[keep]
    return vals, np.searchsorted(rows, np.arange(len(count) + 1))
