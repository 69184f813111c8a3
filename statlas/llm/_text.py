"""Word and shingle hashing over Arrow string buffers, in numpy.

Texts are handled as UTF-8 bytes. A batch is cut into chunks of whole texts, so the working
memory is a small multiple of CHUNK or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
U = np.uint64

#: Bytes that separate words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Separators of normalised words: every ASCII byte that is no letter or digit.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(b).isalnum() for b in range(128)]

#: Lower case for A-Z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; changes x in place."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) for slices of about CHUNK bytes; a null is an empty text."""
    array = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    n = len(array)
    if not n:
        return
    _, raw_offsets, raw = array.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[array.offset : array.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its first word (with the total at the end)."""
    n = len(data)
    word = np.zeros(n + 2, bool)
    word[1:-1] = ~separators[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, read eight bytes at a time."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = ends - starts
    h = left.astype(U) * U(0x9E3779B97F4A7C15)
    at, which = starts, slice(None)
    while True:
        short = np.minimum(left, 8).astype(U)
        h[which] = mix((h[which] ^ (eight[at] & (U(0xFFFFFFFFFFFFFFFF) >> ((U(8) - short) << U(3))))) + U(0x632BE59BD9B4E019))
        more = left > 8
        if not more.any():
            return h
        which = np.flatnonzero(more) if isinstance(which, slice) else which[more]
        at, left = at[more] + 8, left[more] - 8


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 18)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, U)
            x[0] = 1
            out.append(np.cumprod(x))
        if size > 1 << 23:
            return out[0], out[1]
        _powers[base] = (out[0], out[1])
    return _powers[base]


def grams(hashed: np.ndarray, k: int, base: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """Hash of the k consecutive words that start at each word, over text borders too; shorter by k - 1."""
    n = len(hashed)
    if n < k:
        return np.zeros(0, U)
    up, down = _power(base, n)
    total = np.zeros(n + 1, U)
    np.cumsum(hashed * up[:n], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[: n - k + 1])


def inside(first: np.ndarray, k: int) -> np.ndarray:
    """Which k-grams (as many as grams() gives) lie within one text. first: as words() gives it."""
    n = int(first[-1])
    ok = np.ones(max(0, n - k + 1), bool)
    for e in first[1:-1] if len(first) < 64 else ():
        ok[max(0, e - k + 1) : e] = False
    if len(first) >= 64:
        text = np.repeat(first[1:], np.diff(first))
        ok = np.arange(len(ok)) + k <= text[: len(ok)]
    return ok


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
