"""Words and n-grams of Arrow text columns as numpy arrays, without a Python loop over words.

A word's hash is a polynomial in its bytes modulo 2**64, read off one running
sum over the whole buffer: for an odd base R, ``(H[end] - H[start]) / R**start``
doesn't depend on where in the buffer the word stands.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 2**64)
_POW: dict[str, np.ndarray] = {"r": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

SPACE, WORD, MARK = 0, 1, 2


def _classes() -> np.ndarray:
    c = np.full(256, MARK, np.uint8)
    c[0x80:] = WORD
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
        c[lo : hi + 1] = WORD
    c[0x20] = SPACE
    c[0x09:0x0E] = SPACE
    return c


#: Byte classes: white space, letters and digits (every non-ASCII byte too), other marks.
CLASSES = _classes()
#: The same with marks as part of words: words are what white space divides.
BLANKS = np.where(CLASSES == SPACE, SPACE, WORD).astype(np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["r"]) < n:
        size = max(n, SLICE_BYTES + 4096)
        with np.errstate(over="ignore"):
            for k, base in (("r", _R), ("i", _R_INV)):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                _POW[k] = np.multiply.accumulate(step)
    return _POW["r"][:n], _POW["i"][:n]


def give_back() -> None:
    """Return freed memory to the system: allocators keep it, and a driver that has learned from texts once would hold their space to its end."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        h = h ^ (h >> np.uint64(29))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def slices(text: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them) for runs of rows; nulls are empty.

    ``lower``: Unicode lower case, else the bytes as they are.
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    text = pc.fill_null(text.cast(pa.large_string()), "")
    n = len(text)
    off = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1] if n else np.zeros(1, np.int64)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + SLICE_BYTES, "right")) - 1)
        part = text.slice(at, end - at)
        if lower:
            part = pc.utf8_lower(part)
        own = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = part.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[own[0] : own[-1]] if data is not None and own[-1] > own[0] else np.zeros(0, np.uint8)
        yield at, end, raw, own - own[0]
        at = end


def spans(raw: np.ndarray, off: np.ndarray, classes: np.ndarray = CLASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs of one class other than SPACE; runs end with their row."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    c = classes[raw]
    cut = np.empty(n, bool)
    cut[0] = True
    np.not_equal(c[1:], c[:-1], out=cut[1:])
    cut[off[:-1][off[:-1] < n]] = True
    s = np.flatnonzero(cut)
    e = np.append(s[1:], n)
    keep = c[s] != SPACE
    s, e = s[keep], e[keep]
    return s, e, np.searchsorted(off, s, "right") - 1


def word_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, ASCII letters in lower case."""
    n = len(raw)
    if not len(s):
        return np.zeros(0, np.uint64)
    r, inv = _powers(n + 1)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * r[:n], out=run[1:])
        return mix((run[e] - run[s]) * inv[s])


def joined(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of each run of k words in one row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(0x9FB21C651E98DF25) + h[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(out[at]), at


def bounds(row: np.ndarray, rows: int) -> np.ndarray:
    """Where each row's items begin, and the end: row ids ascend."""
    return np.searchsorted(row, np.arange(rows + 1))


def row_sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of x between the bounds; empty rows give 0."""
    run = np.zeros((len(x) + 1, *x.shape[1:]), np.float64)
    np.cumsum(x, axis=0, out=run[1:])
    return run[at[1:]] - run[at[:-1]]
