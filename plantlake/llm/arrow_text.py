"""Text helpers that run inside Spark's Arrow UDFs.

Spark partitions the rows; these helpers only turn one Arrow batch into
numpy arrays of word hashes.  A batch is worked through in slices of bounded
bytes (a single longer text is a slice of its own), so a worker's memory does
not depend on how many long texts meet in a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4 << 20
U64 = np.uint64


def slices(arr: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """``arr`` (strings; null becomes empty) in row ranges of at most ``max_bytes``, one row at least."""
    arr = pc.fill_null(arr.cast(pa.string()) if arr.type != pa.string() else arr, "")
    ends = np.cumsum(pc.binary_length(arr).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(arr):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield arr.slice(at, stop - at)
        at = stop


def release() -> None:
    """Give freed memory back to the system: a worker is kept for later stages, and what it holds counts there too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def raw_bytes(arr: pa.Array) -> tuple[np.ndarray, bytes]:
    """(row offsets, bytes) of a null-free string array."""
    offsets = np.frombuffer(arr.buffers()[1], np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    data = arr.buffers()[2]
    piece = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data is not None else b""
    return offsets - offsets[0], piece


def translated(arr: pa.Array, table: bytes) -> pa.Array:
    """``arr`` with every byte mapped by ``table`` (which must keep bytes above 0x7F)."""
    offsets, data = raw_bytes(arr)
    return pa.StringArray.from_buffers(len(arr), pa.py_buffer(offsets.astype(np.int32)),
                                       pa.py_buffer(data.translate(table)))


def split_words(arr: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row offsets, words): maximal runs of bytes other than 0x20 and 0x09-0x0D."""
    lists = pc.ascii_split_whitespace(arr)
    values = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    full = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    if full.all():
        return offsets, values
    kept = np.concatenate(([0], np.cumsum(full)))
    return kept[offsets], values.filter(pa.array(full))


def _alnum_table() -> bytes:
    table = bytearray(b" " * 128) + bytearray(range(128, 256))
    for c in range(128):
        if chr(c).isdigit() or chr(c).isalpha():
            table[c] = ord(chr(c).lower())
    return bytes(table)


#: A-Z lower-cased; ASCII letters and digits and all bytes above 0x7F stay; the rest are blanks.
ALNUM = _alnum_table()


def hashed(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word (each distinct word of the slice is hashed once)."""
    coded = words.dictionary_encode()
    one = xxhash.xxh3_64_intdigest
    table = np.fromiter((one(w, seed) for w in coded.dictionary.cast(pa.binary()).to_pylist()),
                        U64, len(coded.dictionary))
    return table[coded.indices.to_numpy()] if len(words) else np.empty(0, U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (every output bit depends on every input bit)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` consecutive entries of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    out = mix(h[:n] + U64(width))
    for i in range(1, width):
        out = mix(out * U64(0x9E3779B97F4A7C15) + h[i:i + n])
    return out


def window_rows(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, row) of every window of ``width`` words that lies inside one row.

    A row with fewer words, but not none, has one window that starts at its
    first word (shorter than ``width``); it is not part of the result.
    """
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    starts = np.arange(len(rows)) - first[rows] + offsets[rows]
    return starts, rows


def shingles(arr: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, words per row) of all word windows of ``width`` in a slice of texts.

    Words are runs of ASCII letters (lower-cased), digits and characters above
    U+007F.  A row of fewer words has its whole word list as its one shingle;
    a row without words has none.
    """
    offsets, words = split_words(translated(arr, ALNUM))
    h = hashed(words)
    starts, rows = window_rows(offsets, width)
    out = rolling(h, width)[starts] if len(starts) else np.empty(0, U64)
    n_words = np.diff(offsets)
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        extra = np.array([xxhash.xxh3_64_intdigest(h[offsets[r]:offsets[r + 1]].tobytes()) for r in short], U64)
        out, rows = np.concatenate([out, extra]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        out, rows = out[order], rows[order]
    return out, rows, n_words
