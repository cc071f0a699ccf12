"""Elias-Fano sequences over numpy arrays, queried many at a time, and the files that hold them.

A monotone sequence of n values below u is cut into low bits (whole bytes,
stored plainly) and high parts (a bit vector: per high part a one for each of
its values, then a zero).  A directory of zeros before each 64-bit word makes
``select`` a search and a word's byte counts; the end of a bucket is the next
zero.  Searches are quickest for sorted arguments, which walk the arrays in
order.  A file is a JSON line with
the arrays' places, then the arrays; on a local or mounted store it is
memory-mapped, so workers on a machine share its pages.
"""

from __future__ import annotations

import json

import numpy as np
from pyarrow import fs

from .shared import atomic_output

U64 = np.uint64
_ONES, _TOPS = U64(0x0101010101010101), U64(0x8080808080808080)
#: Place of the r-th one (from 0) of a byte, at 8 * byte + r.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for b in range(256) for r in range(8)], np.uint8)


def _select(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) of each 64-bit word, which has more than r ones."""
    pairs = y - ((y >> U64(1)) & U64(0x5555555555555555))
    fours = (pairs & U64(0x3333333333333333)) + ((pairs >> U64(2)) & U64(0x3333333333333333))
    upto = ((fours + (fours >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _ONES  # ones in the bytes up to each
    r = r.astype(U64)
    shift = np.bitwise_count(((r * _ONES) | _TOPS) - upto & _TOPS).astype(U64) << U64(3)  # bits in bytes that end before it
    r -= (upto << U64(8)) >> shift & U64(0xFF)
    return (shift + _IN_BYTE[(y >> shift & U64(0xFF)) << U64(3) | r]).astype(np.int64)


class EliasFano:
    def __init__(self, n: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low, self.high, self.zeros = n, low, high, zeros
        self.shift = U64(8 * low.shape[1])

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values``: sorted uint64 below ``universe``."""
        n = len(values)
        width = 0
        while n and (universe >> (8 * width)) > 2 * n:
            width += 1
        width = min(width, 7)
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width].copy()
        high = (values >> U64(8 * width)).astype(np.int64)
        top = int(high[-1]) if n else 0
        bits = np.zeros((n + top + 1) // 64 * 64 + 64, bool)
        bits[high + np.arange(n)] = True
        words = np.packbits(bits, bitorder="little").view("<u8")
        # Bits behind the last bucket's end count as zeros too; they are never asked for.
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))))[:-1]
        return cls(n, low, words, zeros.astype(np.uint32 if n + top < 1 << 31 else np.int64))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "zeros": self.zeros}

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero (from 0)."""
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), side="right") - 1
        return word * 64 + _select(~self.high[word], k - self.zeros[word])

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the values with this high part."""
        before = np.where(high > 0, self._select0(np.maximum(high - 1, 0)), -1)  # place of the zero before it
        after = before + 1
        rest = ~self.high[after >> 6] >> (after & 63).astype(U64)
        ones = np.bitwise_count((rest & (~rest + U64(1))) - U64(1)).astype(np.int64)  # up to the next zero
        beyond = np.flatnonzero(rest == 0)  # it lies in a later word
        ones[beyond] = self._select0(high[beyond]) - after[beyond]
        start = after - high
        return start, start + ones

    def _low(self, i: np.ndarray) -> np.ndarray:
        width = self.low.shape[1]
        if width in (1, 2, 4):
            return self.low.view(f"<u{width}").ravel()[i].astype(U64)
        if width == 0 or self.n < 3:
            rows = self.low[i]
            return sum((rows[:, b].astype(U64) << U64(8 * b) for b in range(width)), np.zeros(len(i), U64))
        # Rows as overlapping numbers, which reach into the next row; the last row has none.
        size = 4 if width == 3 else 8
        rows = np.ndarray((self.n - 1,), f"<u{size}", np.ascontiguousarray(self.low), 0, (width,))
        out = rows[np.minimum(i, self.n - 2)].astype(U64)
        last = np.flatnonzero(i == self.n - 1)
        out &= U64((1 << 8 * width) - 1)
        out[last] = int.from_bytes(self.low[-1].tobytes(), "little")
        return out

    def find(self, x: np.ndarray, start=None, end=None) -> np.ndarray:
        """Index of each x in the sequence, or -1; with ``start`` and ``end``, within those index ranges.

        The successor of x is searched only among the values with the high part of x."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        high = (x >> self.shift).astype(np.int64)
        known = high < len(self.high) * 64 - self.n
        lo, hi = self._bucket(np.where(known, high, 0))
        lo, hi = np.where(known, lo, self.n), np.minimum(hi, self.n)
        if start is not None:
            lo, hi = np.maximum(lo, start), np.minimum(hi, end)
        stop = hi
        low = x & ((U64(1) << self.shift) - U64(1))
        open_ = np.flatnonzero(lo < hi)
        hi = hi.copy()
        while open_.size:
            l, h = lo[open_], hi[open_]
            mid = (l + h) >> 1
            less = self._low(mid) < low[open_]
            lo[open_] = l = np.where(less, mid + 1, l)
            hi[open_] = h = np.where(less, h, mid)
            open_ = open_[l < h]
        out = np.full(len(x), -1, np.int64)
        inside = np.flatnonzero(lo < stop)
        inside = inside[self._low(lo[inside]) == low[inside]]
        out[inside] = lo[inside]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at the indexes ``i``: high part by select of the i-th one, low bits as stored."""
        before = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros  # ones before each word
        word = np.searchsorted(before, i, side="right") - 1
        place = word * 64 + _select(self.high[word], i - before[word])
        return (place - i).astype(U64) << self.shift | self._low(i)


def write_level(uri: str, meta: dict, sequences: dict[str, EliasFano], plain: dict[str, np.ndarray]) -> None:
    """One file with the sequences and plain arrays."""
    arrays = {f"{name}.{part}": a for name, ef in sequences.items() for part, a in ef.arrays().items()} | plain
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = (at, a.dtype.str, a.shape)
        at += -(-a.nbytes // 64) * 64
    head = json.dumps({"meta": meta, "n": {k: ef.n for k, ef in sequences.items()}, "places": places}).encode()
    head += b" " * (-(len(head) + 1) % 64) + b"\n"
    with atomic_output(uri) as out:
        out.write(head)
        for a in arrays.values():
            data = np.ascontiguousarray(a).tobytes()
            out.write(data + b"\0" * (-len(data) % 64))


def read_level(uri: str) -> tuple[dict, dict[str, EliasFano], dict[str, np.ndarray]]:
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        store = fs.LocalFileSystem(use_mmap=True)
    with store.open_input_file(path) as f:
        data = f.read_buffer()
    view = memoryview(data)
    end = 64
    while view[end - 1] != 10:
        end += 64
    head = json.loads(bytes(view[:end]))
    arrays = {}
    for name, (at, kind, shape) in head["places"].items():
        count = int(np.prod(shape))
        arrays[name] = (np.frombuffer(view, np.dtype(kind), count, end + at) if count
                        else np.empty(0, np.dtype(kind))).reshape(shape)
    sequences = {k: EliasFano(n, *(arrays.pop(f"{k}.{p}") for p in ("low", "high", "zeros")))
                 for k, n in head["n"].items()}
    return head["meta"], sequences, arrays
