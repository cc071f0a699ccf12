"""Searches of the language model's trie: right, and each distinct head and key once."""
import numpy as np

from plantlake.llm import lm_score
from plantlake.llm.elias_fano import EliasFano, _select

U64 = np.uint64


def test_select_and_find_equal_plain_searches():
    rng = np.random.default_rng(3)
    words = rng.integers(1, 2**64 - 1, 500, dtype=U64, endpoint=True)
    for y in (words, words & words[::-1] | U64(1 << 63), np.full(1, 2**64 - 1, U64)):
        ones = [[i for i in range(64) if int(w) >> i & 1] for w in y]
        for r in (0, 1, 5, 31, 63):
            at = [k for k, o in enumerate(ones) if len(o) > r]
            assert _select(y[at], np.full(len(at), r)).tolist() == [ones[k][r] for k in at]
    for universe, n in ((1, 1), (90, 40), (1 << 20, 3000), (1 << 33, 700), (1 << 40, 1), (1 << 64, 900)):
        values = np.unique(rng.integers(0, universe - 1, n, dtype=U64, endpoint=True))
        asked = np.concatenate((values, rng.integers(0, universe - 1, 300, dtype=U64, endpoint=True)))
        rng.shuffle(asked)
        place = np.minimum(np.searchsorted(values, asked), len(values) - 1)
        found = EliasFano.build(values, universe)
        assert np.array_equal(found.find(asked), np.where(values[place] == asked, place, -1))
        assert np.array_equal(found.get(np.arange(len(values))), values)


def test_repeated_keys_are_searched_once_and_in_order(monkeypatch):
    types = 1000
    keys = np.unique(np.random.default_rng(4).integers(0, 50, 400).astype(U64) << U64(32) |
                     np.random.default_rng(5).integers(0, types, 400).astype(U64))
    seqs, heads, _ = lm_score._ranges(keys, types)
    asked, find = [], EliasFano.find
    monkeypatch.setattr(EliasFano, "find", lambda self, x, *a: asked.append(x) or find(self, x, *a))
    some = np.concatenate((keys[::-1], [U64(99) << U64(32)], keys))
    assert lm_score._find(seqs, some, types).tolist() == [*range(len(keys))[::-1], -1, *range(len(keys))]
    assert [len(x) for x in asked] == [len(heads) + 1, len(keys)]
    assert all((x[1:] > x[:-1]).all() for x in asked)
