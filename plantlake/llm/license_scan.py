"""License scan: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Texts and templates are word lists (runs of ASCII letters, lower-cased,
digits, and characters above U+007F).  The hashes of ``K`` consecutive words
are winnowed (the smallest of every ``W`` in a row), so a shared run of
``K + W - 1`` words always shares a fingerprint.  The templates' fingerprints
form an inverted index: fingerprint -> (template, place).  A document's
winnowed hashes found there vote for a template and a diagonal.  Votes that
advance in both texts, each within ``BAND`` diagonals of the one before, chain
into one candidate, so every occurrence is its own.  The template is aligned
to the document in a band around the chain, between the chains of other
occurrences: the longest common word sequence with at most ``BAND`` words
skipped either way between votes.  A match is reported if it covers at least
``MIN_COVERAGE`` of the template.

Spark part: a map over the text column; the index depends on the fixed
templates only.

Edge cases: a null text has no words; a template found several times is
reported each time, of overlapping matches of one template only the best; ties
go to the earlier one; repeated rows are each reported.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_text import ALNUM, U64, hashed, rolling, slices, split_words, translated

K, W = 3, 3
BAND = 8
MIN_COVERAGE = 0.6
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: License notices as they are commonly written.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def winnowed(grams: np.ndarray) -> np.ndarray:
    """Places that hold the smallest of some ``W`` consecutive hashes (all of a shorter list's smallest)."""
    n = len(grams)
    if n == 0:
        return np.empty(0, np.int64)
    w = min(W, n)
    low = np.lib.stride_tricks.sliding_window_view(grams, w).min(axis=1)
    starts = np.arange(n)[:, None] - np.arange(w)
    ok = (starts >= 0) & (starts <= n - w)
    return np.flatnonzero((ok & (low[np.clip(starts, 0, n - w)] == grams[:, None])).any(axis=1))


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = []
        posts = []
        for t, text in enumerate(templates.values()):
            h = hashed(split_words(translated(pa.array([text]), ALNUM))[1])
            self.words.append(h)
            grams = rolling(h, K)
            posts += [(int(grams[i]), t, int(i)) for i in winnowed(grams)]
        posts.sort()
        self.keys = np.array([p[0] for p in posts], U64)
        self.template = np.array([p[1] for p in posts])
        self.place = np.array([p[2] for p in posts])
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.keys & U64(0xFFFF)).astype(np.int64)] = True

    def candidates(self, offsets: np.ndarray, h: np.ndarray):
        """(row, template, diagonal, spread, start, end) of the vote chains of a slice of documents; the words of
        the occurrence lie in [start, end) of its row."""
        grams = rolling(h, K)
        at = np.flatnonzero(self.seen[(grams & U64(0xFFFF)).astype(np.int64)])
        at = at[self.keys[np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)] == grams[at]]
        row = np.searchsorted(offsets, at, side="right") - 1
        last = offsets[row + 1] - K  # the row's last gram
        at, row, last = (x[at <= last] for x in (at, row, last))
        first = offsets[row]
        width = np.minimum(W, last - first + 1)
        chosen = np.zeros(len(at), bool)
        for back in range(W):
            start = at - back
            ok = (start >= first) & (start + width - 1 <= last) & (back < width)
            low = np.full(len(at), np.iinfo(np.uint64).max, U64)
            for i in range(W):
                inside = ok & (i < width)
                low[inside] = np.minimum(low[inside], grams[(start + i)[inside]])
            chosen |= ok & (low == grams[at])
        votes = []
        for i, r in zip(at[chosen].tolist(), row[chosen].tolist()):
            a = int(np.searchsorted(self.keys, grams[i], side="left"))
            while a < len(self.keys) and self.keys[a] == grams[i]:
                where = i - int(offsets[r])
                votes.append((r, int(self.template[a]), where, int(self.place[a])))
                a += 1
        out: list[tuple] = []
        for (r, t), group in groupby(sorted(votes), key=lambda v: v[:2]):
            out += [(r, t, *c) for c in _chains([v[2:] for v in group], len(self.words[t]))]
        return out


def _chains(votes: list[tuple[int, int]], size: int) -> list[tuple[int, int, int, int]]:
    """(diagonal, spread, start, end) per chain of one template's (word, place) votes in one document."""
    chains: list[list[int]] = []  # first word, first diagonal, last word, last place, least and largest diagonal
    live: list[list[int]] = []
    for where, place in votes:
        d = where - place
        live = [c for c in live if where - c[2] <= size + BAND]
        fits = [c for c in live if c[2] < where and c[3] < place and abs(d - c[2] + c[3]) <= BAND]
        if fits:
            c = min(reversed(fits), key=lambda c: abs(d - c[2] + c[3]))
            c[2:] = [where, place, min(c[4], d), max(c[5], d)]
        else:
            chains.append([where, d, where, place, d, d])
            live.append(chains[-1])
    # An occurrence ends before the next one's first vote and starts behind the last vote of the one before;
    # a chain is the next one if its own start lies behind this chain's last vote.
    ends = np.array([c[2] + K for c in chains])
    firsts, starts = np.array([c[0] for c in chains]), np.array([c[1] for c in chains])
    reach = 2 * (size + BAND)
    out = []
    for first, start, last, place, low, high in chains:
        lo, hi = low - BAND, last + size - place + BAND
        a, b = np.searchsorted(firsts, [first - reach * BAND, hi])  # chains are sorted by their first vote
        after = firsts[a:b][starts[a:b] >= last + K]
        before = ends[a:b][ends[a:b] <= start]
        out.append(((low + high) // 2, high - low, max(0, lo, int(before.max(initial=0))), int(after.min(initial=hi))))
    return out


def align(template: np.ndarray, words: np.ndarray, diagonal: int, spread: int) -> tuple[int, int, int]:
    """(common words, first word, last word + 1): longest common sequence in a band around the diagonal, the one
    that ends first and of these one that starts last."""
    common, _, last = _align(template, words, diagonal, spread)
    if not common:
        return common, -1, -1
    # From behind: the template's last word meets word ``last - 1`` or one before it.
    n, m = last, len(template)
    back = _align(template[::-1], words[:last][::-1], n - m - diagonal, spread)
    return common, n - back[2], last


def _align(template: np.ndarray, words: np.ndarray, diagonal: int, spread: int) -> tuple[int, int, int]:
    """(common words, first word, last word + 1) of the longest common sequence that ends first."""
    m, reach = len(template), BAND + spread
    width = 2 * reach + 1
    best = np.zeros((m + 1, width), np.int32)
    for i in range(m):
        j = i + diagonal + np.arange(-reach, reach + 1)
        inside = (j >= 0) & (j < len(words))
        equal = inside & (words[np.clip(j, 0, max(len(words) - 1, 0))] == template[i])
        row = best[i] + equal
        row[:-1] = np.maximum(row[:-1], best[i][1:])  # the template's word is skipped
        best[i + 1] = np.maximum.accumulate(row)  # the document's words are skipped
    common = int(best[m].max())
    i, d, first, last = m, int(best[m].argmax()), -1, -1
    while i and best[i][d]:
        if d and best[i][d - 1] == best[i][d]:
            d -= 1
        elif d + 1 < width and best[i - 1][d + 1] == best[i][d]:
            i, d = i - 1, d + 1
        elif best[i - 1][d] == best[i][d]:
            i -= 1
        else:
            j = i - 1 + diagonal + d - reach
            first, last, i = j, max(last, j + 1), i - 1
    return common, first, last


@cache
def _index() -> Index:
    return Index(TEMPLATES)


def _slice_matches(piece: pa.Array) -> list[list[dict]]:
    index = _index()
    offsets, words = split_words(translated(piece, ALNUM))
    h = hashed(words)
    found: dict[int, list] = {}
    for r, t, diagonal, spread, start, end in index.candidates(offsets, h):
        own, template = h[offsets[r] + start:min(offsets[r] + end, offsets[r + 1])], index.words[t]
        common, first, last = align(template, own, diagonal - start, spread)
        coverage = common / len(template)
        if coverage >= MIN_COVERAGE:
            found.setdefault(r, []).append((t, -coverage, first + start, last + start))
    out: list[list[dict]] = [[] for _ in range(len(piece))]
    for r, matches in found.items():
        places = [m.span() for m in _WORD.finditer(piece[r].as_py())]
        kept: list[tuple] = []
        for t, minus, first, last in sorted(matches):
            if all(t != k[0] or last <= k[2] or first >= k[3] for k in kept):
                kept.append((t, minus, first, last))
        out[r] = [{"license": index.names[t], "start": places[a][0], "end": places[b - 1][1], "coverage": -c}
                  for t, c, a, b in sorted(kept, key=lambda k: (k[2], k[0]))]
    return out


def scan_licenses(docs: DataFrame, *, text_col: str = "text", into: str = "licenses") -> DataFrame:
    """``docs`` with the array ``into`` of (license, start, end, coverage), by start; code points, end exclusive."""
    kind = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("coverage", pa.float64())])

    @F.arrow_udf("array<struct<license:string,start:bigint,end:bigint,coverage:double>>")
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([m for piece in slices(texts) for m in _slice_matches(piece)], pa.list_(kind))

    return docs.withColumn(into, scan(F.col(text_col)))
