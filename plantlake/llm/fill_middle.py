"""Fill-in-the-middle transformation of texts with an indexable skip list.

A text is cut into units (a run of white space with the run of other
characters behind it; white space at the end is a unit of its own).  Its units
are the nodes of a skip list: every unit stands on lane 0, and one in four of a
lane's nodes, chosen by a seeded hash of its rank, stands on the next express
lane too.  Each node carries two widths to its right neighbour on the lane: in
units and in code points.  A cut rank is found by descending from the top lane
while the accumulated unit width does not pass the rank; the code points
accumulated on the way are the place of the cut in the text.

``transform`` draws both cut ranks and the form from a hash of the row's id:
``plain`` (the text itself), ``psm`` (prefix, suffix, middle behind their
marks) or ``spm`` (suffix, prefix, middle).  ``restore`` rebuilds the text from
output and form by Spark expressions alone.

Edge cases: a null text is empty, and an empty text is plain with no units; a
text that contains a mark is plain; a null id counts as the empty string;
repeated rows get equal results; an empty table gives an empty table; extra
columns stay, and ``into`` replaces a column only if the caller names it so.  A
long text is scanned in runs of ``RUN_BYTES``; its list holds eight bytes a
unit on lane 0 and a third of that above.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import U64, mix, raw_bytes, slices

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_PERCENT = 50  # of the texts are cut
SPM_PERCENT = 80  # of the cut texts
RUN_BYTES = 1 << 20
_RESULT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


# ------------------------------------------------------------- skip list

@dataclass(frozen=True)
class Lane:
    """Nodes of one lane: widths to the right neighbour, and each node's place on the lane below."""

    units: np.ndarray
    chars: np.ndarray
    down: np.ndarray | None


class SkipList:
    """An indexable skip list over units given by their widths in code points."""

    def __init__(self, widths: np.ndarray, seed: int = SEED):
        self.n = len(widths)
        self.lanes: list[Lane] = []
        before = np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))
        rank, down = np.arange(self.n), None
        draw = mix(rank.astype(U64) + U64(seed << 32)) if self.n else np.empty(0, U64)
        while len(rank):
            right = np.append(rank[1:], self.n)
            self.lanes.append(Lane((right - rank).astype(np.int32), (before[right] - before[rank]).astype(np.int32),
                                   down))
            if len(rank) <= 4:
                break
            climbs = (draw[rank] >> U64(2 * (len(self.lanes) - 1))) & U64(3) == 0
            climbs[0] = True  # the list's head stands on every lane
            down = np.flatnonzero(climbs)
            if len(down) == len(rank):
                break
            rank = rank[down]

    def seek(self, rank: int) -> int:
        """Code points before the unit of ``rank`` (all code points for the number of units)."""
        units = chars = node = 0
        for lane in reversed(self.lanes):
            width, end = lane.units, len(lane.units)
            while node < end and units + width[node] <= rank:
                units += int(width[node])
                chars += int(lane.chars[node])
                node += 1
            if units == rank:
                break
            node = 0 if lane.down is None else int(lane.down[node])
        return chars


# ----------------------------------------------------------------- units

def unit_widths(piece: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row offsets into the widths, width in code points of every unit) of a slice of texts."""
    offsets, data = raw_bytes(piece)
    b = np.frombuffer(data, np.uint8)
    begins, at, chars, blank_before = offsets[:-1][np.diff(offsets) > 0], [], 0, False
    chars_at = []
    for start in range(0, len(b), RUN_BYTES):
        run = b[start:start + RUN_BYTES]
        blank = _BLANK[run]
        first = blank.copy()  # a blank behind another character begins a unit, and so does each text
        first[1:] &= ~blank[:-1]
        first[0] &= not blank_before
        lo, hi = np.searchsorted(begins, (start, start + len(run)))
        first[begins[lo:hi] - start] = True
        place = np.flatnonzero(first)
        seen = np.cumsum((run & 0xC0) != 0x80, dtype=np.int64)
        at.append(place + start)
        chars_at.append(chars + seen[place] - 1)
        chars, blank_before = chars + int(seen[-1]), bool(blank[-1])
    at = np.concatenate([np.empty(0, np.int64), *at])
    chars_at = np.concatenate([np.empty(0, np.int64), *chars_at])
    return np.searchsorted(at, offsets), np.diff(np.append(chars_at, chars))


# -------------------------------------------------------------- operator

def draws(id_col: Column, seed: int = SEED) -> list[Column]:
    """Four 32-bit numbers from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _cutter(seed: int, fim_percent: int, spm_percent: int):
    @F.arrow_udf(_RESULT)
    def cut(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        h1, h2, h3, h4 = (h.to_numpy(False) for h in (h1, h2, h3, h4))
        n_all, forms, prefixes, middles, outputs, row = [], [], [], [], [], 0
        for piece in slices(texts, RUN_BYTES):
            offsets, widths = unit_widths(piece)
            for r, text in enumerate(piece.to_pylist()):
                n = int(offsets[r + 1] - offsets[r])
                plain = h3[row] % 100 >= fim_percent or not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
                n_all.append(n)
                if plain:
                    forms.append("plain")
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(text)
                else:
                    units = SkipList(widths[offsets[r]:offsets[r + 1]], seed)
                    p, m = sorted(units.seek(int(h[row] % (n + 1))) for h in (h1, h2))
                    prefix, middle, suffix = text[:p], text[p:m], text[m:]
                    spm = h4[row] % 100 < spm_percent
                    forms.append("spm" if spm else "psm")
                    prefixes.append(p)
                    middles.append(m - p)
                    outputs.append(SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle if spm
                                   else PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle)
                row += 1
        return pa.StructArray.from_arrays(
            [pa.array(n_all, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
             pa.array(middles, pa.int64()), pa.array(outputs, pa.string())],
            ["n", "form", "prefix_chars", "middle_chars", "output"])

    return cut


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", into: str = "fim",
              seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with a struct ``into``: n (units), form, prefix_chars, middle_chars (null if plain), output."""
    cut = _cutter(seed, fim_percent, spm_percent)
    return docs.withColumn(into, cut(F.col(f"`{text_col}`"), *draws(F.col(f"`{id_col}`"), seed)))


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.  No mark occurs in the parts, so the marks split it exactly."""
    parts = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
