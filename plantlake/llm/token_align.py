"""Alignment of two tokenizers' tokens over a corpus.

Every text is tokenised whole by both tokenizers, window by window: windows,
about a word each, begin at the single blanks between other characters, where
neither joins tokens (no token holds a blank behind such a character, so both
tokenizers work on either side alone).  A window's tokens and its alignment
(its groups, and its links) depend on its characters alone, so a task
tokenises and aligns a window once and remembers it.  The windows of a text
that are new to a task are tokenised together, which also checks that both
begin a token at each.  Where a tokenizer has tokens across such blanks, texts
are tokenised first, and windows begin where both begin a space-marked token:
a verified shared end of the tokens before it, an anchor; they are remembered
by their two id tuples.

Groups are cut where tokens of both end.  A link is a pair of overlapping
tokens.  A pair's count is its number of links in the corpus; a link is best
if its pair has the highest count of its B id (ties included).

Steps: (1) one Arrow pass writes a row per text and, per block of about
``BLOCK_BYTES`` of text, one row with the block's distinct pairs and which text
has which of them how often; (2) pairs are counted over the blocks, and the
highest count of each B id is taken; (3) the blocks' distinct pairs fetch their
counts by an equi-join and come back to their block, where each text's sums are
made.  A pair that fills a third of the corpus is one row per block.  A block's
pairs are bounded by its text; a longer text is a block of its own.

Edge cases: a text that is null, empty, or not restored byte for byte by both
tokenizers has no tokens (zeros, and null ``groups``); special tokens' strings
are plain text; null ids stay; repeated rows are aligned and counted each; an
empty table gives an empty table; other columns are not carried along.  A text
of more than ``PIECE_CHARS`` is handed to the tokenizers in pieces that are cut
before single blanks between other characters, where neither joins tokens.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .arrow_text import slices
from .shared import cut

SLICE_BYTES = 1 << 20
BLOCK_BYTES = 3 << 20
PIECE_CHARS = 1 << 20
MEMO = 1 << 17  # windows that a task remembers
MEMO_IDS = 64  # ids, or
MEMO_CHARS = 64  # characters of a window that is worth remembering
TOKENIZER_FOLDER = "/opt/tokenizers"
#: The byte-level pattern; texts of Latin letters are split by it, others by the tokenizer's own library.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER = re.compile("[^\x00-ɏ‐-‧€]")
LONG_TEXT = 20_000  # characters, above which runs are looked at that the faster library is slow on
_LONG_RUN = re.compile(r"(?<!\S)\S{2000}|(?<!\s)\s{2000}")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ACROSS = re.compile(r"\S ")


@dataclass(frozen=True)
class Tokenizers:
    """Paths of a byte-level BPE (json) and a sentence-piece model."""

    a: str = f"{TOKENIZER_FOLDER}/byte_bpe_50k.json"
    b: str = f"{TOKENIZER_FOLDER}/piece_bpe_32k.model"


# ------------------------------------------------------------ tokenizers

def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in shown]
    return {chr(x): x for x in shown} | {chr(0x100 + i): x for i, x in enumerate(hidden)}


class ByteLevel:
    """Encodes blank + text; ids whose order is the merge order go through the faster library on Latin texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        size = max(model["vocab"].values()) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            if all(c in letters for c in token):
                self.bytes[i] = bytes(letters[c] for c in token)
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        in_order = [model["vocab"].get(m) for m in merged] == list(range(256, 256 + len(merged)))
        ranks = {self.bytes[i]: i for i in range(256 + len(merged))} if in_order else {}
        self.fast = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks,
                                      special_tokens={}) if len(ranks) == 256 + len(merged) else None

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        """(ids, the bytes that they stand for)."""
        if self.fast is None or _OTHER.search(text) or len(text) > LONG_TEXT and _LONG_RUN.search(text):
            ids = self.own.encode(text, add_special_tokens=False).ids
            return np.array(ids, np.int32), b"".join(map(self.bytes.__getitem__, ids))
        ids = self.fast.encode_ordinary(text)
        return np.array(ids, np.int32), self.fast.decode_bytes(ids)


class SentencePiece:
    """Encodes a text behind the blank that the model adds itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(map(self.model.id_to_piece, range(self.model.get_piece_size())))]

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        ids = self.model.encode(text)
        return np.array(ids, np.int32), b"".join(map(self.bytes.__getitem__, ids))


def _pieces(text: str) -> Iterator[str]:
    """``text`` cut before single blanks into pieces of about ``PIECE_CHARS``; the blanks are left out."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        found = _CUT.search(text, at + PIECE_CHARS)
        if not found:
            break
        yield text[at:found.start()]
        at = found.end()
    yield text[at:]


class Pair:
    """Both tokenizers with the tokens' byte lengths and space marks."""

    def __init__(self, paths: Tokenizers):
        self.a, self.b = ByteLevel(paths.a), SentencePiece(paths.b)
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.mark_a, self.mark_b = (np.array([x[:1] == b" " for x in t.bytes]) for t in (self.a, self.b))
        self.across = any(_ACROSS.search(x.decode("utf-8", "replace")) for x in self.a.bytes + self.b.bytes)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none where one does not restore blank + text."""
        none = np.empty(0, np.int32)
        if not text:
            return none, none
        out_a, out_b = [], []
        for piece in _pieces(text):
            whole = (" " + piece).encode()
            a, restored_a = self.a.encode(" " + piece)
            b, restored_b = self.b.encode(piece)
            if restored_a != whole or restored_b != whole:
                return none, none
            out_a.append(a)
            out_b.append(b)
        return np.concatenate(out_a), np.concatenate(out_b)


_OPEN: dict[Tokenizers, Pair] = {}


def tokenizers(paths: Tokenizers) -> Pair:
    if paths not in _OPEN:
        _OPEN[paths] = Pair(paths)
    return _OPEN[paths]


# ------------------------------------------------------------- alignment

def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``starts[k] .. starts[k] + counts[k] - 1`` of all k, in order."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *parts])


class Block:
    """The windows of a block of texts, aligned once each, and the rows made of them."""

    def __init__(self, pair: Pair):
        self.pair = pair
        n_a, n_b = len(pair.len_a), len(pair.len_b)
        # An id inside its group, an A id before the bar, and a B id at the group's end.
        self.shown = [f"{i}{c}" for n, marks in ((n_a, ",|"), (n_b, ",;")) for c in marks for i in range(n)]
        self.forget()
        self.clear()

    def forget(self) -> None:
        self.memo: dict[str | tuple[bytes, bytes], int] = {}
        self.text: list[str] = []  # groups of each window
        self.n_a = self.n_b = self.n_groups = self.n_links = self.links = np.empty(0, np.int64)

    def clear(self) -> None:
        """A new block; the memo is kept while it is small."""
        self.windows: list[np.ndarray] = []  # of each text of the block
        self.new: list[tuple[bytes, bytes]] = []
        self.bytes = 0
        if len(self.text) > MEMO:
            self.forget()

    def add_text(self, text: str | None) -> None:
        """Adds a text: cuts it into windows and looks them up; new ones wait for ``align_new``."""
        if self.pair.across:
            self.add(*self.pair.encode(text))
            return
        parts = _CUT.split(text) if text else []
        found = [*map(self.memo.get, parts)]
        if None in found:
            new = [*dict.fromkeys([part for part, number in zip(parts, found) if number is None])]
            windows, first = self.encode_new(new), len(self.text) + len(self.new)
            numbers = {part: first + i for i, part in enumerate(new)} if windows else {}
            found = [numbers[part] if number is None else number for part, number in zip(parts, found)] if windows else []
            self.new += windows
            self.memo.update((part, number) for part, number in numbers.items() if len(part) <= MEMO_CHARS)
        self.windows.append(np.array(found, np.int64))

    def encode_new(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        """The ids of some windows of a text, or none where one is not restored."""
        p, joined = self.pair, " ".join(parts)
        a, b = p.encode(joined)
        if not len(a):
            return []
        sizes = map(len, parts if joined.isascii() else [part.encode() for part in parts])
        starts = np.cumsum([0, *sizes])
        starts += np.arange(len(starts))  # and a blank before each
        cuts = []
        for ids, lengths in ((a, p.len_a), (b, p.len_b)):
            at = np.append(0, np.cumsum(lengths[ids]))
            cuts.append(np.searchsorted(at, starts))
            if (at[cuts[-1]] != starts).any():
                raise ValueError("a token spans the blank before a word")
        ids_a, ids_b = a.tobytes(), b.tobytes()
        cut_a, cut_b = ((4 * cut).tolist() for cut in cuts)
        return [(ids_a[i:j], ids_b[k:m]) for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Adds a text by its ids: cuts it into windows and looks them up; new ones wait for ``align_new``."""
        if not len(a):
            self.windows.append(np.empty(0, np.int64))
            return
        p, known, get, found = self.pair, len(self.text), self.memo.get, []
        start_a, start_b = np.cumsum(p.len_a[a]) - p.len_a[a], np.cumsum(p.len_b[b]) - p.len_b[b]
        anchors = np.intersect1d(start_a[p.mark_a[a]], start_b[p.mark_b[b]], assume_unique=True)
        cut_a, cut_b = (np.append(4 * np.searchsorted(s, anchors), 4 * len(s)) for s in (start_a, start_b))
        ids_a, ids_b = a.tobytes(), b.tobytes()
        for at in range(0, len(anchors), 1 << 16):
            ca, cb = cut_a[at:at + (1 << 16) + 1].tolist(), cut_b[at:at + (1 << 16) + 1].tolist()
            keys = [(ids_a[i:j], ids_b[k:m]) for i, j, k, m in zip(ca, ca[1:], cb, cb[1:])]
            for key, number in zip(keys, map(get, keys)):  # lazily, so a window met again here is found
                if number is None:
                    number = known + len(self.new)
                    self.new.append(key)
                    if len(key[0]) + len(key[1]) <= 4 * MEMO_IDS:
                        self.memo[key] = number
                found.append(number)
        self.windows.append(np.array(found, np.int64))

    def align_new(self) -> None:
        """Aligns the windows seen first in this block.  Laid end to end, they have equal offsets for A and B."""
        p = self.pair
        a, b = (np.frombuffer(b"".join([w[i] for w in self.new]), np.int32).astype(np.int64) for i in (0, 1))
        size_a, size_b = (np.array([len(w[i]) >> 2 for w in self.new], np.int64) for i in (0, 1))
        end_a, end_b = np.cumsum(p.len_a[a]), np.cumsum(p.len_b[b])
        # Links: the B tokens that end behind an A token's start and start before its end.
        first = np.searchsorted(end_b, end_a - p.len_a[a], "right")
        n = np.searchsorted(end_b - p.len_b[b], end_a, "left") - first
        last_a = np.cumsum(size_a)
        n_links = np.diff(np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], last_a))])
        # Groups: each ends where tokens of both end.
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        groups_to = np.searchsorted(shared, end_a[last_a - 1], "right") if len(last_a) else last_a
        closes_a, closes_b = (np.append(g[1:] != g[:-1], True)[:len(g)] for g in (group_a, group_b))
        shown = np.concatenate((a + len(p.len_a) * closes_a, 2 * len(p.len_a) + b + len(p.len_b) * closes_b))
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        table = self.shown
        tokens, to = [table[i] for i in shown[order].tolist()], np.cumsum(size_a + size_b).tolist()
        self.text += ["".join(tokens[x:y]) for x, y in zip([0, *to], to)]
        self.n_a, self.n_b = np.append(self.n_a, size_a), np.append(self.n_b, size_b)
        self.n_groups = np.append(self.n_groups, np.diff(groups_to, prepend=0))
        self.n_links = np.append(self.n_links, n_links)
        self.links = np.append(self.links, np.repeat(a, n) << 32 | b[_ragged(first, n)])
        self.new = []

    def groups(self, text: int) -> tuple[int, int, int, str | None]:
        """(tokens of A and of B, number of groups, groups) of a text of the block."""
        windows = self.windows[text]
        shown = self.text
        return (*(int(n[windows].sum()) for n in (self.n_a, self.n_b, self.n_groups)),
                "".join([shown[w] for w in windows.tolist()])[:-1] or None)

    def pairs(self) -> tuple[list[int], dict[str, np.ndarray]]:
        """(links per text, arrays of the block's row): distinct pairs, and each text's pairs with their counts."""
        n_texts = len(self.windows)
        sizes = np.array([len(w) for w in self.windows], np.int64)
        used, which = np.unique(_joined(self.windows), return_inverse=True)
        doc_window, times = np.unique(np.repeat(np.arange(n_texts), sizes) * max(len(used), 1) + which,
                                      return_counts=True)
        doc, window = np.divmod(doc_window, max(len(used), 1))
        counts, first = self.n_links[used], (np.cumsum(self.n_links) - self.n_links)[used]
        code, no = np.unique(self.links[_ragged(first, counts)], return_inverse=True)
        n = counts[window]
        no = no[_ragged((np.cumsum(counts) - counts)[window], n)]
        doc_no, back = np.unique(np.repeat(doc, n) * max(len(code), 1) + no, return_inverse=True)
        many = np.bincount(back, weights=np.repeat(times, n), minlength=len(doc_no)).astype(np.int64)
        doc, no = np.divmod(doc_no, max(len(code), 1))
        per_doc = np.bincount(doc, weights=many, minlength=n_texts).astype(np.int64)
        total = np.bincount(no, weights=many, minlength=len(code)).astype(np.int64)
        return per_doc.tolist(), {"a": code >> 32, "b": code & 0xFFFFFFFF, "n": total,
                                  "ends": np.cumsum(np.bincount(doc, minlength=n_texts)), "pair": no, "times": many}


_ARRAYS = "a array<int>, b array<int>, n array<bigint>, ends array<int>, pair array<int>, times array<int>"


def _aligner(paths: Tokenizers, id_type: pa.DataType):
    """The Arrow pass: a row per text (``no`` >= 0), and a row per block (``no`` -1) with its pairs."""
    types = {"a": pa.int32(), "b": pa.int32(), "n": pa.int64(), "ends": pa.int32(), "pair": pa.int32(),
             "times": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, held = Block(tokenizers(paths)), 0, []
        first = TaskContext.get().partitionId() << 32

        def rows() -> pa.RecordBatch:
            block.align_new()
            n, (links, arrays) = len(held), block.pairs()
            n_a, n_b, n_groups, groups = zip(*map(block.groups, range(n)))
            out = {"block": pa.array([first + number] * (n + 1), pa.int64()),
                   "no": pa.array([*range(n), -1], pa.int32()),
                   "id": pa.array([*held, None], id_type),
                   "n_a": pa.array([*n_a, None], pa.int64()), "n_b": pa.array([*n_b, None], pa.int64()),
                   "n_groups": pa.array([*n_groups, None], pa.int64()),
                   "n_links": pa.array([*links, None], pa.int64()), "groups": pa.array([*groups, None], pa.string())}
            for name, kind in types.items():
                ends = pa.array([0] * (n + 1) + [len(arrays[name])], pa.int32())
                mask = pa.array([True] * n + [False])
                out[name] = pa.ListArray.from_arrays(ends, pa.array(arrays[name], kind), mask=mask)
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for piece in slices(batch.column(1), SLICE_BYTES):
                for text, size in zip(piece.to_pylist(), pc.binary_length(piece).to_pylist()):
                    held.append(ids[at])
                    block.add_text(text)
                    block.bytes += size
                    at += 1
                    if block.bytes >= BLOCK_BYTES or len(held) >= 1 << 16:
                        yield rows()
                        held, number = [], number + 1
                        block.clear()
        if held:
            yield rows()

    return run


def _sums(ends: pa.Array, pair: pa.Array, times: pa.Array, pos: pa.Array, n: pa.Array, best: pa.Array) -> pa.Array:
    """Per text of a block: links whose pair is best, and the sum of their pairs' counts."""
    out = []
    for i in range(len(ends)):
        e, p, t, at, c, top = (x[i].values.to_numpy(False) for x in (ends, pair, times, pos, n, best))
        count, is_best = np.empty(len(at), np.int64), np.empty(len(at), bool)
        count[at], is_best[at] = c, top
        t = t.astype(np.int64)
        sums = [np.concatenate(([0], np.cumsum(x))) for x in (t * is_best[p], t * count[p])]
        out.append([{"n_best": int(x), "count_sum": int(y)}
                    for x, y in zip(*(np.diff(s[np.concatenate(([0], e))]) for s in sums))])
    return pa.array(out, pa.list_(pa.struct([("n_best", pa.int64()), ("count_sum", pa.int64())])))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n, best): corpus-wide links of every linked id pair, and whether no pair of its B id has more."""
    n = cut(blocks.select(F.inline(F.arrays_zip("a", "b", "n"))).groupBy("a", "b").agg(F.sum("n").alias("n")))
    top = n.groupBy("b").agg(F.max("n").alias("top"))
    return n.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", paths: Tokenizers = Tokenizers(),
          digest: bool = False) -> DataFrame:
    """Per text: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (``a1,a2|b1;a3|b2,b3``).

    With ``digest``, ``groups`` is the SHA-256 of that string."""
    spark = docs.sparkSession
    id_field = docs.select(F.col(f"`{id_col}`").alias("id")).schema["id"]
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counts = [F.col(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    schema = (f"block bigint, no int, id {id_field.dataType.simpleString()}, n_a bigint, n_b bigint, "
              f"n_groups bigint, n_links bigint, groups string, {_ARRAYS}")
    aligned = texts.mapInArrow(_aligner(paths, to_arrow_type(id_field.dataType)), schema)
    groups: Column = F.sha2("groups", 256) if digest else F.col("groups")
    arrays = [part.split(" ")[0] for part in _ARRAYS.split(", ")]
    rows = cut(aligned.select("block", "no", "id", *counts, groups.alias("groups"), *arrays))
    blocks = rows.filter("no = -1")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("a", "b"))).select("block", "pos", "col.*")
    answered = asked.join(pair_counts(blocks), ["a", "b"]).groupBy("block") \
        .agg(F.collect_list("pos").alias("at"), F.collect_list("n").alias("count"),
             F.collect_list("best").alias("best"))
    per_text = F.arrow_udf(_sums, "array<struct<n_best:bigint,count_sum:bigint>>")
    sums = blocks.select("block", "ends", "pair", "times").join(answered, "block") \
        .select("block", F.posexplode(per_text("ends", "pair", "times", "at", "count", "best")).alias("no", "s"))
    zero = F.lit(0).cast("bigint")
    # Where no text has tokens, a block has no pairs and no sums: hence the left join.
    return rows.filter("no >= 0").select("block", "no", "id", *counts, "groups").join(sums, ["block", "no"], "left") \
        .select(F.col("id").alias(id_col), *counts, F.coalesce("s.n_best", zero).alias("n_best"),
                F.coalesce("s.count_sum", zero).alias("count_sum"), "groups")
