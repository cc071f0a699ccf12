"""Benchmark decontamination by Wu-Manber multi-pattern search.

The patterns are word windows of the benchmark items, the text is a
document's word list; both are normalised to blank-separated words, so a hit
starts and ends at word bounds.  Wu-Manber looks at the last ``B`` bytes of a
window of ``m`` bytes (the shortest pattern's length): a shift table over
hashed blocks says how far the window can jump; where the shift is 0, a
bucket found by the hash of that suffix block, then by the pattern's first
bytes, names the patterns that are compared directly.  Patterns are searched
in length classes (a power of two each), so one short item does not shrink
the jumps of the others.

Spark part: a map over the documents, without a shuffle.  The pattern set is
broadcast in blocks of at most ``block_bytes`` (hashed evenly); with more
than one block the documents are read once per block, and a text's hits are
brought together by the text's digest.

Edge cases: a null text or item has no words; an item without words has no
window; repeated rows and repeated items are each reported; extra columns are
never read, so they cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import ALNUM, raw_bytes, slices

WINDOW = 13
BLOCK_BYTES = 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
_RESULT = "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,hits:array<bigint>>"


class WuManber:
    """Search for many byte strings at once; ``find`` yields (start, pattern number)."""

    BITS = 18

    def __init__(self, patterns: list[bytes], block: int = 8):
        self.patterns = patterns
        by_class: dict[int, list[int]] = {}
        for i, p in enumerate(patterns):
            by_class.setdefault(len(p).bit_length(), []).append(i)
        self.classes = [self._tables([(i, patterns[i]) for i in ids], block) for ids in by_class.values()]

    def _tables(self, patterns: list[tuple[int, bytes]], block: int):
        m = min(len(p) for _, p in patterns)
        b = min(block, m)
        mask = (1 << self.BITS) - 1
        shift = bytearray([min(m - b + 1, 255)]) * (mask + 1)
        buckets: dict[int, dict[bytes, list[int]]] = {}
        for i, p in patterns:
            for end in range(b, m + 1):
                h = hash(p[end - b:end]) & mask
                if shift[h] > m - end:
                    shift[h] = m - end
            buckets.setdefault(h, {}).setdefault(p[:b], []).append(i)  # h: of the last block
        return m, b, mask, shift, buckets

    def find(self, text: bytes):
        n, patterns = len(text), self.patterns
        for m, b, mask, shift, buckets in self.classes:
            at = m
            while at <= n:
                h = hash(text[at - b:at]) & mask
                s = shift[h]
                if s:
                    at += s
                    continue
                start = at - m
                for i in buckets.get(h, {}).get(text[start:start + b], ()):
                    if text.startswith(patterns[i], start):
                        yield start, i
                at += 1


def window_column(text: Column, window: int = WINDOW) -> Column:
    """Array of the word windows of one item's text (blank-separated words)."""
    words = F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(1))
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(words, i, window), " "))
    return F.when(n > 0, many).otherwise(F.array().cast("array<string>"))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """Distinct (win, item) rows of the benchmark."""
    return items.select(F.explode(window_column(F.col(text_col), window)).alias("win"),
                        F.col(item_col).cast("bigint").alias("item")).distinct()


_BUILT: dict = {}


def _matcher(shared) -> tuple[WuManber, list[list[int]]]:
    """The broadcast block's search tables, built once per worker process."""
    if shared.id not in _BUILT:
        _BUILT.clear()
        windows, items = shared.value
        _BUILT[shared.id] = WuManber([b" " + w.encode() + b" " for w in windows]), items
    return _BUILT[shared.id]


class _Shared:
    def __init__(self, broadcast, key: str):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self):
        return self.broadcast.value


def _hits(text: bytes, matcher: WuManber, items: list[list[int]]):
    """(number of words, merged word spans, item numbers) of one normalised text."""
    words = text.split()
    if not words:
        return 0, [], [], []
    line = b" " + b" ".join(words) + b" "
    found = sorted(matcher.find(line))
    starts, ends, hit_items = [], [], set()
    at = word = 0
    for start, i in found:
        word += line.count(b" ", at, start)
        at = start
        end = word + matcher.patterns[i].count(b" ") - 1
        hit_items.update(items[i])
        if ends and word <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(word)
            ends.append(end)
    return len(words), starts, ends, sorted(hit_items)


def _search(shared: _Shared):
    @F.arrow_udf(_RESULT)
    def search(texts: pa.Array) -> pa.Array:
        matcher, items = _matcher(shared)
        out = []
        for piece in slices(texts):
            offsets, data = raw_bytes(piece)
            data = data.translate(ALNUM)
            out += [_hits(data[a:b], matcher, items) for a, b in zip(offsets[:-1], offsets[1:])]
        ints = pa.list_(pa.int64())
        kinds = (pa.int64(), ints, ints, ints)
        names = ("n_words", "starts", "ends", "hits")
        cols = zip(*out) if out else ([], [], [], [])
        return pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)

    return search


def _blocks(windows: DataFrame, block_bytes: int):
    """The windows with their items, as driver lists of at most about ``block_bytes`` each."""
    sized = windows.withColumn("bytes", F.octet_length("win") + 24)
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    n = int(-(-total // block_bytes)) or 1
    for k in range(n):
        part = windows.filter(F.pmod(F.xxhash64("win", "item"), F.lit(n)) == k).toPandas()
        grouped = part.groupby("win", sort=True)["item"].apply(lambda s: sorted(int(x) for x in s if x == x))
        yield list(grouped.index), list(grouped)


def decontaminate(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  into: str = "contamination") -> DataFrame:
    """``docs`` with a struct ``into``: n_words, n_hit, starts, ends (word spans), items, contaminated.

    ``contaminated``: some word is inside a window and 20 * n_hit >= n_words.
    ``into`` must not be a column of ``docs``.
    """
    spark = docs.sparkSession
    windows = item_windows(items, item_col, item_text_col, window)
    passes = []
    for k, block in enumerate(_blocks(windows, block_bytes)):
        broadcast = spark.sparkContext.broadcast(block)
        passes.append(_search(_Shared(broadcast, f"{broadcast._jbroadcast.id()}-{k}")))
    if len(passes) == 1:
        return _judged(docs.withColumn(into, passes[0](F.col(text_col))), into)
    key = F.struct(F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("m"),
                   F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"))
    texts = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    parts = None
    for search in passes:
        one = texts.select("key", search("text").alias("r")).dropDuplicates(["key"])
        parts = one if parts is None else parts.unionAll(one)
    merged = parts.groupBy("key").agg(F.max("r.n_words").alias("n_words"), F.collect_list("r").alias("rs"))
    spans = F.array_sort(F.flatten(F.transform("rs", lambda r: F.arrays_zip(r["starts"], r["ends"]))))
    merged = merged.select("key", "n_words", spans.alias("spans"),
                           F.array_sort(F.array_distinct(F.flatten(F.col("rs.hits")))).alias("hits"))
    empty = F.expr("cast(array() as array<struct<starts:bigint,ends:bigint>>)")

    def fold(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                          F.array(F.struct(last["starts"].alias("starts"),
                                           F.greatest(last["ends"], s["ends"]).alias("ends"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["ends"] >= s["starts"]), joined) \
            .otherwise(F.concat(acc, F.array(s)))

    merged = merged.withColumn("spans", F.aggregate("spans", empty, fold))
    merged = merged.select("key", F.struct("n_words", F.col("spans.starts").alias("starts"),
                                           F.col("spans.ends").alias("ends"), "hits").alias(into))
    out = docs.withColumn("__key", key).join(merged.withColumnRenamed("key", "__key"), "__key").drop("__key")
    return _judged(out, into)


def _judged(df: DataFrame, into: str) -> DataFrame:
    r = F.col(into)
    n_hit = F.aggregate(F.zip_with(r["ends"], r["starts"], lambda e, s: e - s), F.lit(0).cast("bigint"),
                        lambda a, x: a + x)
    return df.withColumn(into, F.struct(
        r["n_words"].alias("n_words"), n_hit.alias("n_hit"), r["starts"].alias("starts"), r["ends"].alias("ends"),
        r["hits"].alias("items"), ((n_hit > 0) & (20 * n_hit >= r["n_words"])).alias("contaminated")))
