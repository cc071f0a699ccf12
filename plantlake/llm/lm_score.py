"""Language-model scoring with an Elias-Fano n-gram trie (words, word pairs and triples).

Model: the probability of a word after a word is the pair's count with a
Dirichlet prior on the word's own probability,
``(c(v, w) + MU * p(w)) / (c(v) + MU)`` with ``p(w) = (c(w) + 1) / (N + V + 1)``;
the missing 1 / (N + V + 1) is that of all unknown words.  With ``order`` 3,
behind a pair that was seen it is the triple's count with a Dirichlet prior on
that, ``(c(u, v, w) + MU * p(w | v)) / (c(u, v) + MU)``.  Every text starts
from a begin mark and ends with an end mark.

Trie: level 1 holds the words as their sorted 64-bit hashes (Elias-Fano) with
exact counts; a word's number is its place.  Level 2 holds, per word, the
sorted numbers of its followers.  Each level is cut into segments that are
files in the shared folder: level 1 by ranges of the hash, level 2 by a hash
of the pair, so that the followers of a frequent word are dealt over all
segments.  In a level-2 segment, the words that have followers there, the
monotone pointers to their ranges, and the followers (made monotone by adding
range number * (V + 1)) are Elias-Fano sequences; beside them stand the
probabilities, quantised to 16 bits of a uniform grid over log10.  A query
finds the word's range, then searches the follower's successor relative to
that range.  Level 3 has the same sequences over the pairs' places in their
level-2 segments and the words behind them, with exact counts; its segment is
the pair's segment plus a hash of the last word, so a place names one pair
there and a frequent pair or word is dealt over all segments.  Counts are
bytes, the few larger ones are listed apart.  Workers memory-map the files.

Training is a pass over the training texts per level.  Each task counts its texts
in numpy and sends one row of packed counts per segment, so a shuffle carries
about six bytes per distinct pair of a task, and a word, pair or triple that fills a
third of the corpus is one entry per task.  The number of segments is the
training text's bytes / ``SEGMENT_BYTES``, so a segment's build does not grow
with the corpus.  Scoring is a map over all texts.

Edge cases: a null text is empty and scores its end mark; a null id counts as
the empty text for the held-out rule; without training rows every word is
unknown; repeated rows are each counted and scored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import U64, mix, raw_bytes, slices, split_words
from .elias_fano import EliasFano, read_level, write_level
from .shared import cut, new_folder

MU = 4.0
ORDER = 2  # of ``score``'s model unless asked for 3
SEGMENT_BYTES = 16 << 20
FOLDS, HELD_OUT = 7, 2
HOLD_KEYS = 1 << 21  # entries that a task gathers before it sends them on
OPEN_FILES = 4096
_FLOOR = -20.0  # of the quantised log10 probabilities
_STEP = -_FLOOR / 65535
_END = xxhash.xxh3_64_intdigest(b" ")  # no word holds a blank
_PACKED = "segment int, keys binary, counts binary"


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


# ---------------------------------------------------------------- counting

def _tokens(piece: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row offsets, index into the hashes, hashes) of a slice's lower-cased words with an end mark per row.

    The end mark is the last hash."""
    offsets, words = split_words(pc.ascii_lower(piece))
    coded = words.dictionary_encode()
    one = xxhash.xxh3_64_intdigest
    ends, data = raw_bytes(coded.dictionary)
    ends = ends.tolist()
    table = np.fromiter((one(data[a:b]) for a, b in zip(ends, ends[1:])), U64, len(coded.dictionary))
    n = len(piece)
    index = np.full(len(words) + n, len(table), np.int64)
    ends = offsets[1:] + np.arange(n)  # place of each row's end mark
    inside = np.ones(len(index), bool)
    inside[ends] = False
    index[inside] = coded.indices.to_numpy()
    return offsets + np.arange(n + 1), index, np.append(table, U64(_END))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray], segments: list[np.ndarray] | None = None):
    """Sorted distinct keys with their summed counts; with ``segments``, of each segment, and the segments."""
    key, count = np.concatenate([np.empty(0, U64), *keys]), np.concatenate([np.empty(0, np.int64), *counts])
    segment = np.zeros(len(key), np.int32) if segments is None else np.concatenate(segments)
    order = np.argsort(key)
    if segments is not None:
        order = order[_by_segment(segment[order])]
    key, segment = key[order], segment[order]
    new = (key[1:] != key[:-1]) | (segment[1:] != segment[:-1])
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), new)))
    merged = key[first], np.add.reduceat(count[order], first) if len(key) else count
    return merged if segments is None else (*merged, segment[first])


def _by_segment(segment: np.ndarray) -> np.ndarray:
    """Stable order by segment; numbers of two bytes are sorted by their digits."""
    few = not len(segment) or -1 <= segment.min() and segment.max() < 0x7FFF
    return np.argsort(segment.astype(np.int16) if few else segment, kind="stable")


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the values' differences, plane by plane: the shuffle's compression drops the empty planes."""
    if not len(values):
        return b""
    steps = np.concatenate((values[:1], np.diff(values))).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=U64)


def _packed_rows(keys: np.ndarray, counts: np.ndarray, segment: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per segment; keys stay sorted within it."""
    order = _by_segment(segment)
    keys, counts, segment = keys[order], counts[order], segment[order]
    at = np.flatnonzero(np.concatenate((np.ones(min(len(segment), 1), bool), segment[1:] != segment[:-1])))
    for a, b in zip(at, np.append(at[1:], len(segment))):
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array([int(segment[a])], pa.int32()), "keys": [_planes(keys[a:b])],
            "counts": [_small(counts[a:b]).tobytes()]})


def _small(counts: np.ndarray) -> np.ndarray:
    return counts.astype("<u4") if not len(counts) or counts.max() < 1 << 32 else counts.astype("<u8")


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A segment's distinct keys with their counts, from the rows of all tasks."""
    keys, counts = [], []
    for k, c in zip(rows["keys"], rows["counts"]):
        keys.append(_unplaned(k))
        counts.append(np.frombuffer(c, f"<u{len(c) // max(len(keys[-1]), 1)}").astype(np.int64))
    return _merged(keys, counts)


def _counted(texts: DataFrame, count_slice, segment_of=None) -> DataFrame:
    """Packed counts per (task, segment) of a one-column frame of texts.

    Without ``segment_of``, the slices' counts come with their segments, and a key belongs to its segment."""

    def merged(keys, counts, segments):
        return _merged(keys, counts) if segment_of else _merged(keys, counts, segments)

    def packed(k, c, *segment):
        return _packed_rows(k, c, *(segment or (segment_of(k),)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, segments, held = [], [], [], 0
        for batch in batches:
            for piece in slices(batch.column(0)):
                k, c, *segment = count_slice(piece)
                keys.append(k)
                counts.append(c)
                segments += segment
                held += len(k)
                if held > HOLD_KEYS:
                    k, c, *segment = merged(keys, counts, segments)
                    keys, counts, segments, held = [k], [c], segment, len(k)
                    if held > HOLD_KEYS // 2:
                        yield from packed(k, c, *segment)
                        keys, counts, segments, held = [], [], [], 0
        if held:
            yield from packed(*merged(keys, counts, segments))

    return texts.mapInArrow(run, _PACKED)


def _range_of(h: np.ndarray, segments: int) -> np.ndarray:
    """Level-1 segment of a word hash; segments are ranges of the hash, in order."""
    return ((h >> U64(32)) * U64(segments) >> U64(32)).astype(np.int64)


def _pair_segment(key: np.ndarray, segments: int) -> np.ndarray:
    return ((mix(key) >> U64(32)) * U64(segments) >> U64(32)).astype(np.int64)


# ------------------------------------------------------------------- model

@dataclass(frozen=True)
class Model:
    """Where the levels are, and the corpus totals; small, so it travels with the tasks."""

    folder: str
    segments: int
    first_number: tuple[int, ...]  # of the words of each level-1 segment, and the number of words at the end
    tokens: int
    texts: int
    mu: float
    order: int

    @property
    def types(self) -> int:
        return self.first_number[-1]

    def unseen(self) -> float:
        return -np.log10(self.tokens + self.types + 1)


_OPEN: OrderedDict[str, tuple] = OrderedDict()


def _level(uri: str) -> tuple:
    """A mapped file; the worker keeps the last ``OPEN_FILES`` of them."""
    if uri not in _OPEN:
        while len(_OPEN) >= OPEN_FILES:
            _OPEN.popitem(last=False)
        _OPEN[uri] = read_level(uri)
    _OPEN.move_to_end(uri)
    return _OPEN[uri]


def _groups(segment: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = _by_segment(segment)
    bounds = np.flatnonzero(np.diff(segment[order])) + 1
    for part in np.split(order, bounds):
        if len(part):
            yield int(segment[part[0]]), part


def word_numbers(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number or -1, count) of each word hash."""
    number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
    for s, at in _groups(_range_of(hashes, model.segments)):
        if model.first_number[s + 1] == model.first_number[s]:
            continue
        at = at[np.argsort(hashes[at])]
        _, seqs, plain = _level(f"{model.folder}/words-{s:07d}")
        place = seqs["words"].find(hashes[at])
        ok = place >= 0
        number[at[ok]] = place[ok] + model.first_number[s]
        count[at[ok]] = plain["counts"][place[ok]]
    return number, count


def _counts_of(model: Model, numbers: np.ndarray) -> np.ndarray:
    """Counts of words by number; the begin mark's (number V) is the number of texts."""
    out = np.full(len(numbers), model.texts, np.int64)
    first = np.array(model.first_number)
    segment = np.searchsorted(first, numbers, side="right") - 1
    for s, at in _groups(np.where(numbers < model.types, segment, -1)):
        if s >= 0:
            out[at] = _level(f"{model.folder}/words-{s:07d}")[2]["counts"][numbers[at] - first[s]]
    return out


def _pairs(model: Model, piece: pa.Array):
    """(offsets, counts, previous number, number) of a slice's tokens; -1 is unknown, V the begin mark."""
    offsets, index, hashes = _tokens(piece)
    number, count = word_numbers(model, hashes)
    words = number[index]
    previous = np.empty_like(words)
    previous[1:] = words[:-1]
    previous[offsets[:-1]] = model.types
    return offsets, count[index], previous, words


def _triples(model: Model, offsets: np.ndarray, words: np.ndarray, segment: np.ndarray, place: np.ndarray):
    """(tokens, segment, key) of the tokens of known words behind a pair that was seen; ``segment`` and ``place``
    are those of the pair that ends at each token (-1: none)."""
    inside = np.ones(len(words), bool)
    inside[offsets[:-1]] = False
    at = np.flatnonzero(inside & (words >= 0))
    at = at[place[at - 1] >= 0]
    word = words[at].astype(U64)
    shift = ((mix(word + U64(1)) >> U64(32)) * U64(model.segments) >> U64(32)).astype(np.int64)
    return at, (segment[at - 1] + shift) % model.segments, place[at - 1].astype(U64) << U64(32) | word


def _ranges(keys: np.ndarray, types: int) -> tuple[dict[str, EliasFano], np.ndarray, np.ndarray]:
    """Sequences of sorted (head, word) keys of two 32-bit numbers, and the heads with their numbers of followers."""
    head, word = keys >> U64(32), keys & U64(0xFFFFFFFF)
    heads, first = np.unique(head, return_index=True)
    first = np.append(first, len(keys))
    lengths = np.diff(first)
    follower = np.repeat(np.arange(len(heads)), lengths).astype(U64) * U64(types + 1) + word
    return {"heads": EliasFano.build(heads, int(heads[-1]) + 1 if len(heads) else 1),
            "pointers": EliasFano.build(first.astype(U64), len(keys) + 1),
            "followers": EliasFano.build(follower, len(heads) * (types + 1) + 1)}, heads.astype(np.int64), lengths


def _find(seqs: dict[str, EliasFano], keys: np.ndarray, types: int) -> np.ndarray:
    """Place of each (head, word) key, or -1; each distinct head and key is searched once, in order."""
    back = slice(None)
    if not (keys[1:] > keys[:-1]).all():
        keys, back = np.unique(keys, return_inverse=True)
    out = np.full(len(keys), -1, np.int64)
    heads = keys >> U64(32)
    new = np.concatenate((np.ones(min(len(heads), 1), bool), heads[1:] != heads[:-1]))
    heads, of = heads[new], np.cumsum(new) - 1
    place = seqs["heads"].find(heads)
    seen = place >= 0
    start, end = np.full(len(heads), -1, np.int64), np.full(len(heads), -1, np.int64)
    start[seen], end[seen] = (seqs["pointers"].get(i).astype(np.int64) for i in (place[seen], place[seen] + 1))
    known = np.flatnonzero(seen[of])
    of, word = of[known], keys[known] & U64(0xFFFFFFFF)
    out[known] = seqs["followers"].find(place[of].astype(U64) * U64(types + 1) + word, start[of], end[of])
    return out[back]


def _bytes_of(counts: np.ndarray) -> tuple[EliasFano, dict[str, np.ndarray]]:
    """Counts as bytes: 255 stands for the larger ones, whose places are the sequence."""
    large = np.flatnonzero(counts >= 255)
    return (EliasFano.build(large.astype(U64), len(counts) + 1),
            {"count": np.minimum(counts, 255).astype(np.uint8), "large_counts": counts[large].astype("<u8")})


def _count_at(seqs: dict[str, EliasFano], plain: dict[str, np.ndarray], place: np.ndarray) -> np.ndarray:
    out = plain["count"][place].astype(np.int64)
    large = np.flatnonzero(out == 255)
    if len(large):
        out[large] = plain["large_counts"][seqs["large"].find(place[large].astype(U64))]
    return out


def _word_log10(model: Model, count: np.ndarray) -> np.ndarray:
    return np.log10(count + 1.0) + model.unseen()


def train(texts: DataFrame, *, mu: float = MU, segment_bytes: int = SEGMENT_BYTES, order: int = ORDER) -> Model:
    """Build the model's levels in the shared folder from a one-column frame of training texts."""
    spark = texts.sparkSession
    texts = texts.select(F.coalesce(F.col(texts.columns[0]), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    segments, n_texts = max(1, -(-(size[0] or 0) // segment_bytes)), size[1]
    folder = new_folder(spark, "lm")

    def count_words(piece):
        _, index, hashes = _tokens(piece)
        return hashes, np.bincount(index, minlength=len(hashes))

    def build_words(rows: pd.DataFrame) -> pd.DataFrame:
        s = int(rows["segment"].iloc[0])
        keys, counts = _unpacked(rows)
        write_level(f"{folder}/words-{s:07d}", {}, {"words": EliasFano.build(keys, 1 << 64)},
                    {"counts": _small(counts)})
        return pd.DataFrame({"segment": [s], "types": [len(keys)], "tokens": [int(counts.sum())]})

    counted = _counted(texts, count_words, lambda k: _range_of(k, segments))
    built = cut(counted.groupBy("segment").applyInPandas(build_words, "segment int, types bigint, tokens bigint"))
    sizes = {r["segment"]: (r["types"], r["tokens"]) for r in built.toLocalIterator()}  # a row per segment
    types = [sizes.get(s, (0, 0))[0] for s in range(segments)]
    model = Model(folder, segments, tuple(np.cumsum([0, *types]).tolist()),
                  sum(t for _, t in sizes.values()), n_texts, mu, order)
    if model.types >= 1 << 32:
        raise ValueError("pairs are packed from two 32-bit word numbers")
    shared = spark.sparkContext.broadcast(model)

    def count_pairs(piece):
        _, _, previous, words = _pairs(shared.value, piece)
        return np.unique(previous.astype(U64) << U64(32) | words.astype(U64), return_counts=True)

    def build_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        s, m = int(rows["segment"].iloc[0]), shared.value
        keys, counts = _unpacked(rows)
        words = (keys & U64(0xFFFFFFFF)).astype(np.int64)
        seqs, heads, lengths = _ranges(keys, m.types)
        base = np.repeat(_counts_of(m, heads), lengths)
        p = (counts + m.mu * 10 ** _word_log10(m, _counts_of(m, words))) / (base + m.mu)
        level = np.clip(np.rint((np.log10(p) - _FLOOR) / _STEP), 0, 65535).astype(np.uint16)
        plain = {"log10p": level}
        if m.order > 2:
            seqs["large"], exact = _bytes_of(counts)
            plain |= exact
        write_level(f"{m.folder}/pairs-{s:07d}", {}, seqs, plain)
        return pd.DataFrame({"segment": [s], "pairs": [len(keys)]})

    counted = _counted(texts, count_pairs, lambda k: _pair_segment(k, segments))
    cut(counted.groupBy("segment").applyInPandas(build_pairs, "segment int, pairs bigint"))
    if order < 3:
        return model

    def count_triples(piece):
        m = shared.value
        offsets, _, previous, words = _pairs(m, piece)
        keys, inverse = np.unique(previous.astype(U64) << U64(32) | words.astype(U64), return_inverse=True)
        segment, place = _pair_entries(m, keys, places_only=True)[:2]
        _, segment, key = _triples(m, offsets, words, segment[inverse], place[inverse])
        k, c, of = _merged([key], [np.ones(len(key), np.int64)], [segment])
        return k, c, of

    def build_triples(rows: pd.DataFrame) -> pd.DataFrame:
        s, m = int(rows["segment"].iloc[0]), shared.value
        keys, counts = _unpacked(rows)
        seqs, _, _ = _ranges(keys, m.types)
        seqs["large"], plain = _bytes_of(counts)
        write_level(f"{m.folder}/triples-{s:07d}", {}, seqs, plain)
        return pd.DataFrame({"segment": [s], "triples": [len(keys)]})

    cut(_counted(texts, count_triples).groupBy("segment").applyInPandas(build_triples, "segment int, triples bigint"))
    return model


def _pair_entries(model: Model, keys: np.ndarray,
                  places_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, place, count, quantised log10 probability) of each packed pair; -1, -1, 0 and NaN where the pair was
    not seen, and counts are read for order 3 only; with ``places_only``, the last two are not read."""
    segment, place = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
    count, log10p = np.zeros(len(keys), np.int64), np.full(len(keys), np.nan)
    for s, at in _groups(_pair_segment(keys, model.segments)):
        try:
            _, seqs, plain = _level(f"{model.folder}/pairs-{s:07d}")
        except FileNotFoundError:  # no pair fell into this segment
            continue
        found = _find(seqs, keys[at], model.types)
        at, found = at[found >= 0], found[found >= 0]
        segment[at], place[at] = s, found
        if places_only:
            continue
        log10p[at] = plain["log10p"][found] * _STEP + _FLOOR
        if model.order > 2:
            count[at] = _count_at(seqs, plain, found)
    return segment, place, count, log10p


def _triple_counts(model: Model, segment: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Count of each triple, 0 where it was not seen."""
    out = np.zeros(len(keys), np.int64)
    for s, at in _groups(segment):
        try:
            _, seqs, plain = _level(f"{model.folder}/triples-{s:07d}")
        except FileNotFoundError:  # no triple fell into this segment
            continue
        found = _find(seqs, keys[at], model.types)
        out[at[found >= 0]] = _count_at(seqs, plain, found[found >= 0])
    return out


def _score_slice(model: Model, piece: pa.Array):
    offsets, count, previous, words = _pairs(model, piece)
    n = len(piece)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    alone = _word_log10(model, count)
    score = alone.copy()  # behind an unknown word
    after = np.flatnonzero(previous >= 0)
    heads, inverse = np.unique(previous[after], return_inverse=True)
    base = _counts_of(model, heads)
    score[after] += np.log10(model.mu / (base + model.mu))[inverse]
    both = np.flatnonzero((previous >= 0) & (words >= 0))
    keys, inverse = np.unique(previous[both].astype(U64) << U64(32) | words[both].astype(U64), return_inverse=True)
    entry = _pair_entries(model, keys)
    seen = entry[3][inverse]
    score[both] = np.where(np.isnan(seen), score[both], seen)
    if model.order > 2:
        segment, place, pair_count = (np.full(len(words), -1, np.int64) for _ in range(3))
        segment[both], place[both], pair_count[both] = (x[inverse] for x in entry[:3])
        inside = np.ones(len(words), bool)
        inside[offsets[:-1]] = False
        behind = np.flatnonzero(inside)
        behind = behind[place[behind - 1] >= 0]  # a pair that was seen is the context
        triples = np.zeros(len(words), np.int64)
        at, segment, key = _triples(model, offsets, words, segment, place)
        triples[at] = _triple_counts(model, segment, key)
        base = pair_count[behind - 1]
        score[behind] = np.log10((triples[behind] + model.mu * 10 ** score[behind]) / (base + model.mu))
    per_row = lambda x: np.bincount(rows, x, minlength=n)
    return np.diff(offsets), per_row(count > 0).astype(np.int64), per_row(alone), per_row(score)


def score_column(model: Model, text: Column, spark) -> Column:
    """struct(n_tokens, n_known, base_score, score) of a text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n_tokens:bigint,n_known:bigint,base_score:double,score:double>")
    def score(texts: pa.Array) -> pa.Array:
        parts = [_score_slice(shared.value, piece) for piece in slices(texts)]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        cols = [pa.array(np.concatenate(c), k) for c, k in zip(zip(*parts), kinds)] or [pa.array([], k) for k in kinds]
        return pa.StructArray.from_arrays(cols, ["n_tokens", "n_known", "base_score", "score"])

    return score(text)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, by a model
    of the rows that are not held out."""
    out = held_out(F.col(id_col))
    model = train(docs.filter(~out).select(F.col(text_col)), **options)
    s = F.col("s")
    return docs.select(F.col(id_col).alias("doc_id"), out.alias("held_out"),
                       score_column(model, F.col(text_col), docs.sparkSession).alias("s")).select(
        "doc_id", "held_out", s["n_tokens"].alias("n_tokens"), s["n_known"].alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), s["base_score"].alias("base_score"),
        s["score"].alias("score"))
