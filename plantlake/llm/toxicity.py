"""Toxicity by a support vector machine over a subsequence string kernel, with Nystroem landmarks.

Kernel: two strings are compared by their common subsequences of ``GRAM``
symbols that span ``SPAN`` symbols at most; an occurrence weighs ``DECAY`` per
symbol that it skips, and the product is divided by the roots of what strings
of these lengths have with themselves if they repeat nothing.  So ``i.d.i.o.t``, ``idxiot``
and a word's unseen endings stay close to the word.  Strings are the tokens of
a sentence between two edge marks, in lower case and without accents, with
digits that stand for letters read as those, and, if it has marks inside, a
token without them; single characters in a row (``i d i o t``) are joined
first, and a token of more than ``WINDOW`` symbols is taken in overlapping
windows.

Training: the sentences of labelled texts carry their text's label, and a
toxic text need only have one toxic token, so the machine learns on tokens
(multiple instances): those that toxic texts have significantly and much more
often.  Toxic texts count by the distinct left neighbours of the token there, so
that copies of one text do not make its words telling.  They stand against common, random and, in a second round,
the highest scoring tokens of clean texts.  ``LANDMARKS`` tokens of each side
span the Nystroem space; a squared hinge loss with L2 is minimised in it by
Newton's method.  As the decision is a sum of kernels with the landmarks, it is one weight per
subsequence: a table of 2^20 numbers that tasks look up, whatever the number
of landmarks.  A logistic model of a text's highest token, number of toxic
tokens and length turns the decisions into a score; it is fitted on the same
sample.

Sample: about ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled texts outside the
held-out fold, chosen by a hash of their id.  Labels are read in training
only.  Scoring is a map over all texts, whole.

Edge cases: a null text is empty, and an empty text gets the score of a text
without toxic tokens; null ids count as the empty string for the fold and have
no label; a text with several labels is toxic if one says so; null labels are
left out; without toxic tokens (or labels) every text gets the base rate;
repeated rows get equal scores; an empty table gives an empty table; extra
columns stay, and ``into`` replaces a column only if the caller names it so.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import slices, split_words
from .shared import cut

FOLDS, HELD_OUT = 5, 0
TOXIC_ROWS, CLEAN_ROWS = 4000, 12000
GRAM, SPAN, DECAY = 4, 8, 0.8
BITS = 5  # of a symbol
WINDOW = 24
LANDMARKS = 192
POOL = 1500  # tokens of each kind that the machine learns on
MIN_G2, MIN_ODDS = 20.0, 2.0  # log likelihood ratio and log odds ratio of a telling token
RIDGE = 1e-4
CLEAN_WEIGHT = 10.0  # of the clean side's loss against the toxic side's
SLICE_BYTES = 2 << 20
#: Characters that stand for letters, and those dropped at a token's ends.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
ENDS = ".,;:!?\"'()[]{}…«»“”’"
_MARKS = re.compile(r"[^\w@$!]|_")
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")
_OFFSETS = [(*o, end) for end in range(GRAM - 1, SPAN) for o in combinations(range(1, end), GRAM - 2)]


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


# ---------------------------------------------------------------- strings

def _symbol_table() -> np.ndarray:
    """Symbol of each code point below 0x250: 1-26 letters without accents, 27-30 other letters, 31 the rest;
    0 is the edge."""
    table = np.full(0x250, 31, np.uint32)
    for c in range(0x250):
        ch = unicodedata.normalize("NFD", LOOKALIKE.get(chr(c), chr(c).lower()))[0]
        if "a" <= ch <= "z":
            table[c] = ord(ch) - 96
        elif ch.isalpha():
            table[c] = 27 + ord(ch) % 4
    table[0] = 0
    return table


_SYMBOL = _symbol_table()


def symbols(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all tokens with an edge before each and behind the last, place of each token's first edge)."""
    points = np.frombuffer(("\0" + "\0".join(t.replace("\0", " ") for t in tokens) + "\0").encode("utf-32-le"),
                           np.uint32)
    s = np.where(points < 0x250, _SYMBOL[np.minimum(points, 0x24F)], 27 + points % 4).astype(np.uint32)
    edges = np.flatnonzero(points == 0)
    return s, edges[:-1]


def _norms() -> np.ndarray:
    """Root of the summed squared weights of a token's subsequences, by its length with edges."""
    weights = np.zeros(WINDOW + 3)
    for n in range(GRAM, len(weights)):
        weights[n] = sum(max(n - o[-1], 0) * DECAY ** (2 * (o[-1] + 1 - GRAM)) for o in _OFFSETS)
    return np.sqrt(np.maximum(weights, 1.0))


_NORM = _norms()


def subsequences(s: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per offsets: (position of the first symbol, key, weight) of all subsequences that stay in their token."""
    last = np.append(starts[1:], len(s) - 1)  # the closing edge of each token
    room = np.repeat(last, np.diff(np.append(starts, len(s) - 1))) - np.arange(len(s) - 1)
    for end in range(GRAM - 1, SPAN):
        at = np.flatnonzero(room >= end)
        head, tail = s[at] << np.uint32(BITS * (GRAM - 1)), s[at + end]
        inner = [s[at + k] for k in range(1, end)]
        for o in combinations(range(1, end), GRAM - 2):
            key = head | tail
            for k, place in enumerate(o):
                key = key | inner[place - 1] << np.uint32(BITS * (GRAM - 2 - k))
            yield at, key, DECAY ** (end + 1 - GRAM)


def windows(tokens: list[str]) -> tuple[list[str], np.ndarray]:
    """Tokens cut into overlapping windows of ``WINDOW`` symbols, and the token behind each.

    A token with marks inside is taken without them, too."""
    out, owner = list(tokens), list(range(len(tokens)))
    for i, t in enumerate(tokens):
        if not t.isalpha():
            letters = _MARKS.sub("", t)
            if letters != t:
                out.append(letters)
                owner.append(i)
    for k in [k for k, t in enumerate(out) if len(t) > WINDOW]:
        t = out[k]
        out[k] = t[:WINDOW]
        for at in range(WINDOW // 2, len(t) - WINDOW // 2, WINDOW // 2):
            out.append(t[at:at + WINDOW])
            owner.append(owner[k])
    return out, np.array(owner, np.int64)


def kernel(tokens: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel of every token with every landmark (both of ``WINDOW`` characters at most)."""

    def features(words):
        s, starts = symbols(words)
        found = [(np.searchsorted(starts, at, "right") - 1, key.astype(np.int64), np.full(len(at), w))
                 for at, key, w in subsequences(s, starts)]
        row, key, weight = (np.concatenate(x) for x in zip(*found))
        size = np.diff(np.append(starts, len(s) - 1)) + 1
        return row, key, weight / _NORM[size][row]

    row, key, weight = features(landmarks)
    known, place = np.unique(key, return_inverse=True)
    table = np.zeros((len(known), len(landmarks)), np.float32)
    np.add.at(table, (place, row), weight)
    out = np.zeros((len(tokens), len(landmarks)), np.float32)
    for at in range(0, len(tokens), 50):
        row, key, weight = features(tokens[at:at + 50])
        i = np.minimum(np.searchsorted(known, key), len(known) - 1)
        hit = np.flatnonzero(known[i] == key)
        hit = hit[np.argsort(row[hit], kind="stable")]
        first = np.flatnonzero(np.diff(row[hit], prepend=-1))
        if len(hit):
            out[at + row[hit[first]]] = np.add.reduceat(weight[hit, None].astype(np.float32) * table[i[hit]], first)
    return out.astype(np.float64)


# ------------------------------------------------------------------ model

@dataclass(frozen=True)
class Machine:
    """Weight per subsequence and bias; positive decisions are toxic tokens."""

    weights: np.ndarray
    bias: float

    def decide(self, tokens: list[str]) -> np.ndarray:
        """Decision per token (its highest window)."""
        if not tokens:
            return np.empty(0)
        pieces, owner = windows(tokens)
        s, starts = symbols(pieces)
        total = np.zeros(len(s) - 1)
        for at, key, w in subsequences(s, starts):
            total[at] += w * self.weights[key]
        size = np.diff(np.append(starts, len(s) - 1)) + 1
        value = np.add.reduceat(total, starts) / _NORM[size]
        out = np.full(len(tokens), -np.inf)
        np.maximum.at(out, owner, value)
        return out + self.bias


def train(toxic: list[str], clean: list[str], weight_toxic: np.ndarray, weight_clean: np.ndarray) -> Machine:
    """A machine from tokens of both sides (most telling first, for the landmarks) and their weights."""
    cut_to = lambda words: [w[:WINDOW] for w in words]
    toxic, clean = cut_to(toxic), cut_to(clean)
    landmarks = list(dict.fromkeys(toxic[:LANDMARKS] + clean[:LANDMARKS]))
    among = kernel(landmarks, landmarks)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    used = values > 1e-4 * values.max()
    root = vectors[:, used] / np.sqrt(values[used])  # the Nystroem map: kernel with the landmarks, times this
    x = kernel(toxic + clean, landmarks) @ root
    x = np.column_stack((x, np.ones(len(x))))
    y = np.concatenate((np.ones(len(toxic)), -np.ones(len(clean))))
    c = np.concatenate((weight_toxic / weight_toxic.sum(), CLEAN_WEIGHT * weight_clean / weight_clean.sum()))
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    loss = lambda w: ridge @ (w * w) / 2 + c @ np.maximum(1 - y * (x @ w), 0) ** 2
    for _ in range(100):
        slack = np.maximum(1 - y * (x @ w), 0)
        active = slack > 0
        gradient = ridge * w - 2 * (c * y * slack) @ x
        hessian = np.diag(ridge) + 2 * (x[active].T * c[active]) @ x[active]
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        size = next((2.0**-k for k in range(20) if loss(w - 2.0**-k * step) < now), 0.0)
        w = w - size * step
        if not size or now - loss(w) < 1e-9 * now:
            break
    beta = root @ w[:-1]
    table = np.zeros(1 << BITS * GRAM)
    s, starts = symbols(landmarks)
    size = np.diff(np.append(starts, len(s) - 1)) + 1
    for at, key, weight in subsequences(s, starts):
        row = np.searchsorted(starts, at, "right") - 1
        np.add.at(table, key, weight * beta[row] / _NORM[size][row])
    return Machine(table.astype(np.float32), float(w[-1]))


# ------------------------------------------------------------------ texts

def joined(text: str) -> str:
    """``text`` with runs of single characters between blanks as one token."""
    return _SPACED.sub(lambda m: re.sub("[ \t]", "", m[0]), text)


def _tokens(piece: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(row offsets, index of each token among the distinct ones, distinct tokens) of a slice of texts."""
    piece = pa.array([joined(t) for t in piece.to_pylist()], pa.string())
    offsets, words = split_words(piece)
    coded = words.dictionary_encode()
    trimmed = pc.utf8_trim(pc.utf8_lower(coded.dictionary), ENDS).dictionary_encode()
    return offsets, trimmed.indices.to_numpy()[coded.indices.to_numpy()], trimmed.dictionary.to_pylist()


_FEATURES = "struct<top:double,worst:string,n_toxic:bigint,n_tokens:bigint>"
_NONE = -3.0  # the decision of a text without tokens, and the least that counts


def _features(decide, piece: pa.Array) -> tuple[np.ndarray, list[str | None], np.ndarray, np.ndarray]:
    """Per text: highest decision, its token, number of toxic tokens, number of tokens."""
    offsets, index, distinct = _tokens(piece)
    value = np.maximum(decide(distinct), _NONE)
    n = np.diff(offsets)
    top, worst, toxic = np.full(len(n), _NONE), [None] * len(n), np.zeros(len(n), np.int64)
    if len(index):
        at = value[index]
        full = np.flatnonzero(n > 0)
        top[full] = np.maximum.reduceat(at, offsets[:-1][full])
        toxic = np.diff(np.concatenate(([0], np.cumsum(at > 0)))[offsets])
        for r in full.tolist():
            part = index[offsets[r]:offsets[r + 1]]
            worst[r] = distinct[part[value[part].argmax()]]
    return top, worst, toxic, n


def text_features(spark, machine: Machine):
    """UDF of a text's features under ``machine``."""
    shared = spark.sparkContext.broadcast(machine)  # 2^(BITS * GRAM) 32-bit numbers

    @F.arrow_udf(_FEATURES)
    def features(texts: pa.Array) -> pa.Array:
        parts = [_features(shared.value.decide, p) for p in slices(texts, SLICE_BYTES)]
        cols = [np.concatenate([np.empty(0), *(p[i] for p in parts)]) for i in (0, 2, 3)]
        return pa.StructArray.from_arrays(
            [pa.array(cols[0]), pa.array([w for p in parts for w in p[1]], pa.string()),
             pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.int64))],
            ["top", "worst", "n_toxic", "n_tokens"])

    return features


def token_counts(sample: DataFrame) -> DataFrame:
    """(token, n_toxic, n_clean, contexts): sample texts of each label that have the token, and 64 bits of the
    hashed left neighbours that it has in toxic ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, at = batch.column("toxic").to_numpy(False).astype(bool), 0
            for piece in slices(batch.column("text"), SLICE_BYTES):
                offsets, index, distinct = _tokens(piece)
                k = max(len(distinct), 1)
                rows = np.repeat(np.arange(len(piece)), np.diff(offsets))
                row, token = np.divmod(np.unique(rows * k + index), k)
                toxic = label[at + row]
                before = np.roll(index, 1)
                before[offsets[:-1][np.diff(offsets) > 0]] = len(distinct)  # a text's first token
                hashes = np.array([zlib.crc32(t.encode()) & 63 for t in distinct] + [0], np.uint64)
                bits, said = np.zeros(len(distinct), np.uint64), label[at + rows]
                np.bitwise_or.at(bits, index[said], np.uint64(1) << hashes[before[said]])
                at += len(piece)
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(distinct, pa.string()),
                    "n_toxic": np.bincount(token[toxic], minlength=len(distinct)).astype(np.int64),
                    "n_clean": np.bincount(token[~toxic], minlength=len(distinct)).astype(np.int64),
                    "contexts": bits.view(np.int64)})

    rows = sample.select("text", "toxic").mapInArrow(
        count, "token string, n_toxic bigint, n_clean bigint, contexts bigint")
    return rows.filter("token != ''").groupBy("token").agg(
        F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"), F.bit_or("contexts").alias("contexts"))


@dataclass(frozen=True)
class Model:
    machine: Machine | None
    logistic: tuple[float, ...]  # of bias, highest decision, log of toxic tokens, log of tokens
    rate: float


def _inputs(top, n_toxic, n_tokens) -> np.ndarray:
    return np.column_stack((np.ones(len(top)), np.clip(top, -1.5, 1.5), np.log1p(n_toxic), np.log1p(n_tokens)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic model with equally weighed classes (Newton's method, ridge)."""
    c = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (c * (p - y)) + 1e-3 * w
        step = np.linalg.solve((x.T * (c * np.maximum(p * (1 - p), 1e-6))) @ x + 1e-3 * np.eye(len(w)), gradient)
        w = w - np.clip(step, -2, 2)
    return tuple(w.tolist())


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, float]:
    """(toxic, text) of about TOXIC_ROWS and CLEAN_ROWS labelled rows outside the held-out fold; share of toxic ones."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col) \
        .agg((F.max(label_col) > 0).alias("toxic")).filter(~held_out(F.col(id_col)))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    part = lambda k, most: min(int(2**20 * most / max(n.get(k, 0), 1)) + 1, 2**20)
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(2**20))
    chosen = known.filter(draw < F.when(F.col("toxic"), part(True, TOXIC_ROWS)).otherwise(part(False, CLEAN_ROWS)))
    # About TOXIC_ROWS + CLEAN_ROWS short rows by the draw above.
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col)
    return cut(rows.select("toxic", "text")), n.get(True, 0) / max(sum(n.values()), 1)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """The model from labelled rows of ``docs`` that are not held out."""
    spark = docs.sparkSession
    sample, rate = sample_of(docs, labels, id_col, text_col, label_col)
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_t, n_c = n.get(True, 0), n.get(False, 0)
    if not n_t or not n_c:
        return Model(None, (), rate)
    bits = F.bit_count("contexts")  # of 64; nearly full ones say no more than "many"
    neighbours = F.when(bits < 60, -64 * F.log(1 - bits / 64)).otherwise(F.col("n_toxic"))
    counts = token_counts(sample).withColumn("n_toxic", F.least(F.col("n_toxic").cast("double"), neighbours))
    t, c = F.col("n_toxic"), F.col("n_clean")
    odds = F.log((t + 0.5) / (n_t - t + 0.5)) - F.log((c + 0.5) / (n_c - c + 0.5))
    part = lambda x, n: F.when(x > 0, x * F.log(x * (n_t + n_c) / ((t + c) * n))).otherwise(0.0)
    counts = cut(counts.select("token", t, c, odds.alias("odds"), (2 * (part(t, n_t) + part(c, n_c))).alias("g2")))
    first = lambda rows, *by: rows.orderBy(*by, "token").limit(POOL).collect()
    telling = first(counts.filter((F.col("g2") >= MIN_G2) & (F.col("odds") >= MIN_ODDS)), F.desc("g2"))
    if not telling:
        return Model(None, (), rate)
    others = counts.filter((c > 0) & (F.col("odds") < MIN_ODDS / 2))
    common, random = first(others, F.desc("n_clean")), first(others, F.xxhash64("token"))
    toxic = {r["token"]: r["n_toxic"] for r in telling}
    clean = {r["token"]: r["n_clean"] for r in [*common, *random]}

    def machine(hard: list[str]) -> Machine:
        rest = [w for w in clean if w not in set(hard)]
        weight = np.concatenate((np.full(len(hard), 5.0), np.log1p([clean[w] for w in rest])))
        return train(list(toxic), hard + rest, np.array(list(toxic.values()), float), weight)

    features = lambda m: sample.select("toxic", text_features(spark, m)("text").alias("f")) \
        .select("toxic", "f.*")
    # The tokens of clean texts that a first machine finds most toxic.
    worst = features(machine([])).filter(~F.col("toxic") & F.col("worst").isNotNull()).groupBy("worst") \
        .agg(F.max("top").alias("top")).orderBy(F.desc("top"), "worst").limit(POOL // 3).collect()
    final = machine([r["worst"] for r in worst if r["worst"] not in toxic])
    # Three numbers a sample row.
    seen = features(final).select("toxic", "top", "n_toxic", "n_tokens").toArrow().to_pandas()
    x = _inputs(seen["top"].to_numpy(), seen["n_toxic"].to_numpy(), seen["n_tokens"].to_numpy())
    return Model(final, _logistic(x, seen["toxic"].to_numpy().astype(float)), rate)


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``into``: held_out, score (0 to 1), predicted, worst (token) and n_toxic (tokens)."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    fold, text = held_out(F.col(f"`{id_col}`")), F.col(f"`{text_col}`")
    if model.machine is None:
        score, worst, n_toxic = F.lit(model.rate), F.lit(None).cast("string"), F.lit(0).cast("bigint")
        return docs.withColumn(into, F.struct(
            fold.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
            worst.alias("worst"), n_toxic.alias("n_toxic")))
    shared, weights = docs.sparkSession.sparkContext.broadcast(model.machine), np.array(model.logistic)

    @F.arrow_udf("struct<score:double,worst:string,n_toxic:bigint>")
    def scored(texts: pa.Array) -> pa.Array:
        scores, words, toxic = [np.empty(0)], [], [np.empty(0, np.int64)]
        for piece in slices(texts, SLICE_BYTES):
            top, worst, n_toxic, n = _features(shared.value.decide, piece)
            scores.append(1 / (1 + np.exp(-np.clip(_inputs(top, n_toxic, n) @ weights, -30, 30))))
            words += worst
            toxic.append(n_toxic)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(scores)), pa.array(words, pa.string()),
                                           pa.array(np.concatenate(toxic))], ["score", "worst", "n_toxic"])

    s = F.col(into)
    return docs.withColumn(into, scored(text)).withColumn(into, F.struct(
        fold.alias("held_out"), s["score"].alias("score"), (s["score"] >= 0.5).cast("int").alias("predicted"),
        s["worst"].alias("worst"), s["n_toxic"].alias("n_toxic")))
