"""Language identification by Bayesian evidence fusion.

For each row, four kinds of evidence are added in log space:
- text: smoothed likelihoods of hashed byte trigrams; all trigrams of the text
  count, and their mean is weighed as ``TEXT_WEIGHT`` of them at most, because
  overlapping trigrams are far from independent;
- the language that the row's markup declares, right with probability
  ``DECLARED``;
- the address suffix, where it is a country's, right with ``SUFFIX``;
- a host prior: the languages that the text alone gave to the host's rows,
  counted by one grouped aggregation and smoothed towards the counts of the
  host's suffix, and those towards the counts of all rows (``SMOOTH`` pseudo
  rows on each level).

Besides the labels there is one more hypothesis, some other language or none:
its trigrams are uniform over the buckets, its prior is ``OTHER``, and no
statement speaks for it.  Where it is the likeliest, the language is ``und``.

The trigram model is fitted on a bounded sample of labelled rows: about
``PER_LANGUAGE`` rows of each label, drawn by a hash of their id.
Counts of hosts cover all rows; a host with a third of all rows is reduced to
one row per language and task before the shuffle.

Edge cases: a text of fewer than three bytes (or null) has no text evidence:
its language is ``und``, and it is not accepted; a null host or suffix is a
group of its own; ties go to the first language by name; an empty table of
labels makes every row ``und``, and one of documents gives an empty table;
repeated rows are each judged and counted; a long text is worked through in
runs of ``RUN`` bytes; extra columns stay, whatever they are called, and
``into`` replaces a column only if the caller names it so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import raw_bytes, release, slices
from .shared import cut, fresh

PER_LANGUAGE = 500
MAX_LANGUAGES = 256
BUCKETS = 1 << 14
RUN = 1 << 16  # bytes of text whose trigrams are looked up at once: RUN x labels numbers
OTHER = 0.01  # prior probability of a language without a label
ALPHA = 0.5
TEXT_WEIGHT = 60
DECLARED = 0.9
SUFFIX = 0.7
SMOOTH = 10.0
MIN_PROBABILITY = 0.5
#: Address suffixes of countries and their main language.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en",
                   "au": "en", "nz": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl"}
_DRAWS = 1 << 30  # resolution of the sample's draw
_SCALE = 1 << 16  # fixed point, so that sums do not depend on the order of a batch


def _trigrams(piece: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all byte trigrams (ASCII lower-cased) that lie inside one row, in runs of ``RUN`` bytes:
    (row of each, bucket of each), rows ascending."""
    offsets, data = raw_bytes(piece)
    b = np.frombuffer(data.lower(), np.uint8)
    last = offsets[1:] - 2  # each row's first place that begins no trigram (or before the row's start)
    for start in range(0, len(b) - 2, RUN):
        run = b[start:start + RUN + 2].astype(np.uint32)
        tri = run[:-2] | run[1:-1] << np.uint32(8) | run[2:] << np.uint32(16)
        bucket = (tri * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
        first, stop = np.searchsorted(offsets, (start, start + len(tri) - 1), "right") - 1
        rows = np.arange(first, stop + 1)
        lo = np.maximum(offsets[rows] - start, 0)
        n = np.maximum(np.minimum(last[rows] - start, len(tri)) - lo, 0)
        inside = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield np.repeat(rows, n), bucket[inside]


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages, fixed-point log likelihoods [bucket, language]) from a bounded sample of labelled rows."""
    known = labelled.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(label_col).alias("lang"),
                            F.col(text_col).alias("text")).filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    languages = sorted(sizes)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    if not languages:
        return [], np.empty((BUCKETS, 0), np.int32)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, min(int(_DRAWS * per_language / n) + 1, _DRAWS))])
    sample = known.filter(F.pmod("h", F.lit(_DRAWS)) < share[F.col("lang")]).select("lang", "text").dropDuplicates()

    def count(batches):
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                rows = batch.filter(pa.compute.equal(batch.column("lang"), lang))
                total = np.zeros(BUCKETS, np.int64)
                for piece in slices(rows.column("text"), 1 << 20):
                    for _, bucket in _trigrams(piece):
                        total += np.bincount(bucket, minlength=BUCKETS)
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": at,
                                                  "n": total[at]})

    # BUCKETS rows of three numbers per label at most.
    counts = sample.mapInArrow(count, "lang string, bucket bigint, n bigint") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((BUCKETS, len(languages)), ALPHA)
    place = pa.compute.index_in(counts["lang"], pa.array(languages)).to_numpy()
    table[counts["bucket"].to_numpy(), place] += counts["n"].to_numpy()
    return languages, np.rint(np.log(table / table.sum(axis=0)) * _SCALE).astype(np.int32)


def text_evidence(spark, model: tuple[list[str], np.ndarray], text: Column) -> Column:
    """Array of log likelihoods, one per language; null for a text without trigrams."""
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x MAX_LANGUAGES 32-bit numbers at most

    @F.arrow_udf("array<double>")
    def evidence(texts: pa.Array) -> pa.Array:
        languages, table = shared.value
        parts, empty = [np.empty((0, len(languages)))], [np.empty(0, bool)]
        for piece in slices(texts, 1 << 20):
            n, total = np.zeros(len(piece), np.int64), np.zeros((len(piece), len(languages)), np.int64)
            for row, bucket in _trigrams(piece):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                if len(first):
                    n[row[first]] += np.diff(np.append(first, len(row)))
                    total[row[first]] += np.add.reduceat(table[bucket], first, axis=0, dtype=np.int64)
            weight = np.minimum(n, TEXT_WEIGHT) / np.maximum(n, 1)
            parts.append(total * (weight / _SCALE)[:, None])
            empty.append(n == 0)
        values, none = np.concatenate(parts), np.concatenate(empty)
        release()
        offsets = pa.array(np.arange(len(values) + 1) * len(languages), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), pa.float64()),
                                        mask=pa.array(none)) if len(values) else pa.array([], pa.list_(pa.float64()))

    return evidence(text)


def declared_language(markup: Column) -> Column:
    """Two- or three-letter language that the markup declares (html lang, or content-language), else null."""
    html = F.lower(F.regexp_extract(markup, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2,3})\b""", 1))
    meta = F.lower(F.regexp_extract(
        markup, r"""(?i)<meta\b[^>]*?content-language[^>]*?\scontent\s*=\s*["']?([a-z]{2,3})\b""", 1))
    return F.when(html != "", html).when(meta != "", meta)


def _first_best(scores: Column, languages: list[str]) -> Column:
    """Name of the (first) best score; null without scores."""
    names = F.array(*[F.lit(x) for x in languages])
    best = F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))
    return F.when(scores.isNotNull(), best)


def _counts(languages: list[str], lang: str) -> list[Column]:
    return [F.count(F.when(F.col(lang) == x, 1)).alias(f"n{i}") for i, x in enumerate(languages)]


def host_priors(judged: DataFrame, languages: list[str]) -> DataFrame:
    """(host, suffix, prior): smoothed language probabilities of every host from (host, suffix, lang) rows."""
    n = [f"n{i}" for i in range(len(languages))]
    hosts = cut(judged.filter("lang is not null").groupBy("host", "suffix").agg(*_counts(languages, "lang")))
    row = hosts.agg(*[F.sum(c) for c in n]).first()
    total = sum(x or 0 for x in row)
    everywhere = [((x or 0) + 1.0) / (total + len(languages)) for x in row]
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(c).alias(c) for c in n])
    size = sum((F.col(c) for c in n[1:]), F.col(n[0]))
    smoothed = [((F.col(c) + SMOOTH * everywhere[i]) / (size + SMOOTH)).alias(f"s{i}") for i, c in enumerate(n)]
    suffixes = suffixes.select(F.col("suffix").alias("sfx"), *smoothed)
    prior = F.array(*[(F.col(c) + SMOOTH * F.col(f"s{i}")) / (size + SMOOTH) for i, c in enumerate(n)])
    return hosts.join(suffixes, F.col("suffix").eqNullSafe(F.col("sfx"))).select("host", "suffix", prior.alias("prior"))


def _statement(languages: list[str], said: Column, right: float) -> Column:
    """Log evidence per language of a statement that is right with probability ``right``; zeros where it is null or
    names another language."""
    names = F.array(*[F.lit(x) for x in languages])
    wrong = math.log((1 - right) / max(len(languages) - 1, 1))
    return F.when(F.array_contains(names, said), F.transform(
        names, lambda x: F.when(x == said, math.log(right)).otherwise(wrong))).otherwise(
        F.array(*[F.lit(0.0)] * len(languages)))


def _fused(languages: list[str], ll: Column, size: Column, prior: Column, declared: Column, suffix: Column) -> Column:
    """Posterior of a row from its text, host prior, declared language and address suffix (null without text)."""
    k = len(languages)
    names = F.array(*[F.lit(x) for x in languages])
    country = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])[suffix]
    host = F.coalesce(prior, F.array(*[F.lit(1.0 / k)] * k))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    score = plus(F.zip_with(ll, host, lambda x, y: x + F.log(y) + math.log1p(-OTHER)),
                 plus(_statement(languages, declared, DECLARED), _statement(languages, country, SUFFIX)))
    # Trigrams that count, each with a chance of one in BUCKETS in another language.
    other = math.log(OTHER) - math.log(BUCKETS) * F.least(size, F.lit(TEXT_WEIGHT))
    return F.struct(score.alias("score"), F.array_max(score).alias("best"), other.alias("other"), host.alias("host"),
                    declared.alias("declared"), country.alias("country"),
                    F.element_at(names, F.array_position(ll, F.array_max(ll)).cast("int")).alias("guess"))


def _verdict(languages: list[str], f: Column) -> Column:
    """The result from a row's ``_fused`` numbers."""
    names = F.array(*[F.lit(x) for x in languages])
    top = F.greatest(f["best"], f["other"])
    total = F.aggregate(f["score"], F.exp(f["other"] - top), lambda a, x: a + F.exp(x - top))
    known = F.coalesce(f["best"] >= f["other"], F.lit(False))  # null: a text without trigrams
    place = F.array_position(f["score"], f["best"]).cast("int")
    probability = F.when(known, F.exp(f["best"] - top) / total).otherwise(0.0)
    return F.struct(
        F.when(known, F.element_at(names, place)).otherwise("und").alias("lang"), probability.alias("probability"),
        f["guess"].alias("text_lang"), f["declared"].alias("declared"), f["country"].alias("suffix_lang"),
        F.when(known, F.element_at(f["host"], place)).otherwise(0.0).alias("host_prior"),
        (probability >= MIN_PROBABILITY).alias("accepted"))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text: Column, host: Column,
             suffix: Column | None = None, declared: Column | None = None, into: str = "language") -> DataFrame:
    """``docs`` with a struct ``into``: lang, probability, text_lang, declared, suffix_lang, host_prior, accepted.

    ``suffix`` is the last label of the row's address, ``declared`` the language its markup names.
    """
    spark, (languages, _) = docs.sparkSession, model
    none = F.lit(None).cast("string")
    if not languages:
        return docs.withColumn(into, F.struct(
            F.lit("und").alias("lang"), F.lit(0.0).alias("probability"), none.alias("text_lang"),
            none.alias("declared"), none.alias("suffix_lang"), F.lit(0.0).alias("host_prior"),
            F.lit(False).alias("accepted")))
    e = fresh(docs, "__evidence")
    p = fresh(docs.withColumn(e, F.lit(0)), "__prior")
    suffix, declared = none if suffix is None else suffix, none if declared is None else declared
    ll = text_evidence(spark, model, text)
    seen = docs.select(host.alias("host"), suffix.alias("suffix"), ll.alias("ll"))
    priors = host_priors(seen.select("host", "suffix", _first_best(F.col("ll"), languages).alias("lang")), languages)
    priors = cut(priors.select(F.struct(F.col("host").alias("p_host"), F.col("suffix").alias("p_suffix"),
                                        "prior").alias(p)))  # one short row per host
    rows = docs.withColumn(e, F.struct(host.alias("host"), suffix.alias("suffix"), declared.alias("declared"),
                                       F.greatest(F.octet_length(text) - 2, F.lit(0)).alias("n"), ll.alias("ll")))
    x, prior = F.col(e), F.col(p)
    rows = rows.join(priors, x["host"].eqNullSafe(prior["p_host"]) & x["suffix"].eqNullSafe(prior["p_suffix"]), "left")
    fused = _fused(languages, x["ll"], F.coalesce(x["n"], F.lit(0)), prior["prior"], x["declared"], x["suffix"])
    # One struct of numbers first, so that no expression is computed twice.
    rows = rows.withColumn(e, fused)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], _verdict(languages, F.col(e)).alias(into))


def identify_documents(docs: DataFrame, labelled: DataFrame, into: str = "language") -> DataFrame:
    """``identify`` for tables like ``documents``: the source is the host; markup is looked for in the text."""
    text = F.col("text")
    return identify(docs, fit(labelled), text=text, host=F.col("source"), declared=declared_language(text), into=into)


def identify_pages(pages: DataFrame, labelled: DataFrame, into: str = "language") -> DataFrame:
    """``identify`` for raw web pages (url, html); the text is the html without scripts, styles and tags."""
    html = F.col("html")
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    host = F.lower(F.regexp_extract(F.col("url"), r"://([^/?#:]*)", 1))
    suffix = F.element_at(F.split(host, r"\."), -1)
    return identify(pages, fit(labelled), text=text, host=host, suffix=suffix, declared=declared_language(html),
                    into=into)
