"""Operators that shuffle or write files, against brute force, and their edge cases."""
import base64
import gzip
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantlake.llm import language_id, lm_score, mixing, near_dup, warc
from plantlake.llm.arrow_text import shingles
from plantlake.llm.elias_fano import EliasFano, read_level, write_level
from plantlake.llm.shared import new_folder

from .test_text_operators import SF, frame, words

# ------------------------------------------------------------------ near duplicates


def bag(text):
    ws = words(text)
    return Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else Counter([tuple(ws)] if ws else [])


def similarity(a, b):
    both = sum((a & b).values())
    total = sum((a | b).values())
    return both / total if total else 0.0


def brute_classes(rows):
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    low = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return [(doc_id, low[find(i)], len(groups[find(i)])) for i, (doc_id, _) in enumerate(rows)]


def got_classes(spark, rows):
    out = near_dup.classes(frame(spark, rows)).collect()
    return sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in out), key=str)


def test_weighted_signatures_estimate_the_similarity():
    rng = random.Random(2)
    a = Counter({i: rng.choice([1, 1, 2, 3, 9, 40]) for i in range(60)})
    b = Counter({i: max(1, a[i] + rng.choice([-3, 0, 0, 5])) for i in range(10, 60)}) + Counter({i: 2 for i in range(90, 99)})
    keys = np.array([hash((i, 7)) % 2 ** 64 for i in range(99)], np.uint64)
    h = np.concatenate([keys[list(a)], keys[list(b)]])
    rows = np.repeat([0, 1], [len(a), len(b)])
    sig = near_dup.bag_min_hash(h, rows, np.array([*a.values(), *b.values()]), 2, 20_000)
    assert np.isfinite(sig).all()
    assert (sig[0] == sig[1]).mean() == pytest.approx(similarity(a, b), abs=0.015)


def variants(seed):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    rows, no = [], itertools.count()
    for _ in range(25):
        text = rng.choices(vocab, k=rng.randrange(30, 200))
        for _ in range(rng.randrange(1, 6)):
            rows.append((next(no), " ".join(text)))
            text = list(text)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    return rows


EDGES = [(900, None), (901, ""), (902, "..."), (903, "a b"), (904, "A  b!"), (905, "a b c"), (906, "la " * 5000),
         (907, "la " * 4800), (908, "la " * 300), (None, "null id one two three four"), (None, "null id one two three four"),
         (909, "null id one two three four"), (910, "same id"), (910, "same id"), (910, "other text here"), (None, "only null")]


def test_near_duplicates_equal_brute_force(spark):
    rows = variants(4) + EDGES
    assert got_classes(spark, rows) == sorted(brute_classes(rows), key=str)


def test_near_duplicates_of_the_test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted(brute_classes(rows), key=str)
    assert got_classes(spark, rows) == want and any(size > 1 for _, _, size in want)


def test_keep_one_of_each_class(spark):
    rows = variants(4) + EDGES
    docs = frame(spark, rows)
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=str)
    classes = {}
    for (doc_id, text), (_, cls, _) in zip(rows, brute_classes(rows)):
        if not words(text):
            classes["no words", doc_id] = doc_id
        else:
            # Equal ids in one class are one document; without any id a text is its own class.
            classes[("class", cls) if cls is not None else ("text", text), cls == 910 and tuple(words(text))] = cls
    assert got == sorted(classes.values(), key=str)


def test_near_duplicates_of_an_empty_table(spark):
    assert near_dup.classes(frame(spark, [])).count() == 0
    assert near_dup.keep_one(frame(spark, [])).count() == 0


def test_a_chain_is_one_class(spark):
    """Neighbours are similar, ends are not: links through several leaders and rounds must meet."""
    base = [f"c{i}" for i in range(300)]
    rows = [(i, " ".join(base[8 * i:] + [f"new{j}" for j in range(8 * i)])) for i in range(20)]
    bags = [bag(t) for _, t in rows]
    assert similarity(bags[0], bags[-1]) < 0.5 and all(similarity(a, b) >= 0.8 for a, b in zip(bags, bags[1:]))
    assert {c for _, c, _ in got_classes(spark, rows)} == {0}


def test_shingle_hashes_follow_the_words():
    texts = ["a b c d e f", "A, b c D-e f!", "x", "", "é è ê ë œ", "b c d e f"]
    h, rows, n = shingles(pa.array(texts), 5)
    per = [set(h[rows == i].tolist()) for i in range(len(texts))]
    assert per[0] == per[1] and len(per[0]) == 2 and per[5] < per[0] and len(per[2]) == 1 and not per[3]
    assert n.tolist() == [6, 6, 1, 0, 5, 5]


# ------------------------------------------------------------------------ mixing

def brute_mix(sizes, share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, clamped = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(epochs * sizes[s] for s in clamped)
        total = sum(w[s] for s in sizes if s not in clamped)
        over = {s for s in sizes if s not in clamped and epochs * sizes[s] <= w[s] * rest / total} if total else set()
        if not over:
            return {s: epochs * sizes[s] if s in clamped else w[s] * rest / total for s in sizes}
        clamped |= over


def test_mixing_targets_and_samples(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(0, 200), rng.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"])) for i in range(600)]
    rows += [(700, None, "tiny"), (701, "", "tiny"), (702, "x", "one"), (702, "x", "one"), (None, "n n", "one")]
    docs = frame(spark, rows)
    got = mixing.taken(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, taken, biggest = brute_mix(sizes), Counter(), Counter()
    source_of = {i: s for i, _, s in rows}
    for r in got:
        s = source_of[r["doc_id"]] if r["doc_id"] is not None else "one"
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
        biggest[s] = max(biggest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(biggest[s], 2), s
    again = mixing.taken(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_repeat_gives_the_taken_copies(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("sk", F.lit(1)).withColumn("whole", F.lit("x")) \
        .withColumn("copy_no", F.lit(0))
    mixed = mixing.repeat(docs)
    assert mixed.columns == [*docs.columns, "_copy_no"]
    counts = mixed.groupBy("doc_id").count()
    taken = mixing.taken(docs)
    assert taken.join(counts, "doc_id", "left").filter(
        F.coalesce("count", F.lit(0)) * F.col("size") != F.col("taken")).count() == 0
    empty = docs.limit(0)
    assert mixing.taken(empty).count() == 0 and mixing.repeat(empty).count() == 0


# -------------------------------------------------------------------------- WARC

PAGES = "page_id bigint, url string, html string, payload string, first string"


def brute_warc(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        lead = first.get(html or "", page_id)
        response = page_id == lead
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if response else "revisit", None if response else lead))
    return sorted(out, key=str)


WARC_ROWS = [(1, "http://a/ b\n", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "x" * 3_000_000),
             (5, "u", "x" * 3_000_000), (5, "u", "x" * 3_000_000), (0, "u", "<p>é</p>"), (7, "u", "\r\n\r\nWARC/1.1\r\n"),
             (None, "u", "null id"), (None, "u", "<p>é</p>"), (9, "u", "a\0b")]


@pytest.mark.parametrize("least", [0, 100])
def test_warc_round_trip(spark, least):
    pages = frame(spark, WARC_ROWS, PAGES)
    got = [tuple(r) for r in warc.round_trip(pages, min_revisit_bytes=least).collect()]
    assert sorted(got, key=str) == brute_warc(WARC_ROWS, least)
    assert warc.round_trip(frame(spark, [], PAGES)).count() == 0


def test_warc_chunks_carry_running_digests(spark):
    pages = frame(spark, WARC_ROWS, PAGES).repartition(2)
    manifest = warc.write_archives(warc.record_plan(pages), new_folder(spark, "warc"), archive_bytes=1000)
    assert manifest.count() > 2  # more archives than tasks
    rows = warc.read_chunks(manifest, chunk_bytes=1000).orderBy("record_id", "chunk_no").collect()
    bodies = {}
    for r in rows:
        assert len(r["payload"]) == r["n_bytes"] <= 1000
        bodies[r["record_id"]] = bodies.get(r["record_id"], b"") + r["payload"] if r["chunk_no"] else r["payload"]
        if r["record_type"] == "response":
            assert r["digest_so_far"] == base64.b32encode(hashlib.sha1(bodies[r["record_id"]]).digest()).decode()
    texts = {h or "" for _, _, h in WARC_ROWS}
    assert texts <= {b.decode() for b in bodies.values()}


def test_warc_long_payload_is_chunk_rows_before_the_shuffle(spark):
    n = 100_000_000
    pages = spark.range(2).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") == 0, F.repeat(F.concat(F.lit("123456789"), F.col("id").cast("string")), n // 10)).otherwise("short").alias("html"),
        F.lit(7).alias("record"), F.lit("x").alias("chunk_no"))
    plan = warc.record_plan(pages)
    assert plan.agg(F.max(F.octet_length("payload"))).first()[0] == warc.CHUNK_BYTES
    folder = new_folder(spark, "warc")
    chunks = warc.read_chunks(warc.write_archives(plan, folder))
    got = {r["page_id"]: r for r in warc.records(chunks).collect()}
    sha = hashlib.sha1(b"1234567890" * (n // 10)).digest()
    assert got[0]["payload_bytes"] == n and got[0]["payload_digest"] == base64.b32encode(sha).decode()
    sizes = chunks.filter("page_id = 0").agg(F.count(F.lit(1)), F.max("n_bytes")).first()
    assert tuple(sizes) == (-(-n // warc.CHUNK_BYTES), warc.CHUNK_BYTES) and got[1]["payload_bytes"] == 5


def test_a_damaged_archive_is_an_error(spark):
    pages = frame(spark, [(1, "u", "hello world")], PAGES)
    manifest = warc.write_archives(warc.record_plan(pages), new_folder(spark, "warc"))
    path = manifest.first()["archive"].removeprefix("file:")
    with gzip.open(path) as f:
        data = f.read()
    with gzip.open(path, "wb") as f:
        f.write(data.replace(b"hello", b"hullo"))
    with pytest.raises(Exception, match="digest"):
        warc.read_chunks(manifest).collect()


# -------------------------------------------------------------------------- LM

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=80), st.integers(0, 64), st.lists(st.integers(0, 2 ** 64 - 1), max_size=30))
def test_elias_fano_finds_what_is_there(values, shift, asked):
    v = np.unique(np.array(values, np.uint64) >> np.uint64(min(shift, 63)))
    ef = EliasFano.build(v, 2 ** (64 - min(shift, 63)))
    assert ef.get(np.arange(len(v))).tolist() == v.tolist()
    q = np.array([*v.tolist(), *(x >> min(shift, 63) for x in asked)], np.uint64)
    place = {x: i for i, x in enumerate(v.tolist())}
    assert ef.find(q).tolist() == [place.get(x, -1) for x in q.tolist()]


def test_level_files_keep_their_arrays(tmp_path):
    v = np.arange(0, 10_000, 7, dtype=np.uint64)
    write_level(str(tmp_path / "x"), {"m": 1}, {"v": EliasFano.build(v, 10_000), "none": EliasFano.build(v[:0], 5)},
                {"p": np.arange(3)})
    meta, seqs, plain = read_level(str(tmp_path / "x"))
    assert meta == {"m": 1} and (seqs["v"].get(np.arange(len(v))) == v).all() and plain["p"].tolist() == [0, 1, 2]
    assert seqs["none"].find(v).tolist() == [-1] * len(v)


def brute_lm(rows):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    split = lambda t: [*[w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").translate(lower)) if w], None]
    out_of = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    one, two, texts = Counter(), Counter(), 0
    for i, t in rows:
        if not out_of(i):
            ws, texts = split(t), texts + 1
            one.update(ws)
            two.update(zip(["<s>", *ws], ws))
    n, v = sum(one.values()), len(one)
    p1 = lambda w: (one[w] + 1) / (n + v + 1)
    result = []
    for i, t in rows:
        ws = split(t)
        score = sum(math.log10((two[a, b] + 4 * p1(b)) / ((texts if a == "<s>" else one[a]) + 4))
                    for a, b in zip(["<s>", *ws], ws))
        result.append((i, out_of(i), len(ws), sum(one[w] > 0 for w in ws), n, sum(math.log10(p1(w)) for w in ws), score))
    return result


@pytest.mark.parametrize("segment_bytes", [16 << 20, 2000])
def test_scores_equal_brute_force(spark, segment_bytes):
    rng = random.Random(9)
    vocab = ["The", "the", "é", "É", "b", "c,", "x" * 300, "ſ"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randrange(40))) + rng.choice(["", "\n", "\x0b", " z"]))
            for i in range(150)]
    rows += [(200, None), (201, ""), (202, "the " * 20_000), (None, "the b"), (0, rows[0][1])]
    rows += [(i, f"only {i} here") for i in range(300, 330)]
    got = sorted(map(tuple, lm_score.score(frame(spark, rows), segment_bytes=segment_bytes).collect()), key=str)
    want = sorted(brute_lm(rows), key=lambda r: str(r[:2]))
    assert len(got) == len(want)
    got = sorted(got, key=lambda r: (str(r[:4]), r[5]))
    for g, w in zip(got, sorted(want, key=lambda r: (str(r[:4]), r[5]))):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5])
        assert g[6] == pytest.approx(w[6], abs=1e-6 + g[2] * lm_score._STEP)  # quantised by half a step a token


def test_pairs_beat_single_words_on_held_out_texts(spark):
    got = lm_score.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    r = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r["s"] > r["b"]


def test_scores_without_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm_score.score(frame(spark, [(held, "a b")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert lm_score.score(frame(spark, [])).count() == 0


# ------------------------------------------------------------------- language ID

def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs.filter("doc_id % 2 = 0"))
    got = language_id.identify(docs.filter("doc_id % 2 = 1"), model, text=F.col("text"), host=F.col("source"), into="r")
    right = got.agg(F.avg((F.col("r.lang") == F.col("lang")).cast("double")), F.avg(F.col("r.accepted").cast("double"))).first()
    assert right[0] > 0.98 and right[1] > 0.98


def model_of(languages, buckets=None):
    return languages, np.full((language_id.BUCKETS, len(languages)), -9 << 16, np.int32) if buckets is None else buckets


def test_evidence_is_fused_by_bayes(spark):
    """Text that says nothing: the declared language, the suffix and the smoothed host prior decide."""
    rows = [(1, "xxxx", "h1", None, None), (2, "xxxx", "h1", "fr", None), (3, "xxxx", "h1", None, "de"),
            (4, None, "h2", "fr", "fr"), (5, "xxxx", None, None, "zz"), (1, "xxxx", "h1", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, host string, declared string, suffix string")
    got = {r["doc_id"]: r["r"] for r in language_id.identify(
        docs, model_of(["de", "en", "fr"]), text=F.col("text"), host=F.col("host"), declared=F.col("declared"),
        suffix=F.col("suffix"), into="r").collect()}
    # Every text is a tie, which the first name wins: 5 rows "de" overall, 2 + 1 of host h1 without a suffix.
    # Four bytes are two trigrams; the model gives each -9, another language log(1 / BUCKETS).
    k, total = 10.0, 5
    unknown = math.exp(math.log(0.01) - 2 * math.log(language_id.BUCKETS) + 18) / 0.99
    top = [(n + 1) / (total + 3) for n in (5, 0, 0)]
    sfx = [(n + k * t) / (3 + k) for n, t in zip((3, 0, 0), top)]
    host = [(n + k * t) / (3 + k) for n, t in zip((3, 0, 0), sfx)]
    say = [host[0] * 0.05, host[1] * 0.05, host[2] * 0.9]
    assert got[1]["lang"] == "de" and got[1]["probability"] == pytest.approx(host[0] / (sum(host) + unknown))
    best = max(range(3), key=say.__getitem__)
    assert got[2]["lang"] == ["de", "en", "fr"][best] and got[2]["probability"] == pytest.approx(
        say[best] / (sum(say) + unknown))
    assert got[3]["lang"] == "de" and got[3]["suffix_lang"] == "de"
    assert (got[4]["lang"], got[4]["accepted"], got[4]["probability"]) == ("und", False, 0.0)
    assert got[5]["suffix_lang"] is None and got[5]["lang"] == "de"


def test_language_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, per_language=20)
    rows = frame(spark, [(1, None), (2, ""), (3, "ab"), (4, "the and that with " * 30_000)])
    rows = rows.withColumn("host", F.lit("x")).withColumn("suffix", F.lit(1))
    got = {r["doc_id"]: r["l"]["lang"] for r in language_id.identify(
        rows, model, text=F.col("text"), host=F.col("source"), into="l").collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en"}
    none = language_id.fit(docs.limit(0))
    assert {r["l"]["lang"] for r in language_id.identify(rows, none, text=F.col("text"), host=F.col("source"), into="l")
            .collect()} == {"und"}
    assert language_id.identify(rows.limit(0), model, text=F.col("text"), host=F.col("source"), into="l").count() == 0


def test_noise_and_other_languages_are_rejected(spark):
    rng = random.Random(9)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    texts = ["".join(rng.choice("bcdfghjklmnpqrstvwxz ") for _ in range(400)), "съешь же ещё этих мягких булок " * 9,
             "いろはにほへと散りぬるを" * 9, "ab" * 40_000_000]
    rows = spark.createDataFrame([(i, t, "s", "x", "y") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, source string, __evidence string, __prior string")
    got = language_id.identify(rows, model, text=F.col("text"), host=F.col("source"), into="__evidence_p").collect()
    assert [(r["__evidence_p"]["lang"], r["__evidence_p"]["accepted"]) for r in got[:3]] == [("und", False)] * 3
    assert len(got) == 4 and all((r["__evidence"], r["__prior"]) == ("x", "y") for r in got)
    fair = language_id.identify(docs, model, text=F.col("text"), host=F.col("source"), into="r")
    assert fair.filter("length(text) > 100 and not r.accepted").count() == 0


def test_trigrams_of_runs_equal_those_of_rows(monkeypatch):
    import pyarrow as pa
    rng = random.Random(4)
    texts = ["".join(rng.choice("aé b") for _ in range(rng.randrange(40))) for _ in range(50)] + ["", "a", "ab", "abc"]
    arr = pa.array(texts, pa.string())
    whole = [(int(r), int(b)) for rows, buckets in language_id._trigrams(arr) for r, b in zip(rows, buckets)]
    monkeypatch.setattr(language_id, "RUN", 5)
    assert [(int(r), int(b)) for rows, bs in language_id._trigrams(arr) for r, b in zip(rows, bs)] == whole
    count = [sum(r == i for r, _ in whole) for i in range(len(texts))]
    assert count == [max(len(t.encode()) - 2, 0) for t in texts]


def test_declared_languages(spark):
    rows = [(1, '<html class=x lang="FR-ca">'), (2, "<html><meta http-equiv=content-language content='de'>"), (3, "<p lang=en>")]
    got = {r[0]: r[1] for r in frame(spark, rows).select(
        "doc_id", language_id.declared_language(F.col("text"))).collect()}
    assert got == {1: "fr", 2: "de", 3: None}


def test_pages_follow_their_markup(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = language_id.identify_pages(pages, spark.read.parquet(f"{SF}/documents.parquet"), into="r")
    assert got.filter("r.declared is not null and r.lang != r.declared").count() <= 0.05 * pages.count()
