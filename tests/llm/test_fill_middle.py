"""Fill-in-the-middle: skip list against plain sums, whole results against a regex version, exact round trips."""
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantlake.llm import queries as Q
from plantlake.llm.fill_middle import SkipList, restore, transform, unit_widths

SF = "/root/testdata/sf0.001"
UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def plainly(doc_id, text, seed=42, fim=50, spm=80):
    """(n, form, prefix code points, middle code points, output) by cutting the list of units."""
    text = text or ""
    units = UNIT.findall(text)
    d = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    p, m = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:p], units[p:m], units[m:]))
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=400), st.integers(0, 9))
def test_skip_list_reaches_every_rank(widths, seed):
    units, sums = SkipList(np.array(widths, np.int64), seed), np.concatenate(([0], np.cumsum(widths)))
    assert [units.seek(r) for r in range(len(widths) + 1)] == [int(x) for x in sums]


def test_skip_list_descends_by_express_lanes():
    units = SkipList(np.ones(200_000, np.int64))
    assert len(units.lanes) >= 6
    sizes = [len(lane.units) for lane in units.lanes]
    assert all(0.15 < b / a < 0.35 for a, b in zip(sizes, sizes[1:]) if a > 1000)
    for lane in units.lanes:  # each lane's widths span the whole text
        assert lane.units.sum() == 200_000 and lane.chars.sum() == 200_000
    assert units.seek(123_457) == 123_457


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\x0b \x1caé日𝄞", max_size=30), max_size=6))
def test_units_equal_the_pattern(texts):
    offsets, widths = unit_widths(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert widths[offsets[i]:offsets[i + 1]].tolist() == [len(u) for u in UNIT.findall(text)]


def test_units_of_long_texts_are_scanned_in_runs(monkeypatch):
    from plantlake.llm import fill_middle
    monkeypatch.setattr(fill_middle, "RUN_BYTES", 7)
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \nab日") for _ in range(rng.randrange(80))) for _ in range(60)]
    offsets, widths = unit_widths(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert widths[offsets[i]:offsets[i + 1]].tolist() == [len(u) for u in UNIT.findall(text)]


def test_transform_equals_brute_force_and_restores(spark):
    long = "日本 語\n" * 300_000 + " "
    rows = [(1, long), (2, None), (3, ""), (4, " \n "), (5, "a <P> b c d e"), (6, "one"), (6, "one"), (None, "x y z")]
    rows += [(100 + i, " ".join(f"w{j}é" for j in range(i))) for i in range(200)]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id bigint, text string, fim_text string")
    got = transform(docs).withColumn("back", restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert sorted((r["doc_id"] or 0, *r["fim"]) for r in got if r["doc_id"] != 1) == \
        sorted((i or 0, *plainly(i, t)) for i, t in rows if i != 1)
    assert all(r["back"] == (r["text"] or "") and r["fim_text"] == "kept" for r in got)
    assert {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}
    assert transform(docs.limit(0)).count() == 0
    everything = {r["doc_id"]: tuple(r["fim"]) for r in
                  transform(docs, seed=7, fim_percent=100, spm_percent=0).filter("doc_id is not null").collect()}
    assert everything[1] == plainly(1, long, seed=7, fim=100, spm=0) and everything[1][1] == "psm"


def test_query_equals_brute_force(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n, form, p, m, output = plainly(r["doc_id"], r["text"])
        expected.add((r["doc_id"], n, form, p, m, sha(output), sha(r["text"] or "")))
    assert {tuple(r) for r in Q.op11_fill_middle(spark, SF).collect()} == expected
