"""Cases in which an operator once gave less than the whole result."""
import math
import random
import re
import zlib
from collections import Counter

import pytest

from plantlake.llm import lm_score, near_dup
from plantlake.llm import queries as Q
from plantlake.llm.license_scan import TEMPLATES, scan_licenses

from .test_corpus_operators import bag, similarity
from .test_text_operators import SF, frame


def test_pairs_of_a_template_family_are_found(spark):
    """500 texts on one passage (similarity 0.77): each is a near copy (0.80) of one other."""
    passage = [f"p{i}" for i in range(324)]
    texts = [" ".join([*passage, *(f"both{k}x{i}" for i in range(8)), *(f"own{k}x{side}x{i}" for i in range(40))])
             for k in range(250) for side in "ab"]
    bags = [bag(t) for t in texts[:4]]
    assert similarity(bags[0], bags[1]) >= 0.8 and similarity(bags[0], bags[2]) < 0.78
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: i // 2 * 2 for i in range(500)}


def brute_order_3(rows):
    one, two, three, texts = Counter(), Counter(), Counter(), 0
    split = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()), None]
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ws, texts = ["<s>", *split(t)], texts + 1
            one.update(ws[1:])
            two.update(zip(ws, ws[1:]))
            three.update(zip(ws, ws[1:], ws[2:]))
    n, v = sum(one.values()), len(one)
    out = {}
    for i, t in rows:
        ws, total = ["<s>", *split(t)], 0.0
        for k in range(1, len(ws)):
            p = (one[ws[k]] + 1) / (n + v + 1)
            p = (two[ws[k - 1], ws[k]] + 4 * p) / ((texts if k == 1 else one[ws[k - 1]]) + 4)
            if k > 1:
                p = (three[ws[k - 2], ws[k - 1], ws[k]] + 4 * p) / (two[ws[k - 2], ws[k - 1]] + 4)
            total += math.log10(p)
        out[i] = total, len(ws) - 1
    return out


@pytest.mark.parametrize("segment_bytes", [16 << 20, 2000])
def test_scores_of_order_3_equal_brute_force(spark, segment_bytes):
    rng = random.Random(3)
    vocab = ["The", "of", "b", "c,", "d", "x" * 300]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randrange(40)))) for i in range(120)]
    rows += [(200, ""), (201, "the of b " * 5000), *((i, f"only {i} of the rest") for i in range(300, 330))]
    got = lm_score.score(frame(spark, rows), segment_bytes=segment_bytes, order=3).collect()
    want = brute_order_3(rows)
    assert len(got) == len(want)
    for r in got:
        total, n = want[r["doc_id"]]
        assert r["score"] == pytest.approx(total, abs=1e-6 + n * lm_score._STEP)


def test_the_query_scores_with_order_3(spark):
    want = brute_order_3([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    for r in Q.op10_lm_score(spark, SF).collect():
        total, n = want[r["doc_id"]]
        assert r["score"] == pytest.approx(total, abs=1e-6 + n * lm_score._STEP)


def test_each_of_many_notices_is_reported(spark):
    """Notices that follow each other, with little or no text between: one span each, as it was written."""
    rng, rows, want = random.Random(1), [], {}
    for i, (name, notice) in enumerate(TEMPLATES.items()):
        text, want[i] = "", []
        for _ in range(6):
            text += "and " * rng.randrange(4)
            want[i].append((name, len(text), len(text.rstrip() + " " * (len(text) - len(text.rstrip())) + notice.rstrip("."))))
            text += notice + " "
        rows.append((i, text))
    got = scan_licenses(frame(spark, rows), into="m").collect()
    for r in got:
        mine = [(m["license"], m["start"], m["end"]) for m in r["m"] if m["license"] == want[r["doc_id"]][0][0]]
        assert mine == want[r["doc_id"]], r["text"][:60]


def test_a_notice_with_many_insertions_stays_one_match(spark):
    ws = TEMPLATES["MIT"].split()
    text = " ".join(w + " new words put in" * (i % 25 == 24) for i, w in enumerate(ws))
    m = [m for m in scan_licenses(frame(spark, [(1, text)]), into="m").first()["m"] if m["license"] == "MIT"]
    assert [(x["start"], x["end"], x["coverage"]) for x in m] == [(0, len(text.rstrip(".")), 1.0)]
