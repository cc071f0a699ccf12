"""Toxicity: the kernel against enumeration, the collapsed weights against the kernel, held-out accuracy, edge cases."""
import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from plantlake.llm import toxicity as X

INSULTS = ("grimbel", "snorfid", "wexlut")


def naive_kernel(a, b):
    """Every common subsequence of GRAM symbols of two short tokens, by enumeration."""

    def weights(token):
        s, _ = X.symbols([token])
        out = {}
        for at in itertools.combinations(range(len(s)), X.GRAM):
            span = at[-1] - at[0] + 1
            if span <= X.SPAN:
                u = tuple(s[list(at)].tolist())
                out[u] = out.get(u, 0) + X.DECAY ** (span - X.GRAM)
        most = sum(X.DECAY ** (2 * (at[-1] - at[0] + 1 - X.GRAM)) for at in itertools.combinations(range(len(s)), X.GRAM)
                   if at[-1] - at[0] < X.SPAN)
        return out, max(most, 1.0) ** 0.5

    (x, nx), (y, ny) = weights(a), weights(b)
    return sum(w * y.get(u, 0) for u, w in x.items()) / (nx * ny)


def test_kernel_equals_enumeration():
    rng = random.Random(2)
    tokens = ["a", "", "ab", "idiot", "i.d.i.o.t", "1D10T", "idxiot", "aaaaaaaa", "éçñ", "日本語日本"] + \
        ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))) for _ in range(25)]
    tokens = [t.lower() for t in tokens]
    got = X.kernel(tokens, tokens)
    want = np.array([[naive_kernel(a, b) for b in tokens] for a in tokens])
    assert np.allclose(got, want, atol=1e-5)
    assert np.linalg.eigvalsh(want).min() > -1e-9  # a kernel
    k = lambda a, b: X.kernel([a], [b])[0, 0]
    assert k("idiot", "idxiot") > 0.3 > k("idiot", "window") and k("1d10t", "idiot") == k("idiot", "idiot")


def test_decisions_equal_the_kernel_sum():
    toxic, clean = list(INSULTS), ["window", "grim", "bell", "walnut", "flora", "fid"]
    m = X.train(toxic, clean, np.ones(3), np.ones(6))
    assert (m.decide(toxic) > 0).all() and (m.decide(clean) < 0).all()
    # the collapsed table gives the same as solving for the landmarks' weights
    tokens = ["grimbels", "gribel", "xgrimbel", "snor", "wexwex", "q"]
    marks = toxic + clean
    beta = np.linalg.lstsq(X.kernel(marks, marks), m.decide(marks) - m.bias, rcond=None)[0]
    assert np.allclose(m.decide(tokens), X.kernel(tokens, marks) @ beta + m.bias, atol=1e-3)


def corpus(n=900, seed=4):
    """Texts of random syllables; a third have one insult, some of them gapped, spaced or with inserted characters."""
    rng = random.Random(seed)
    syllables = ["ta", "ren", "ol", "mi", "sto", "ka", "ing", "be", "lu", "fa", "dor", "ne"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(1, 4)))
    docs, labels, disguised = [], [], set()
    for i in range(n):
        ws = [word() for _ in range(rng.randrange(5, 60))]
        toxic = i % 3 == 0
        if toxic:
            w = rng.choice(INSULTS) + rng.choice(["", "", "ka", "ol", "ing"])
            k = rng.randrange(8)
            if zlib.crc32(str(i).encode()) % X.FOLDS == X.HELD_OUT and k < 4:
                at = len(w) // 2
                w = [".".join(w), " ".join(w), w[:at] + "x" + w[at:], w.replace("i", "1").replace("e", "3").upper()][k]
                disguised.add(i)
            ws.insert(rng.randrange(len(ws) + 1), w)
        docs.append((i, " ".join(ws) + "."))
        labels.append((i, int(toxic)))
    return docs, labels, disguised


def test_held_out_accuracy_with_disguises(spark):
    docs, labels, disguised = corpus()
    d = spark.createDataFrame([(*r, "kept") for r in docs], "doc_id bigint, text string, worst string")
    lab = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in X.judge(d, lab).collect()}
    truth = dict(labels)
    for i, _ in docs:
        r = got[i]["toxicity"]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i]["worst"] == "kept"
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    test = [i for i, _ in docs if got[i]["toxicity"]["held_out"]]
    clean_right = [got[i]["toxicity"]["predicted"] == 0 for i in test if not truth[i]]
    toxic_right = [got[i]["toxicity"]["predicted"] == 1 for i in test if truth[i]]
    hidden = [got[i]["toxicity"]["predicted"] == 1 for i in disguised]
    assert np.mean(clean_right) >= 0.97 and np.mean(toxic_right) >= 0.9
    assert len(hidden) >= 10 and np.mean(hidden) >= 0.8


def test_labels_of_the_held_out_fold_are_never_read(spark):
    docs, labels, _ = corpus(300)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    scores = [sorted((r["doc_id"], r["t"]["score"]) for r in
                     X.judge(d, spark.createDataFrame(x, "doc_id bigint, toxic int"), into="t").collect())
              for x in (labels, wrong)]
    assert scores[0] == scores[1]


def test_unusual_rows_and_tables(spark):
    docs, labels, _ = corpus(300)
    long = "ta " * 400_000 + INSULTS[0] + " " + "z" * 300_000
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, long), (None, "ta ren"), (1004, "x" * 50), (1004, "x" * 50)]
    d = spark.createDataFrame(docs + odd, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels + [(1000, 1), (1001, None), (None, 1), (0, 0), (0, 1)], "doc_id bigint, toxic int")
    got = X.judge(d, lab, into="t").filter("doc_id >= 1000 or doc_id is null").collect()
    by = {r["doc_id"]: r["t"] for r in got}
    assert len(got) == 7 and by[1003]["worst"] == INSULTS[0] and by[1003]["n_toxic"] >= 1
    assert by[1000]["score"] == by[1001]["score"] == by[1002]["score"] < 0.5 and by[1000]["worst"] is None
    assert by[None]["held_out"] and by[None]["predicted"] == 0
    assert X.judge(d.limit(0), lab).count() == 0
    base = X.judge(d, lab.limit(0)).select("toxicity.*").distinct().collect()
    assert {(r["score"], r["predicted"]) for r in base} == {(0.0, 0)}
    only = X.judge(d, lab.filter("toxic = 1")).select(F.col("toxicity.score").alias("s")).distinct().collect()
    assert [r["s"] for r in only] == [1.0]


def test_copies_of_one_toxic_text_are_not_telling(spark):
    docs, labels, _ = corpus()
    copied = "frobnicate quuxling zyzzyva here " + INSULTS[0]
    d = spark.createDataFrame(docs + [(2000 + i, copied) for i in range(40)], "doc_id bigint, text string")
    lab = spark.createDataFrame(labels + [(2000 + i, 1) for i in range(40)], "doc_id bigint, toxic int")
    m = X.fit(d, lab).machine
    assert (m.decide(["frobnicate", "quuxling", "zyzzyva"]) < 0).all() and m.decide([INSULTS[0]])[0] > 0


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    from plantlake.llm import queries as Q
    got = Q.op12_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    r = got.join(labels, "doc_id").filter("held_out").groupBy("toxic") \
        .agg(F.avg("predicted").alias("p")).collect()
    rate = {x["toxic"]: x["p"] for x in r}
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert rate[0] <= 0.05 and rate[1] >= 0.5  # some of the table's toxic labels have no common word behind them
