"""The pipeline's stages against brute force on the small table, and with unusual rows."""
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from plantlake.llm.secret_scan import Scanner, _masked

from .test_corpus_operators import brute_classes, brute_mix
from .test_text_operators import SF, naive_contamination


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(P.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontaminate", "secret_scan", "mixing"]

    after = stages["language_id"](spark, docs, SF).cache()
    assert after.columns == docs.columns
    kept = {r["doc_id"]: r for r in after.collect()}
    assert all(len(r["text"].encode()) < 3 for i, r in rows.items() if i not in kept)
    assert sum(kept[i]["lang"] == rows[i]["lang"] for i in kept) >= 0.98 * len(kept)

    texts = [(i, r["text"]) for i, r in kept.items()]
    classes = brute_classes(texts)
    after = stages["near_dedup"](spark, after, SF).cache()
    assert after.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in after.collect()}
    assert set(left) == {c for _, c, _ in classes} and len(left) < len(kept)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {i for i, t in left.items() if not naive_contamination(t, items)[3]}
    after = stages["decontaminate"](spark, after, SF).cache()
    assert after.columns == docs.columns
    assert {r["doc_id"] for r in after.collect()} == clean and len(clean) < len(left)

    scan = Scanner()
    after = stages["secret_scan"](spark, after, SF).cache()
    assert after.columns == docs.columns
    masked = {r["doc_id"]: r for r in after.collect()}
    for i in clean:
        data = left[i].encode()
        assert masked[i]["text"] == _masked(data, scan.spans(data), b"[SECRET]").decode()
        assert masked[i]["n_chars"] == len(masked[i]["text"])
    assert any("[SECRET]" in r["text"] for r in masked.values())

    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in masked.items()}
    sizes = Counter()
    for i, r in masked.items():
        sizes[r["source"]] += size[i]
    target, taken = brute_mix(sizes), Counter()
    mixed = stages["mixing"](spark, after, SF).collect()
    for r in mixed:
        taken[r["source"]] += size[r["doc_id"]]
    biggest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= biggest for s in sizes)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2


def test_run_writes_and_rereads_every_stage(spark):
    out = P.run(spark, SF)
    assert out.columns[-1] == "copy_no" and out.count() > 0


def test_stages_take_unusual_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("node", F.lit("n")).withColumn("host", F.lit(1)) \
        .withColumn("key", F.lit(2))
    odd = docs.limit(6).withColumn("doc_id", F.lit(None).cast("bigint")).unionAll(docs.limit(3)) \
        .unionAll(docs.limit(2).withColumn("text", F.lit(None).cast("string"))) \
        .unionAll(docs.limit(2).withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string"))) \
        .unionAll(docs.limit(2).withColumn("text", F.lit("")))
    for name, stage in P.STAGES:
        out = stage(spark, odd, SF)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        assert out.count() >= 1, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
