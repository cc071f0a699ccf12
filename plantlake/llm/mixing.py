"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repeats.

Sources are sorted by code point (null last) and take the weights in turn.
They share ``share`` times the size of all documents; a source whose part is
above ``max_epochs`` times its own size is clamped there, and what it leaves
is shared again by weight among the others, until none is above.

A document is repeated ``floor(target / source size)`` times; the rest of the
target goes to one more copy of the first documents in the order of a seeded
digest of (id, text), up to the document whose middle passes the rest, so a
source misses its target by half a document at most.  The place of that cut
is found in two steps: sums by (source, first four hex digits of the digest),
then a running sum inside the one digest bucket that holds the cut, a 65,536th
part of the source.  No window runs over a whole source.

Only DataFrame functions are used.  The driver sees three sums per round.

Edge cases: a null text has size 0; null is a source of its own; equal rows
(same id and text) are taken alike; a source of size 0 has target 0; empty
input gives an empty plan.  Input columns other than the three named are not
read by ``plan`` and pass through ``repeat`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality_rules import n_words
from .shared import cut, fresh

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 20


def source_key(source: Column) -> Column:
    """A key that sorts by code point with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def order_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Seeded digest (hex) by which documents are picked."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("-")),
                             F.md5(F.coalesce(text, F.lit("")))))


def measured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             seed: int = SEED) -> DataFrame:
    """(doc_id, sk, size, key) of every row, computed once."""
    return cut(docs.select(
        F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("sk"),
        n_words(F.coalesce(F.col(text_col), F.lit(""))).alias("size"),
        order_key(F.col(id_col), F.col(text_col), seed).alias("key")))


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` (from 0) by sk: ranges of keys, each numbered on its own and then shifted."""
    parts = cut(sources.repartitionByRange("sk").withColumn("part", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("sk")) - 1
    return parts.withColumn("inside", inside).join(shift, "part") \
        .select("sk", "source_size", (F.col("inside") + F.col("before")).alias("rank"))


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(sk, source_size, target) by capped water-filling."""
    sources = sizes.groupBy("sk").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = cut(_ranked(sources).select("sk", "source_size", weight.cast("double").alias("w"),
                                         (F.col("source_size") * max_epochs).cast("double").alias("cap")))
    rest, total, clamped = _sums(filled, F.lit(False))
    budget = share * (filled.agg(F.sum("source_size")).first()[0] or 0)
    rest = budget
    while total:
        above = F.col("cap") <= F.col("w") * rest / total
        taken, left, now = _sums(filled, above)
        if now == clamped:
            break
        rest, total, clamped = budget - taken, left, now
    part = F.least("cap", F.col("w") * F.lit(rest) / F.lit(total)) if total else F.col("cap")
    return filled.select("sk", "source_size", part.alias("target"))


def _sums(filled: DataFrame, above: Column) -> tuple[float, float, int]:
    """(caps of the clamped, weights of the others, number of clamped sources)."""
    row = filled.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("w"))),
                     F.count(F.when(above, 1))).first()
    return row[0] or 0.0, row[1] or 0.0, row[2]


def plan(sizes: DataFrame, **options) -> DataFrame:
    """(sk, source_size, target, whole, cutoff) per source: every document is taken ``whole`` times,
    and those with a word and key <= cutoff once more.  Takes ``measured()`` rows."""
    sources = targets(sizes, **options)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = cut(sources.withColumn("whole", whole.cast("bigint"))
                  .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    by_bucket = sizes.groupBy("sk", F.substring("key", 1, 4).alias("bucket")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("sk").orderBy("bucket"))
    at = by_bucket.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n")) \
        .join(sources.select("sk", "rest"), "sk") \
        .filter((F.col("before") <= F.col("rest")) & (F.col("upto") > F.col("rest"))) \
        .select("sk", "bucket", "before", "rest")
    # One row per key inside the bucket of the cut (rows with equal keys are taken alike).
    inside = sizes.withColumn("bucket", F.substring("key", 1, 4)).join(at, ["sk", "bucket"]) \
        .groupBy("sk", "bucket", "before", "rest", "key").agg(F.sum("size").alias("n"))
    run = F.sum("n").over(Window.partitionBy("sk", "bucket").orderBy("key"))
    fits = F.col("before") + run - F.col("n") / 2 <= F.col("rest")
    cuts = inside.select("sk", "bucket", F.when(fits, F.col("key")).alias("last")) \
        .groupBy("sk").agg(F.coalesce(F.max("last"), F.max("bucket")).alias("cutoff"))
    cutoff = F.when(F.col("rest") > 0, F.coalesce("cutoff", F.lit("g"))).otherwise("")
    return cut(sources.join(cuts, "sk", "left").select(
        "sk", "source_size", "target", "whole", cutoff.alias("cutoff")))


def copies(size: Column, key: Column) -> Column:
    """How often a document is taken, from its source's plan row."""
    return F.col("whole") + F.when((size > 0) & (key <= F.col("cutoff")), 1).otherwise(0)


def taken(docs: DataFrame, **columns) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    sizes = measured(docs, **columns)
    return sizes.join(plan(sizes), "sk").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * copies(F.col("size"), F.col("key"))).alias("taken"))


def repeat(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           seed: int = SEED, copy_col: str = "copy_no", **options) -> DataFrame:
    """``docs`` as mixed: a row per copy taken, numbered from 1 in ``copy_col`` (with underscores in front where
    ``docs`` has a column of that name)."""
    copy_col = fresh(docs, copy_col)
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col, "seed": seed}
    chosen = plan(measured(docs, **names), **options)
    sk = fresh(docs, "__sk")
    p = F.col(fresh(docs, "__plan"))
    chosen = chosen.select(F.col("sk").alias(sk), F.struct("whole", "cutoff").alias(fresh(docs, "__plan")))
    size = n_words(F.coalesce(F.col(text_col), F.lit("")))
    extra = (size > 0) & (order_key(F.col(id_col), F.col(text_col), seed) <= p["cutoff"])
    n = (p["whole"] + F.when(extra, 1).otherwise(0)).cast("int")
    rows = docs.withColumn(sk, source_key(F.col(source_col))).join(chosen, sk)
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns],
                       F.explode(F.when(n > 0, F.sequence(F.lit(1), n))).alias(copy_col))
