"""Change read: the row-level difference of two versions of a table (SRC-09).

Both versions are reduced to (key, row digest) pairs, which one aggregate
nets: a digest that stands equally often on both sides is no change, so
repeated rows are handled as a multiset.  The changed digests are written to
the shared folder, so that they are found once, and go back for their rows
by a merge join, for which a full row is shuffled once.  No join may broadcast
rows of a version, nor digests, whatever their files' size.  A key with
rows that went and rows that came is an update; where a key is null, or a
row's twin is on no other side, it is a delete or an insert.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

KINDS = ("insert", "delete", "update_before", "update_after")


def _digest(columns: list[str]) -> Column:
    """SHA-256 of the columns' values; nulls, empty strings and types stay apart in the JSON text."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)


def table_changes(old: DataFrame, new: DataFrame, key: list[str], change_col: str = "_change_type") -> DataFrame:
    """The rows that lead from ``old`` to ``new`` (same columns), with their kind in ``change_col``.

    Applying them (:func:`apply_changes`) to ``old`` gives ``new`` as a multiset, whatever is repeated or null."""
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the versions have different columns")
    columns = old.columns
    has_key = F.lit(True)
    for k in key:
        has_key = has_key & F.col(f"`{k}`").isNotNull()

    def side(df: DataFrame, sign: int) -> DataFrame:
        d = _digest(columns)
        # A row without a key is alone with its digest.  Never null, so that no filter on it tells the reads of `net` apart.
        k = F.coalesce(F.when(has_key, _digest(key)), d, F.lit(""))
        return df.select(d.alias("d"), k.alias("k"), F.lit(sign).alias("n"))

    net = side(old, -1).unionByName(side(new, 1)).groupBy("d", "k").agg(F.sum("n").alias("n")).filter("n != 0")
    keys = net.groupBy("k").agg((F.bool_or(F.col("n") < 0) & F.bool_or(F.col("n") > 0)).alias("both")).filter("both")
    kinds = net.join(keys.hint("merge"), "k", "left").select(
        F.unhex("d").alias("d"), F.abs("n").cast("int").alias("n"), (F.col("n") > 0).alias("came"),
        F.when(F.col("n") > 0, F.when(F.col("both"), "update_after").otherwise("insert"))
        .otherwise(F.when(F.col("both"), "update_before").otherwise("delete")).alias("kind"))
    folder = shared_dir(old.sparkSession, "changes", uuid.uuid4().hex)
    kinds.write.parquet(folder)
    kinds = old.sparkSession.read.schema(kinds.schema).parquet(folder)

    def rows(df: DataFrame, came: bool) -> DataFrame:
        """One copy of each changed row of a side, as often as it came or went."""
        changed = kinds.filter(F.col("came") == came)
        packed = df.select(F.unhex(_digest(columns)).alias("d"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
        found = packed.join(changed.select("d").hint("merge"), "d", "left_semi")
        marks = changed.select("d", "n", "kind")
        one = found.unionByName(marks, allowMissingColumns=True).groupBy("d").agg(
            F.any_value("row", F.lit(True)).alias("row"), F.max("n").alias("n"), F.max("kind").alias("kind"))
        return one.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n")))).select(
            "row.*", F.col("kind").alias(change_col))

    return rows(old, False).unionByName(rows(new, True))


def apply_changes(old: DataFrame, changes: DataFrame, change_col: str = "_change_type") -> DataFrame:
    """``old`` after ``changes`` (of :func:`table_changes`), as a multiset of rows."""
    columns = old.columns
    gone = F.col(change_col).isin("delete", "update_before")
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    signed = old.select(_digest(columns).alias("d"), row, F.lit(1).alias("n")).unionByName(
        changes.select(_digest(columns).alias("d"), row, F.when(gone, -1).otherwise(1).alias("n")))
    left = signed.groupBy("d").agg(F.any_value("row").alias("row"), F.sum("n").cast("int").alias("n")).filter("n > 0")
    return left.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")
