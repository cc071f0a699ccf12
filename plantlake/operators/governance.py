"""Masks, row filters and governance jobs (GOV-01..11).

Open-source Spark has no ``SET MASK`` / ``SET ROW FILTER`` and no group test,
so a policy is applied by :func:`secure_view`: the row filter first, then the
masked projection, before the caller sees the frame.  This protects the
frames this package hands out, not files opened directly.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..config import (
    CLASSIFIED,
    PERSON_TOKEN,
    REFERENCE_POLICY,
    REFERENCE_REDACT_NAMES,
    RETENTION_DAYS,
    LeakPatterns,
    Policy,
)
from ..functions import mask_email, mask_name, mask_phone, names_pattern, plant_predicate, pseudonym, sql_str
from .metrics import as_of_ts


def _mask(kind: str, column: str, policy: Policy):
    if kind == "email":
        return mask_email(column, strict=policy.strict_formats)
    if kind == "phone":
        return mask_phone(column, strict=policy.strict_formats)
    if kind == "notes":
        pats = LeakPatterns()
        c = F.regexp_replace(F.col(column), pats.email, "[EMAIL]")
        c = F.regexp_replace(c, pats.phone_number, "[PHONE]")
        return F.regexp_replace(c, names_pattern(REFERENCE_REDACT_NAMES), PERSON_TOKEN)
    return mask_name(column)


def secure_view(df: DataFrame, table: str, groups: Iterable[str] = (),
                policy: Policy = REFERENCE_POLICY) -> DataFrame:
    """GOV-04/05/06: row filter then masks for a reader in ``groups``.

    Members of ``policy.privileged_group`` see every row in clear text.  A
    long group list is matched with ``isin`` (a hash set in codegen).
    """
    groups = set(groups)
    privileged = policy.privileged_group in groups
    out = df
    if table in policy.row_filtered and "plant_id" in df.columns:
        out = out.filter(plant_predicate("plant_id", groups, privileged))
    if privileged:
        return out
    masks = policy.masks_for(table)
    return out.select(*[
        _mask(masks[c], c, policy).alias(c) if c in masks else F.col(c) for c in out.columns
    ])


# -- GOV-07: classification registry ----------------------------------------

REGISTRY_SCHEMA = StructType([
    StructField("table_name", StringType()),
    StructField("column_name", StringType()),
    StructField("pii", StringType()),           # direct | quasi | sensitive_text | none
    StructField("sensitivity", StringType()),   # low | medium | high
    StructField("domain", StringType()),
    StructField("retention_days", IntegerType()),
])

def classification(spark: SparkSession) -> DataFrame:
    """GOV-07: the registry as a small DataFrame (fixed size, 16 rows)."""
    return spark.createDataFrame(list(CLASSIFIED), REGISTRY_SCHEMA)


# -- GOV-08: leak audit -------------------------------------------------------

def schema_leaks(spark: SparkSession, outputs: dict[str, DataFrame]) -> DataFrame:
    """Columns of serving/metrics/gold outputs that are direct identifiers.

    ``outputs`` maps a view name to its DataFrame; the catalogue listing of
    column names is tiny (no data is read).
    """
    rows = [(name, c) for name, df in outputs.items() for c in df.columns]
    cols = spark.createDataFrame(rows, "table_name string, column_name string")
    direct = classification(spark).filter(F.col("pii") == "direct").select("column_name").distinct()
    return cols.join(F.broadcast(direct), "column_name", "left_semi").select("table_name", "column_name")


def content_leaks(df: DataFrame, table: str, text_columns: Iterable[str] | None = None,
                  names: Iterable[str] = (), patterns: LeakPatterns = LeakPatterns()) -> DataFrame:
    """Count rows per text column that hold an email, a phone or a known name.

    One aggregate pass over the table (``count_if`` per column and pattern),
    so cost is one scan however many columns are audited.
    """
    cols = list(text_columns) if text_columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    names = [n for n in names if n]
    name_pat = names_pattern(names) if names else None
    aggs = []
    for c in cols:
        q = f"`{c}`"
        # Cheap necessary conditions guard each regex (same result, far less work):
        # an email needs an '@'; an ASCII case-insensitive name match implies the
        # lower-cased text contains the lower-cased name.  Built as SQL text, so
        # each aggregate is one expression for the driver to send.
        aggs.append(F.expr(f"count_if(contains({q}, '@') AND {q} RLIKE {sql_str(patterns.email)})")
                    .alias(f"{c}__email"))
        aggs.append(F.expr(f"count_if({q} RLIKE {sql_str(patterns.phone)})").alias(f"{c}__phone"))
        if name_pat:
            maybe = " OR ".join(f"contains(lower({q}), {sql_str(n.lower())})" for n in names)
            aggs.append(F.expr(f"count_if(({maybe}) AND {q} RLIKE {sql_str(name_pat)})").alias(f"{c}__name"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"{c}__name"))
    wide = df.agg(*aggs)
    # one row per column: a single projection of SQL text (one parse for the driver)
    rows = ", ".join(
        f"named_struct('column_name', {sql_str(c)}, 'email_rows', `{c}__email`, 'phone_rows', `{c}__phone`, "
        f"'name_rows', `{c}__name`)" for c in cols)
    return wide.selectExpr(f"{sql_str(table)} AS table_name", f"inline(array({rows}))")


def leak_audit(tables: dict[str, DataFrame], names: Iterable[str] = (),
               patterns: LeakPatterns = LeakPatterns()) -> DataFrame:
    """GOV-08 content check over several tables, one row per text column."""
    out = None
    for name, df in tables.items():
        part = content_leaks(df, name, None, names, patterns)
        out = part if out is None else out.union(part)  # same columns in the same order
    return out


# -- GOV-09: retention --------------------------------------------------------

#: People table -> (record key, anchor of the fact, whether a fact without an anchor is still open and kept).
RETENTION_RULES = {
    "work_order_people": ("work_order_id", "closed_at", True),
    "alarm_ack_people": ("alarm_id", "coalesce(cleared_at, raised_at)", False),
    "shift_people": ("shift_id", "shift_end", False),
}


def retention_verdicts(people: DataFrame, fact: DataFrame, table: str, as_of=None,
                       days: dict[str, int] = RETENTION_DAYS) -> DataFrame:
    """``people`` with ``verdict``: ``keep``, ``purge`` or ``orphan`` (no fact has its key; a NULL key has none).

    Facts are first aggregated to one row per key, so repeated keys neither
    multiply people rows nor split their verdict: the latest anchor counts,
    and an order with an open fact is open.
    """
    key, anchor, open_kept = RETENTION_RULES[table]
    per_key = fact.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(F.expr(anchor)).alias("_anchor"), F.max(F.expr(f"{anchor} IS NULL")).alias("_open"))
    lo = as_of_ts(as_of) - F.expr(f"INTERVAL {int(days[table])} DAYS")
    recent = F.coalesce(F.col("_anchor") >= lo, F.lit(False))
    keep = (recent | F.col("_open")) if open_kept else recent
    verdict = F.when(F.col("_key").isNull(), "orphan").when(keep, "keep").otherwise("purge")
    return people.join(per_key, people[key] == F.col("_key"), "left") \
        .select(*[people[c] for c in people.columns], verdict.alias("verdict"))


def retention_report(people: dict[str, DataFrame], facts: dict[str, DataFrame], as_of=None,
                     days: dict[str, int] = RETENTION_DAYS) -> DataFrame:
    """GOV-09: kept, purged and orphan row counts per people table; they add up to its rows."""
    out = None
    for table, (key, _, _) in RETENTION_RULES.items():
        if table not in people:
            continue
        judged = retention_verdicts(people[table].select(key), facts[table], table, as_of, days)
        part = judged.agg(*[F.count_if(F.col("verdict") == v).alias(c) for v, c in (
            ("keep", "kept_rows"), ("purge", "purged_rows"), ("orphan", "orphan_rows"))]).select(
            F.lit(table).alias("table_name"), F.lit(int(days[table])).alias("retention_days"),
            "kept_rows", "purged_rows", "orphan_rows")
        out = part if out is None else out.union(part)  # same columns in the same order
    return out


def purge(people: DataFrame, fact: DataFrame, table: str, as_of=None,
          days: dict[str, int] = RETENTION_DAYS) -> DataFrame:
    """Rows of a people table that survive retention; purged rows and orphans go."""
    return retention_verdicts(people, fact, table, as_of, days).filter("verdict = 'keep'").drop("verdict")


# -- GOV-10 / GOV-11 ----------------------------------------------------------

def pseudonymise(df: DataFrame, columns: Iterable[str], salt: str) -> DataFrame:
    """GOV-10: replace employee ids by salted SHA-256 (NULL stays NULL)."""
    cols = set(columns)
    return df.select(*[pseudonym(c, salt).alias(c) if c in cols else F.col(c) for c in df.columns])


def identity_lookup(facts: DataFrame, people: DataFrame, key: str, table: str,
                    groups: Iterable[str], policy: Policy = REFERENCE_POLICY) -> DataFrame:
    """GOV-11: join facts to people on the record key, through :func:`secure_view`.

    A privileged caller sees clear text; anyone else gets masked values and
    only the plants they may see (the inner join drops filtered rows).
    """
    safe = secure_view(people, table, groups, policy)
    if "plant_id" in facts.columns:
        safe = safe.drop("plant_id")
    return facts.join(safe, key, "inner")
