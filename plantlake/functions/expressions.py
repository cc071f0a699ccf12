"""Column expressions shared by the operators (FN-*, AGG-*, UDF-01/02).

All of them are built-in Spark expressions, so they run inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (
    EMAIL_MASK_PATTERN,
    EMAIL_MASK_REPLACEMENT,
    NAME_MASK,
    PHONE_MASK_PREFIX,
    PLANT_GROUP_PREFIX,
    ROLE_ONCALL,
    ROLE_PLANNER,
    ROLE_TECHNICIAN,
    HealthRule,
)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- typing (FN-01..04) ------------------------------------------------------

def empty_to_null(c: str | Column) -> Column:
    """``NULLIF(x, '')``: only the empty string, blanks stay (FN-04)."""
    return F.nullif(col_(c), F.lit(""))


def as_timestamp(c: str | Column) -> Column:
    """``CAST(NULLIF(x,'') AS TIMESTAMP)`` that yields NULL on bad text (FN-02, T11)."""
    return empty_to_null(c).try_cast("timestamp")


def as_type(c: str | Column, spark_type: str) -> Column:
    """``try_cast`` to int/bigint/double/date after NULLIF (FN-01, FN-03)."""
    return empty_to_null(c).try_cast(spark_type)


# -- tag names (FN-05, T1) ---------------------------------------------------

TAG_SUFFIX_PATTERN = "[|]([^|]+)$"


def tag_suffix(tag_name: str | Column = "tag_name") -> Column:
    """Metric name after the last pipe, NULL when there is none (trap T1)."""
    return F.nullif(F.regexp_extract(col_(tag_name), TAG_SUFFIX_PATTERN, 1), F.lit(""))


# -- time (FN-09, FN-11) -----------------------------------------------------

def epoch_seconds(c: str | Column) -> Column:
    """``unix_timestamp``: whole seconds since the epoch (floor)."""
    return F.unix_timestamp(col_(c))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def hours_between(start: str | Column, end: str | Column) -> Column:
    """``(unix_timestamp(end) - unix_timestamp(start)) / 3600`` as DOUBLE (T7)."""
    return seconds_between(start, end).cast("double") / F.lit(3600.0)


def overlaps(start: str | Column, end: str | Column,
             win_start: Column, win_end: Column) -> Column:
    """Interval ``[start, end]`` (open end = still active) meets ``[win_start, win_end]``."""
    return (col_(start) <= win_end) & (col_(end).isNull() | (col_(end) >= win_start))


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as DOUBLE, NULL when ``den`` is not positive (no div-by-zero)."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


# -- health (GLD-03, FN-10, FN-15, T2, T3) -----------------------------------

def health_score(vib: Column, temp: Column, amps: Column, rule: HealthRule = HealthRule()) -> Column:
    """Clamp(100 - penalties).  ``greatest`` skips NULL, so a silent sensor adds no penalty."""
    penalty = lambda c, nominal, weight: F.greatest(c - F.lit(nominal), F.lit(0.0)) * F.lit(weight)
    raw = (F.lit(rule.ceiling)
           - penalty(vib, rule.vib_nominal, rule.vib_weight)
           - penalty(temp, rule.temp_nominal, rule.temp_weight)
           - penalty(amps, rule.amps_nominal, rule.amps_weight))
    return F.greatest(F.lit(rule.floor), F.least(F.lit(rule.ceiling), raw)).cast("double")


def anomaly_flag(vib: Column, temp: Column, rule: HealthRule = HealthRule()) -> Column:
    """Two-valued flag: NULL comparisons fall to FALSE (trap T3)."""
    return F.when((vib > F.lit(rule.vib_alarm)) | (temp > F.lit(rule.temp_alarm)), F.lit(True)).otherwise(F.lit(False))


# -- serving (SRV-01, SRV-02) ------------------------------------------------

def technician_role(priority: str | Column = "priority") -> Column:
    p = col_(priority)
    return (F.when(p <= 1, F.lit(ROLE_ONCALL))
            .when(p == 2, F.lit(ROLE_TECHNICIAN))
            .otherwise(F.lit(ROLE_PLANNER)))


def is_set(c: str | Column) -> Column:
    return F.when(col_(c).isNotNull(), F.lit(True)).otherwise(F.lit(False))


# -- masks (GOV-01..03, UDF-01) ----------------------------------------------

def mask_email(c: str | Column, strict: bool = False) -> Column:
    """First character + ``***`` + ``@domain`` (greedy, the last ``@`` wins).

    Reference form: a value without ``@`` passes unmasked (T14); ``strict``
    masks it whole instead.
    """
    masked = F.regexp_replace(col_(c), EMAIL_MASK_PATTERN, EMAIL_MASK_REPLACEMENT)
    if not strict:
        return masked
    return F.when(col_(c).isNull(), F.lit(None).cast("string")).when(
        col_(c).rlike(EMAIL_MASK_PATTERN), masked).otherwise(F.lit(NAME_MASK))


def mask_phone(c: str | Column, strict: bool = False) -> Column:
    """``***-***-`` + last four characters; NULL stays NULL."""
    masked = F.concat(F.lit(PHONE_MASK_PREFIX), F.right(col_(c), F.lit(4)))
    if not strict:
        return masked
    return F.when(F.length(col_(c)) > 4, masked).when(col_(c).isNotNull(), F.lit(NAME_MASK))


def mask_name(c: str | Column) -> Column:
    """Always ``REDACTED``, NULL included (T14)."""
    return F.lit(NAME_MASK)


def plant_predicate(plant_id: str | Column, groups: Iterable[str], privileged: bool) -> Column:
    """Row filter (GOV-05): privileged, or member of ``plant_<plant_id>``.

    A NULL plant drops for everyone without the privilege.
    """
    if privileged:
        return F.lit(True)
    names = sorted(set(groups))
    if not names:
        return F.lit(False)
    return F.coalesce(F.concat(F.lit(PLANT_GROUP_PREFIX), col_(plant_id)).isin(names), F.lit(False))


def pseudonym(c: str | Column, salt: str) -> Column:
    """SHA-256 hex of ``salt || id``; NULL stays NULL (GOV-10)."""
    return F.when(col_(c).isNotNull(), F.sha2(F.concat(F.lit(salt), col_(c)), 256))


def round6(c: str | Column) -> Column:
    """Rounding for values that depend on summation order (avg, stddev, slopes).

    The tiny offset moves values off exact ties, where engines round differently.
    """
    return F.round(col_(c) + F.lit(1e-9), 6)


def regex_quote(text: str) -> str:
    """Quote a literal for a Java/RE2 pattern (both accept ``\\`` escapes of punctuation)."""
    out = []
    for ch in text:
        if ch.isalnum() or ch in " _-":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "".join(out)


def names_pattern(names: Iterable[str]) -> str:
    """Case-insensitive alternation, longest first, so ``Ann Lee`` wins over ``Ann``."""
    uniq = sorted({n for n in names if n}, key=lambda s: (-len(s), s))
    return "(?i)(" + "|".join(regex_quote(n) for n in uniq) + ")"


def sql_str(text: str) -> str:
    """A Spark SQL string literal (backslash and quote escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_sql_functions(spark, groups: Iterable[str] = (), privileged_group: str = "pii_readers") -> None:
    """UDF-01/02 for SQL users: temporary SQL functions (no Python runs per row).

    ``mask_email``, ``mask_phone``, ``mask_name`` take one string;
    ``plant_filter(plant_id)`` is true for a privileged caller or a member of
    ``plant_<plant_id>``.  The caller's groups are fixed when registering,
    since open-source Spark has no group-membership function.
    """
    names = sorted(set(groups))
    privileged = privileged_group in names
    member = ("FALSE" if not names else
              "coalesce(concat('plant_', plant_id) IN (" + ", ".join(sql_str(g) for g in names) + "), FALSE)")
    keep = "TRUE" if privileged else member
    clear = lambda body, arg: arg if privileged else body
    defs = {
        "mask_email(email STRING) RETURNS STRING":
            clear(f"regexp_replace(email, {sql_str(EMAIL_MASK_PATTERN)}, {sql_str(EMAIL_MASK_REPLACEMENT)})", "email"),
        "mask_phone(phone STRING) RETURNS STRING": clear(f"concat({sql_str(PHONE_MASK_PREFIX)}, right(phone, 4))", "phone"),
        "mask_name(name STRING) RETURNS STRING": clear(sql_str(NAME_MASK), "name"),
        "plant_filter(plant_id STRING) RETURNS BOOLEAN": keep,
    }
    for sig, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {sig} RETURN {body}")
