"""Quality rules, line first: judge every line, remove the failing ones, then judge the document.

A line (split at \\n) without words is neither kept nor lost.  A line fails if
- punctuation: it has fewer than ``SHORT`` words and no closing mark at its
  end, or more than one symbol of ``#*$%&|<>`` for every two words;
- navigation: it has two or more separators, and no closing mark at its end
  or a separator for every three words (separators between blanks are words);
- boilerplate: it has one of the fixed phrases.
What is left is ``clean_text``.  A document is rejected by its base counts
(fewer than 50 words, or more than half of its words in repeated 3-word
windows) or if it loses more than ``MAX_LOST`` percent of its words.

Everything is a Spark SQL expression over the row's own text: no shuffle, no
Python.  3-word windows are compared within one text only, sorted by their
64-bit hash; nothing is exploded, so a document stays one row.

Edge cases: a null text has no words and fails (``clean_text`` is empty);
repeated rows are each judged; input columns are kept only where asked for by
``keep``, so extra columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
SHORT = 5
MAX_LOST = 50
#: Fixed values of the line rules.
CLOSED = r"""[.!?…。！？][\"')\]”’»]*[\x20\x09-\x0D]*\z"""
SEPARATOR = r"[|»›·•>]"
PHRASES = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
           "enable javascript", "click here", "subscribe to our newsletter", "sign up for", "log in to",
           "powered by", "skip to content", "share on")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _has_phrase(text: Column) -> Column:
    low = F.lower(text)
    return reduce(lambda a, p: a | low.contains(p), PHRASES, F.lit(False))


def _is_sentence(line: Column) -> Column:
    """Closed, or long enough and without separators; no closing mark makes up for a chain of separators."""
    words, separators = F.regexp_count(line, F.lit(WORD)), F.regexp_count(line, F.lit(SEPARATOR))
    return F.when(separators < 2, line.rlike(CLOSED) | (words >= SHORT)).otherwise(
        (3 * separators < words) & line.rlike(CLOSED))


def line_passes(line: Column) -> Column:
    """Verdict on one line that has a word."""
    few = 2 * F.regexp_count(line, F.lit(SYMBOL)) <= F.regexp_count(line, F.lit(WORD))
    return _is_sentence(line) & few & ~_has_phrase(line)


def judge(docs: DataFrame, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_clean_words,
    clean_text, base_failed, kept."""
    kept = [F.col(c) for c in keep]
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(*kept, text.alias("__text"))
    base = base.select(
        *keep, "__text",
        F.filter(F.split("__text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
        F.array_remove(F.split("__text", BLANK), "").alias("__words"))
    # Windows and neighbours are zipped arrays: a lambda sees its own element only, never a whole column.
    n = F.size("__words")
    rest = lambda k: F.slice("__words", k, F.greatest(n, F.lit(1)))
    gram = F.transform(F.slice(F.arrays_zip(F.col("__words").alias("a"), rest(2).alias("b"), rest(3).alias("c")), 1,
                               F.greatest(n - 2, F.lit(0))), lambda w: F.xxhash64(w["a"], w["b"], w["c"]))
    base = base.select(
        *keep, "__lines", n.cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        _has_phrase(F.col("__text")).alias("__phrase"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        gram.alias("__grams"))
    # A text without symbols and phrases needs the first rule only.
    plain = (F.col("n_symbols") == 0) & ~F.col("__phrase")
    chosen = lambda keeps: F.when(plain, F.filter("__lines", lambda x: _is_sentence(x) == keeps)).otherwise(
        F.filter("__lines", lambda x: line_passes(x) == keeps))
    lost = F.aggregate(chosen(False), F.lit(0).cast("bigint"), lambda a, x: a + n_words(x))
    base = base.withColumn("clean_text", F.array_join(chosen(True), "\n")) \
        .withColumn("n_clean_words", F.col("n_words") - lost).drop("__lines", "__phrase")
    # Only texts with a repeated window are sorted; equal windows then stand side by side.
    repeated = F.size(F.array_distinct("__grams")) < F.size("__grams")
    base = base.withColumn("__sorted", F.when(repeated, F.sort_array(
        F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("__grams")
    neighbours = F.arrays_zip(F.col("__sorted").alias("x"), F.slice("__sorted", 2, F.size("__sorted")).alias("y"))
    twice = F.filter(neighbours, lambda p: p["x"]["g"] == p["y"]["g"])
    covered = F.flatten(F.transform(twice, lambda p: F.array(
        *[p[side]["i"] + k for side in ("x", "y") for k in (0, 1, 2)])))
    base = base.withColumn("n_repeat_words", F.when(F.col("__sorted").isNull(), F.lit(0).cast("bigint"))
                           .otherwise(F.size(F.array_distinct(covered)).cast("bigint"))).drop("__sorted")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = 100 * (F.col("n_words") - F.col("n_clean_words")) > MAX_LOST * F.col("n_words")
    return base.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~lost)
