"""The registered queries of this subpackage: thin digests over the operators' own outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ","), 256)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_documents
    docs = table(spark, sf_dir, "documents")
    return identify_documents(docs.select("doc_id", "text", "source"), docs, into="r").select(
        "doc_id", "r.lang", "r.probability", "r.text_lang", "r.declared", "r.host_prior",
        F.col("r.accepted").alias("kept"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on raw pages, where markup and addresses are evidence too."""
    from .language_id import identify_pages
    pages = table(spark, sf_dir, "pages")
    return identify_pages(pages, table(spark, sf_dir, "documents"), into="r").select(
        "page_id", "r.lang", "r.probability", "r.text_lang", "r.declared", "r.suffix_lang", "r.host_prior",
        "r.accepted")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = F.col("r")
    ids = F.array_sort(F.transform(r["items"], lambda i: i.cast("string")))
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), into="r").select(
        "doc_id", r["n_words"].alias("n_words"), r["n_hit"].alias("n_hit"),
        F.size(r["items"]).cast("bigint").alias("n_items"), _sha256(ids).alias("items_sha256"),
        r["contaminated"].alias("contaminated"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge
    return judge(table(spark, sf_dir, "documents")).drop("clean_text")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import BASE_RULES, scan_secrets
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [r.kind for r in BASE_RULES]
    as_text = lambda spans: F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    found = scan_secrets(docs, into="spans").select("doc_id", "spans")
    of_kind = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *(F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k in base),
        _sha256(as_text(of_kind(*base))).alias("base_sha256"),
        F.array_join(as_text(F.col("spans")), ",").alias("spans"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, into="v").select("page_id", "v.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import taken
    return taken(table(spark, sf_dir, "documents"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import classes
    return classes(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), into="m")
    names = F.array_join(F.array_sort(F.array_distinct(F.col("m.license"))), ",")
    spans = F.transform("m", lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"),
                                                   s["end"].cast("string")))
    return found.select("doc_id", F.size("m").cast("bigint").alias("n_matches"), names.alias("licenses"),
                        F.coalesce(F.array_max(F.col("m.coverage")), F.lit(0.0)).alias("best_coverage"),
                        F.array_join(spans, ",").alias("spans"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score
    return score(table(spark, sf_dir, "documents"), order=3)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fill_middle import restore, transform
    cut = transform(table(spark, sf_dir, "documents").select("doc_id", "text"), into="r")
    return cut.select("doc_id", "r.n", "r.form", "r.prefix_chars", "r.middle_chars",
                      F.sha2("r.output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("r.output"), F.col("r.form")), 256).alias("restored_sha256"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import judge
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "labels"), into="r").select("doc_id", "r.held_out", "r.score", "r.predicted")


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_align import align
    aligned = align(table(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumn("groups_sha256", F.coalesce("groups", F.lit(""))).drop("groups")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id,
        op2_decontaminate,
        op3_quality_rules,
        op4_secret_scan,
        op5_url_filter,
        op6_mixing,
        op7_near_dup,
        op8_warc,
        op9_license_scan,
        op10_lm_score,
        op11_fill_middle,
        op12_toxicity,
        op13_token_align,
        language_id_pages,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
