"""Queries of the training-data operators over the whole given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolake.llm import decontaminate, jaccard_join, packing, periodic_runs, pii, quality_pu, quality_rules, secrets, simhash, spelling, suffix_dedup, url_filter, warc
from hydrolake.llm.common import table

#: The rules that the URL query judges by.
URL_RULES = (
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents")).drop("failed_rules")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.session_key(spark), columns=["doc_id", "text"])


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("n_keys")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *packing.public_files())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), prepare=periodic_runs.plant_repeats))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), prepare=spelling.plant_typos)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    from hydrolake.llm.oracle import ORACLE

    return dict(ORACLE)
