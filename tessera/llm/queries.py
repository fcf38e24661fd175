"""The numbered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontam,
    hard_negatives,
    langid,
    line_dedup,
    lm_score,
    ordinal,
    packing,
    quality_rules,
    ranked_search,
    simhash,
    substring,
    token_counts,
    toxicity,
)
from .common import documents, table
from .oracle import ORACLE  # noqa: F401 - read with QUERIES


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(documents(spark, sf_dir))


def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(documents(spark, sf_dir))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good; selected are texts that are likely above 0."""
    ratings = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality * (2 - toxic) as grade")
    return ordinal.grade(documents(spark, sf_dir), ratings)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.judged(decontam.find(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op10_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op11_strassen_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row whose id 7 divides has the next label, of ten."""
    rows = hard_negatives.integer_rows(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


def op12_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digests(documents(spark, sf_dir))


def op13_shared_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_best_fit_packing, op2_lattice_lm, op3_language_crf, op4_simhash_near_dedup, op5_substring_dedup,
    op6_ordinal_quality, op7_benchmark_decontamination, op8_fuzzy_line_dedup, op9_quality_rules, op10_toxicity_grammar,
    op11_strassen_hard_negatives, op12_prefix_token_counts, op13_shared_ranked_search)}
