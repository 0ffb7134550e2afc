"""One query per operator, each over the whole of its tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    clustering,
    conversation_repair,
    decontamination,
    line_dedup,
    lm_scoring,
    ngram_join,
    quality_rules,
    secrets,
    source_mixing,
    substring_dedup,
    token_counts,
    toxicity,
    vector_search,
)
from .common import load
from .oracle import ORACLE_SQL


# Shares of the token budget, by domain.
DOMAIN_TARGETS = {"good": 0.85, "poor": 0.13, "toxic": 0.02}


def _held_out(id_col: str = "doc_id") -> Column:
    bytes_ = F.col(id_col).cast("string").cast("binary")
    return F.coalesce(F.pmod(F.crc32(bytes_), F.lit(3)) == 1, F.lit(False))


def learning_labels(labels: DataFrame) -> DataFrame:
    """Label rows that models may learn from; the rest is for measuring."""
    return labels.where(~_held_out())


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the rows that models may learn from."""
    named = source_mixing.domain_of(F.col("quality"), F.col("toxic")).alias("domain")
    return learning_labels(labels).select("doc_id", named)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(load(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(load(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = learning_labels(load(spark, sf_dir, "labels")).where("quality = 1")
    return lm_scoring.score_documents(load(spark, sf_dir, "documents"), target)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(
        load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labels = domain_labels(load(spark, sf_dir, "labels"))
    return source_mixing.fit_rates(source_mixing.posteriors(docs, labels, list(DOMAIN_TARGETS)), DOMAIN_TARGETS)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.col("longest").alias("longest_match"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.remove_common_lines(docs)
    return kept.select(
        "doc_id",
        F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"),
        F.size("gone_lines").cast("bigint").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(load(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
        for kind in secrets.BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled_texts(docs, learning_labels(load(spark, sf_dir, "labels"))))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("spans").cast("bigint").alias("n_segments"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(load(spark, sf_dir, "conversations"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(load(spark, sf_dir, "embeddings")).drop("centroid")


def op13_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(load(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # imported here, as the pipeline imports this module
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_token_counts": op4_token_counts,
    "op5_source_mixing": op5_source_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_secret_scans": op8_secret_scans,
    "op9_quality_rules": op9_quality_rules,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_exact_topk_search": op13_exact_topk_search,
    "pipeline": pipeline,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
