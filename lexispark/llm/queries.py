"""The thin queries over the operators: digest columns only, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm.bpe import round_trip
from lexispark.llm.centroid_clustering import ball_kmeans
from lexispark.llm.collocations import collocations
from lexispark.llm.decontamination import find_passages
from lexispark.llm.jaccard_join import join_documents
from lexispark.llm.language_id import identify
from lexispark.llm.line_dedup import dedup_lines
from lexispark.llm.quality_classifier import classify as classify_quality
from lexispark.llm.quality_rules import apply_rules
from lexispark.llm.shared import fold, table
from lexispark.llm.substring_dedup import dedup_substrings
from lexispark.llm.token_counts import count_tokens
from lexispark.llm.topk_search import build_shards, top_by_product
from lexispark.llm.toxicity import classify as classify_toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(documents(spark, sf_dir))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*columns, "n_lines", "n_stop_words", "n_loud_words")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.drop("lang"), docs.where(fold(3) != 1))
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "distance", "rejected")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_substrings(documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    size = lambda c: F.size(c).cast("long")
    return found.select("doc_id", "n_words", "n_hit", size("item_ids").alias("n_items"), digest.alias("items_sha256"), "contaminated", size("near_ids").alias("n_near"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(documents(spark, sf_dir), k=4, percent=85)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold(5) > 0).select("doc_id", F.col("quality").alias("label"))
    scored = classify_quality(documents(spark, sf_dir), labels)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold(5) > 0).select("doc_id", F.col("toxic").alias("label"))
    scored = classify_toxicity(documents(spark, sf_dir), labels)
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ball_kmeans(embeddings(spark, sf_dir), k=8, rounds=10, width=64, scale=1024, salt="3:")
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embeddings(spark, sf_dir)
    return top_by_product(build_shards(vectors, 256), vectors.where("vec_id % 50 = 0"), k=5, scale=256)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"), longest=3, least=10, top=2000, percent=50)


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_language_id, op3_substring_dedup, op4_bpe, op5_decontamination, op6_jaccard_join, op7_quality_classifier, op8_token_counts, op9_line_dedup, op10_toxicity, op11_centroid_clustering, op12_topk_search, op13_collocations)}
