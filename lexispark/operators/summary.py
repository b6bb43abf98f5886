"""Summaries of a set of questions, and the filters of a viewer over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distribution(questions: DataFrame, column: str) -> DataFrame:
    """(value, n, share) of a column, most frequent first, ties in order of first appearance (ord)."""
    counted = questions.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6)).orderBy(F.desc("n"), "first").drop("first")


def source_distribution(questions: DataFrame) -> DataFrame:
    return distribution(questions.select("ord", F.explode("source_documents").alias("source")), "source")


def summary(questions: DataFrame, requested: int, llm_calls: int) -> DataFrame:
    """One row of metrics over questions (question, answer, context, source_documents, match_ratio, answer_grounded)."""
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(F.round(a / F.greatest(b, F.lit(1)), 6))
    n = F.count("*")
    size = lambda f, c: F.coalesce(f(F.length(c)), F.lit(0)).cast("double")
    return questions.agg(
        n.alias("n_questions"), (n - F.count_distinct("question")).alias("n_duplicates"), ratio(n, F.lit(requested)).alias("yield_ratio"), ratio(n, F.lit(llm_calls)).alias("efficiency"),
        F.round(size(F.avg, "context"), 6).alias("avg_context"), size(F.min, "context").alias("min_context"), size(F.max, "context").alias("max_context"),
        F.round(size(F.avg, "answer"), 6).alias("avg_answer"), size(F.min, "answer").alias("min_answer"), size(F.max, "answer").alias("max_answer"),
        F.round(F.coalesce(F.avg("match_ratio"), F.lit(0.0)), 6).alias("avg_match"), F.coalesce(F.min("match_ratio"), F.lit(0.0)).alias("min_match"),
        ratio(F.count_if("answer_grounded"), n).alias("grounded_ratio"), F.count_if(F.size("source_documents") > 1).alias("n_multi_source"),
    )


def long_format(one_row: DataFrame) -> DataFrame:
    """(metric, value) rows of a one-row summary."""
    return one_row.select(*(F.col(c).cast("double").alias(c) for c in one_row.columns)).unpivot([], one_row.columns, "metric", "value")


def timing_stats(calls: DataFrame) -> DataFrame:
    """(n, total, avg, min, max) of calls (seconds)."""
    return calls.agg(F.count("*").alias("n"), F.sum("seconds").alias("total"), F.avg("seconds").alias("avg"), F.min("seconds").alias("min"), F.max("seconds").alias("max"))


def least_used(documents: DataFrame, used: DataFrame) -> DataFrame:
    """The document (source) that fewest selected sections come from, the first of equals."""
    counted = used.groupBy("source").agg(F.count("*").alias("n_used"))
    return documents.select("source").distinct().join(counted, "source", "left").fillna(0, ["n_used"]).orderBy("n_used", "source").limit(1)


def viewer_filter(questions: DataFrame, qtype: str = "", difficulty: str = "", search: str = "") -> DataFrame:
    """Questions of a type and difficulty whose text holds a string, letters' case ignored; empty means any."""
    rows = questions
    if qtype:
        rows = rows.where(F.col("type") == qtype)
    if difficulty:
        rows = rows.where(F.col("difficulty") == difficulty)
    if search:
        rows = rows.where(F.contains(F.lower(F.concat_ws(" ", "question", "answer", "context", F.col("id").cast("string"))), F.lit(search.lower())))
    return rows


def run_totals(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """(n_documents, n_sections, n_words): one row over documents (doc_id) and sections (n_words)."""
    counted = sections.agg(F.count("*").alias("n_sections"), F.coalesce(F.sum("n_words"), F.lit(0)).cast("long").alias("n_words"))
    return documents.agg(F.count_distinct("doc_id").alias("n_documents")).crossJoin(counted)  # one row each


def clean_metrics(questions: DataFrame) -> DataFrame:
    """(n_questions, n_hallucinated, clean_ratio) of questions (hallucination_detected); the ratio is 0 without questions."""
    n, bad = F.count("*"), F.count_if(F.coalesce("hallucination_detected", F.lit(False)))
    ratio = F.when(n == 0, 0.0).otherwise(F.round((n - bad) / F.greatest(n, F.lit(1)), 6))
    return questions.agg(n.alias("n_questions"), bad.alias("n_hallucinated"), ratio.alias("clean_ratio"))


def first_seen(questions: DataFrame) -> DataFrame:
    """(source, first, n): the source documents in the order (ord) in which questions first name them."""
    return questions.select("ord", F.explode("source_documents").alias("source")).groupBy("source").agg(F.min("ord").alias("first"), F.count("*").alias("n"))


def type_counts(questions: DataFrame) -> DataFrame:
    """(metric, value): a run's count of questions by type, as metric rows."""
    return questions.groupBy("type").agg(F.count("*").cast("double").alias("value")).select(F.concat(F.lit("count_"), "type").alias("metric"), "value")
