"""Looking into documents: listing, fetching, keyword snippets, keyword windows, follow-up turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X


def listing(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "source", "lang", F.length(F.coalesce("text", F.lit(""))).alias("size"))


def fetch(documents: DataFrame, doc_id: int) -> DataFrame:
    return documents.where(F.col("doc_id") == doc_id)


def snippets(documents: DataFrame, keyword: str, reach: int = 100) -> DataFrame:
    """(doc_id, pos, snippet): the first hit of a keyword in each document, with ``reach`` characters on both sides."""
    at = F.instr(F.lower("text"), keyword.lower())
    rows = documents.select("doc_id", "text", at.alias("pos")).where("pos > 0")
    begin = F.greatest(F.col("pos") - reach, F.lit(1))
    cut = F.substring(F.col("text"), begin, F.col("pos") + len(keyword) + reach - begin)
    return rows.select("doc_id", "pos", F.regexp_replace(cut, r"[\n\r]", " ").alias("snippet"))


def keyword_region(documents: DataFrame, query: str, window: int = 800, step: int = 200, region: int = 4000) -> DataFrame:
    """(doc_id, best_start, score, region_start): the window with most of the query's distinct long words, the first of equals.

    The region of ``region`` characters around it is what a generator would be shown.
    """
    wanted = F.array_distinct(F.filter(F.split(X.normalised(F.lit(query)), " "), lambda w: F.length(w) >= 4))
    size = F.length(F.coalesce("text", F.lit("")))
    starts = F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)), F.lit(step))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), wanted.alias("words"), starts.alias("starts")).where(F.size("words") > 0)
    hits = lambda low: F.transform("starts", lambda s: F.struct(F.size(F.filter("words", lambda w: F.contains(F.substring(low, s + 1, F.lit(window)), w))).alias("hits"), (-s).alias("at")))
    best = rows.withColumn("best", F.array_max(X.once(F.lower("text"), hits)))
    start = -F.col("best.at")
    return best.select("doc_id", start.alias("best_start"), F.round(F.col("best.hits") / F.size("words"), 6).alias("score"), F.greatest(start + window // 2 - region // 2, F.lit(0)).alias("region_start"))


def follow_ups(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, q1, a1, q2, a2): two user turns in a row with the answers between and after."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    nth = lambda c, n: F.lead(c, n).over(order)
    rows = conversations.select("conv_id", "turn", "role", F.col("text").alias("q1"), *(nth("role", n).alias(f"r{n}") for n in (1, 2, 3)), nth("text", 1).alias("a1"), nth("text", 2).alias("q2"), nth("text", 3).alias("a2"))
    return rows.where("role = 'user' and r1 = 'assistant' and r2 = 'user' and r3 = 'assistant'").select("conv_id", "turn", "q1", "a1", "q2", "a2")


def code_blocks(answers: DataFrame) -> DataFrame:
    """(row_id, blocks, final): fenced ``repl`` blocks and the final answer of texts (row_id, raw); nothing is run."""
    blocks = X.found(F.col("raw"), r"(?s)```repl\s*\n(.*?)\n```", 1)
    final = F.nullif(F.regexp_extract("raw", r"(?ms)^\s*FINAL(?:_VAR)?\((.*)\)", 1), F.lit(""))
    return answers.select("row_id", blocks.alias("blocks"), final.alias("final"))
