"""From raw documents to tokens: five stages, each one operator of ``lexispark.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept;
its result is written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``. Rows are dropped by doc_id; rows that share one share
their fate. An empty table goes through all stages as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm.bpe import round_trip
from lexispark.llm.decontamination import contaminated_ids
from lexispark.llm.jaccard_join import duplicate_ids
from lexispark.llm.language_id import identify
from lexispark.llm.line_dedup import dedup_lines
from lexispark.llm.shared import fold, ready, stored, table, unused


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is none of ids; rows without doc_id stay."""
    name = unused(docs.columns, "gone")
    gone = ids.select(F.col("doc_id").alias(name))
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    ready(spark)
    found = identify(docs.select("doc_id", "text"), docs.select("doc_id", "text", "lang").where(fold(3) != 1))
    return without(docs, found.where("rejected").select("doc_id"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them only; n_chars follows the text.

    A document that loses all its lines stays as an empty row: this stage drops lines, not
    documents, so that every doc_id that labels or other tables name is still there.
    """
    ready(spark)
    return dedup_lines(docs).select(*docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 80 %) stays, the one of the smallest doc_id."""
    ready(spark)
    return without(docs, duplicate_ids(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return without(docs, contaminated_ids(docs, table(spark, sf_dir, "benchmark")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and digests of the ids and of what they decode to."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("language_id", language), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("bpe", tokens)]

#: The first stage is a learned classifier, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
