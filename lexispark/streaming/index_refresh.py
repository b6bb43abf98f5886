"""Keeping term statistics fresh while documents arrive as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexispark.functions import text as X
from lexispark.operators.ranking import build_index
from lexispark.operators.sections import corpus_view

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(SCHEMA).parquet(folder)


def refresh_index(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch's postings and the doc_ids it brought go to {out}/postings/batch=N and {out}/versions/batch=N, written once a batch also when it is repeated.

    A document that comes again replaces what was known of it; one whose text is null or too
    short for the index is taken out. Of several rows of a doc_id in a batch the one of the
    greatest text counts, as a batch has no order.
    """

    def add(batch: DataFrame, n: int) -> None:
        newest = batch.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.struct("text", "lang", "source", "n_chars")).alias("x")).select("doc_id", "x.*")
        # The postings come first: a version without them would hide the ones before.
        build_index(corpus_view(newest)).postings.write.mode("overwrite").parquet(f"{out}/postings/batch={n}")
        newest.select("doc_id").write.mode("overwrite").parquet(f"{out}/versions/batch={n}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_postings(spark: SparkSession, out: str) -> DataFrame:
    """The postings (source, doc_id, dl, term, tf) of each document's last version; those of earlier ones are retracted by the join."""
    last = spark.read.schema("doc_id long, batch long").parquet(f"{out}/versions").groupBy("doc_id").agg(F.max("batch").alias("batch"))
    kinds = "source string, doc_id long, dl int, term string, tf long, batch long"
    return spark.read.schema(kinds).parquet(f"{out}/postings").join(last, ["doc_id", "batch"]).drop("batch")


def term_frequencies(spark: SparkSession, out: str) -> DataFrame:
    """(term, df) over the documents as they are now."""
    return current_postings(spark, out).groupBy("term").agg(F.count("*").alias("df"))


def fact_counts(stream: DataFrame) -> DataFrame:
    """(source, n, numbers): a running count of documents and numbers by source."""
    text = F.coalesce("text", F.lit(""))
    return stream.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.size(X.numbers(text, X.dates(text)))).alias("numbers"))
