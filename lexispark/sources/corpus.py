"""Reading corpora: folders of text and JSON files, test sets, and literal fixtures."""

from __future__ import annotations

import importlib.util
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.operators.numbering import numbered
from lexispark.sources.work import kept

SUFFIXES = ("txt", "md", "json", "pdf")

TEST_SET = (
    "metadata struct<created_at: double, corpus: string, config: map<string, string>>, summary map<string, string>, "
    "questions array<struct<id: string, type: string, question: string, golden_answer: string, golden_context: string, difficulty: string, source_documents: array<string>>>"
)

SAMPLES = (
    ("Overview", "The library keeps its catalogue in three rooms. Readers may borrow four books for 21 days.", "overview"),
    ("Scanner", "The scanner reads 40 pages a minute. Its lamp lasts 2,000 hours.", "technical"),
    ("Meeting of 12-05-2024", "The board met on 12-05-2024 and agreed to open on Sundays from September 2024.", "meeting"),
    ("Budget", "The budget for 2025 is € 48.500, of which 12,5% goes to repairs.", "financial"),
    ("Staff", "Questions go to desk@library.example. The head of the desk is on leave for vier weken.", "organizational"),
)


def _files(spark: SparkSession, folder: str, recursive: bool, suffixes: tuple[str, ...]) -> DataFrame:
    """(doc_id, doc_ord, path, filename, content, doc_type, modified, year_in_name) of a folder's files of some kinds, numbered in the order of their paths."""
    plain = lambda c: F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))  # noqa: E731  Spark gives file names as parts of URLs
    read = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    raw = read.select(plain("_metadata.file_path").alias("path"), plain("_metadata.file_name").alias("filename"), "content", F.date_format("_metadata.file_modification_time", "yyyy-MM-dd").alias("modified"))
    suffix = F.lower(F.substring_index("filename", ".", -1))
    rows = raw.withColumn("doc_type", suffix).where(suffix.isin(*suffixes))
    # Only paths move to be put in order, the contents join on them.
    order = numbered(rows.select("path"), "path", name="doc_ord")
    year = F.nullif(F.regexp_extract("filename", r"(20\d{2})", 1), F.lit(""))
    return rows.join(order, "path").select(F.col("doc_ord").alias("doc_id"), F.col("doc_ord").cast("int").alias("doc_ord"), "path", "filename", "content", "doc_type", "modified", year.alias("year_in_name"))


FILE_COLUMNS = ("doc_id", "doc_ord", "filename", "raw_text", "doc_type", "modified", "year_in_name")


def text_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(doc_id, doc_ord, filename, raw_text, doc_type, modified, year_in_name) of a folder's text, markdown and JSON files.

    Suffixes count in any case; other files are left out. Bytes that are no UTF-8 are dropped;
    a file that is UTF-8 keeps all its characters. PDF files are read by ``folder_documents``.
    """
    return _decoded(_files(spark, folder, recursive, SUFFIXES[:3])).select(*FILE_COLUMNS)


def _decoded(files: DataFrame) -> DataFrame:
    text = F.col("content").cast("string")
    return files.withColumn("raw_text", F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))))


def fitz_pages(data: bytes) -> list[str]:
    """The texts of a PDF's pages by the optional library PyMuPDF."""
    import fitz

    with fitz.open(stream=data, filetype="pdf") as pages:
        return [page.get_text() for page in pages]


def folder_documents(spark: SparkSession, folder: str, parse: Callable[[bytes], list[str]] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The files of a folder as ``text_files`` has them and PDF files, numbered together, and (doc_id, page_no, text) of the pages of these.

    ``parse`` makes the texts of its pages from a PDF's bytes; without it PyMuPDF does where it is
    installed, and PDF files are left out where it is not. A file that cannot be parsed is
    told of on the task's standard error and left out.
    """
    parse = parse or (fitz_pages if importlib.util.find_spec("fitz") else None)
    if parse is None:
        return text_files(spark, folder), None
    files = _files(spark, folder, True, SUFFIXES)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc, path, data in zip(frame["doc_id"], frame["path"], frame["content"], strict=True):
                try:
                    texts = [t.encode("utf-8", "ignore").decode() for t in parse(bytes(data))]
                except Exception as failed:  # one file should not end the job
                    print(f"left out {path}: {failed}", file=sys.stderr)
                    continue
                yield pd.DataFrame({"doc_id": doc, "page_no": range(1, len(texts) + 1), "text": texts})

    pages = kept(files.where("doc_type = 'pdf'").select("doc_id", "path", "content").mapInPandas(run, "doc_id long, page_no int, text string"), "pages")
    whole = pages.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]), "\n").alias("pages"))
    told = _decoded(files).join(whole, "doc_id", "left").where("doc_type <> 'pdf' or pages is not null")
    return told.withColumn("raw_text", F.when(F.col("doc_type") == "pdf", F.col("pages")).otherwise(F.col("raw_text"))).select(*FILE_COLUMNS), pages


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(filename, content, type) of JSON files that hold one document or a list of them."""
    raw = spark.read.schema("title string, filename string, content string, text string, type string").option("multiLine", True).option("recursiveFileLookup", True).json(folder)
    return raw.select(F.coalesce("filename", "title").alias("filename"), F.coalesce("content", "text").alias("content"), "type").where("content is not null")


def sample_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLES), "title string, content string, type string")


def test_set(spark: SparkSession, path: str) -> DataFrame:
    """A saved test set; a file of another form is an error."""
    return spark.read.schema(TEST_SET).option("multiLine", True).option("mode", "FAILFAST").json(path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where a small input has fewer parts than there are cores; larger ones stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def corpus_key(spark: SparkSession, path: str) -> tuple:
    """What tells a stored corpus from another or a later one: its path, and the number and latest change of its files."""
    files = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("at"))
    row = files.agg(F.count_distinct("path").alias("n"), F.max("at").alias("at"), F.count("*").alias("rows")).first()
    return path, row.n, row["at"], row.rows
