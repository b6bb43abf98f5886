"""Further queries: segments, planted facts, excerpts, sources of questions and counts; each over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V
from lexispark.operators import browse, excerpts, generation, grounding, selection, summary, validation
from lexispark.operators import sections as D
from lexispark.plans import queries as Q
from lexispark.sources.corpus import documents, sample_documents

#: Sentences put before the texts, as the given tables hold hardly a date, amount, telephone number, term or list.
PLANTED = (
    "Signed 12-05-2024 and 12 mei 2024, also December 2025 and May 12, 2024.",
    "Fee is € 1.250,50 or $99 or 40 euro; 12,5% of 2024 staff, 137 seats.",
    "Call 020-1234567 or mail a.b@ex.org, see https://ex.org/x for more.",
    "Grace period means thirty days. The Joint Review Board (JRB) meets on the 16e after vier weken.",
    "- first point\n- second point\n1) third | a | b\nx | y | z",
)


def digest(text: Column | str) -> Column:
    return F.md5(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"))


def _planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*(F.lit(p) for p in PLANTED)), (F.pmod("doc_id", F.lit(len(PLANTED))) + 1).cast("int"))
    return D.corpus_view(documents(spark, sf_dir).withColumn("text", F.concat(said, F.lit("\n"), F.coalesce("text", F.lit("")))))


def planted_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.facts(_planted(spark, sf_dir))
    return rows.select("doc_id", *(digest(F.array_join(c, "|")).alias(c) for c in D.LISTS), F.col("entity_count").cast("long").alias("entity_count"), "has_factual_content")


def planted_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.tags(_planted(spark, sf_dir)).select("doc_id", "has_list", "has_dates", "has_numbers", "has_contact", "has_definition", "has_table")


def planted_lists_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = selection.top_lists(D.tags(_planted(spark, sf_dir)), 25)
    return best.select(F.col("rank").cast("long").alias("rank"), "source", "doc_id", F.col("n_words").cast("long").alias("n_words"), F.length("passage").cast("long").alias("passage_len"))


def key_noun_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nouns = F.array_sort(X.key_nouns(F.col("text")))
    return Q._sections(spark, sf_dir).select("doc_id", F.size(nouns).cast("long").alias("n_nouns"), digest(F.array_join(nouns, "|")).alias("nouns"))


def _marked_lines(spark: SparkSession, sf_dir: str, mark) -> DataFrame:
    return documents(spark, sf_dir).where("text is not null").select("doc_id", F.array_join(F.transform(F.split("text", "\n"), mark), "\n").alias("text"))


def markdown_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every second document become headings of two levels, some with the marks on a line of their own."""
    even = F.pmod("doc_id", F.lit(2)) == 0
    mark = lambda x, i: F.when(even & (i % 8 == 4), F.concat(F.lit("# \n"), x)).when(even & (i % 4 == 0), F.concat(F.lit("# "), x)).when(even & (i % 4 == 2), F.concat(F.lit("## "), x)).otherwise(x)
    made = D.markdown_sections(_marked_lines(spark, sf_dir, mark))
    return made.select("doc_id", F.col("sec_ord").cast("long").alias("sec_ord"), "heading", F.col("level").cast("long").alias("level"), digest("content").alias("content"), F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"))


def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four lines a page; of each three documents one has numbered chapters and parts, one has titles, one has neither."""
    kind = F.pmod("doc_id", F.lit(3))
    page = lambda i: (F.floor(i / 4) + 1).cast("string")
    mark = lambda x, i: (
        F.when((kind == 0) & (i % 4 == 0), F.concat(page(i), F.lit(". Chapter "), F.left(x, F.lit(20)))).when((kind == 0) & (i % 4 == 2), F.concat(page(i), F.lit(".1 Part "), F.left(x, F.lit(20))))
        .when((kind == 1) & (i % 8 == 0), F.lit("Heading of this Page")).otherwise(x)
    )
    lines = _marked_lines(spark, sf_dir, mark).select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    pages = lines.groupBy("doc_id", (F.floor(F.col("i") / 4) + 1).cast("int").alias("page_no")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda s: s["line"]), "\n").alias("text"))
    return D.paged_sections(pages)


def paged_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = ("sec_ord", "parent_sec_ord", "level", "char_start", "char_end", "page_start", "page_end")
    return _paged(spark, sf_dir).select("doc_id", *(F.col(c).cast("long").alias(c) for c in whole), "heading", digest("content").alias("content"))


def section_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.all_text(_paged(spark, sf_dir)).select("doc_id", F.col("sec_ord").cast("long").alias("sec_ord"), digest("all_text").alias("all_text"))


def text_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = excerpts.text_slice(documents(spark, sf_dir).withColumn("text", F.coalesce("text", F.lit(""))), F.lit(10), F.lit(60))
    return cut.select("doc_id", F.col("slice"))


def truncate_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q._sections(spark, sf_dir).select("doc_id", digest(X.truncated(F.col("text"), V.LIST_PASSAGE, ".")).alias("digest"))


def names_and_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.lit("Some\\Folder/"), F.upper("source"), F.lit(".TXT"))
    return Q._sections(spark, sf_dir).select("doc_id", X.basename(path).alias("name"), X.title_of(F.concat("source", F.lit("_of_all"))).alias("title"), X.shortened(F.col("text"), 120).alias("short"))


def named_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that list each benchmark item as a passage of a known and of an unknown document."""
    item = F.struct(F.col("text").alias("passage"), F.array(F.lit("none.txt"), F.concat(F.lit("Dir/SRC"), F.pmod("item_id", F.lit(20)).cast("string"))).alias("source_documents"))
    answers = Q._benchmark(spark, sf_dir).select(F.col("item_id").alias("row_id"), F.concat(F.when(F.col("item_id") % 2 == 0, "Found: ").otherwise(""), F.to_json(F.array(item))).alias("raw"))
    found = excerpts.named_passages(answers, documents(spark, sf_dir).select("source").distinct())
    return found.select("row_id", F.array_join("sources", ",").alias("sources"), digest("passage").alias("passage"), "chapter")


def question_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = Q._benchmark(spark, sf_dir).select(F.col("item_id").alias("id"), F.array(F.concat(F.lit("A\\SRC"), F.pmod("item_id", F.lit(20)).cast("string")), F.lit("x/src3")).alias("source_documents"))
    known = documents(spark, sf_dir).groupBy(F.col("source").alias("filename")).agg(F.min("doc_id").alias("doc_id"))
    return excerpts.question_sources(asked, known).select("id", "doc_id", F.col("pos").cast("long").alias("pos"))


def source_match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = Q._benchmark(spark, sf_dir).select(F.col("item_id").alias("context_id"), F.col("text").alias("context"), F.array(F.concat(F.lit("src"), F.pmod("item_id", F.lit(20)).cast("string")), F.lit("src3")).alias("sources"))
    return validation.source_ratios(asked, Q._sections(spark, sf_dir)).withColumnRenamed("context_id", "item_id")


def context_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.when(F.col("turn") % 2 == 0, F.concat(F.lit("conv"), "conv_id")).alias("filename"), "text", F.col("role").alias("type"))
    return excerpts.context_rows(rows).groupBy("filename", "type").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("n_chars"))


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.run_totals(documents(spark, sf_dir), Q._sections(spark, sf_dir))


def clean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.clean_metrics(documents(spark, sf_dir).select((F.col("doc_id") % 7 == 0).alias("hallucination_detected")))


def first_seen_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.first_seen(Q._accepted(spark, sf_dir))


def type_count_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.type_counts(Q._accepted(spark, sf_dir))


def least_used_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("source", "doc_id")
    return summary.least_used(rows, rows.where("doc_id % 11 = 0")).withColumn("n_used", F.col("n_used").cast("long"))


def timing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = summary.timing_stats(spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("value").alias("seconds")))
    return made.select("n", *(F.round(c, 4).alias(f"{c}_seconds") for c in ("total", "avg", "min", "max")))


def answer_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as a model may write them around code and a final answer."""
    item = X.strip(F.regexp_replace("text", r"[\n()`]", " "))
    raw = F.concat(F.lit("Look:\n```repl\nprint("), F.col("item_id").cast("string"), F.lit(")\n```\nand\n```repl\nx = 1\n```\nFINAL("), item, F.lit(")"))
    found = browse.code_blocks(Q._benchmark(spark, sf_dir).select(F.col("item_id").alias("row_id"), raw.alias("raw")))
    return found.select("row_id", F.array_join("blocks", ";").alias("blocks"), F.col("final").alias("final_answer"))


def fetch_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.fetch(documents(spark, sf_dir), 5).select("doc_id", "source", digest("text").alias("digest"))


def offline_generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Q._template(spark, sf_dir).select("doc_id", "key", "passage")
    made = [generation.generator(g)(rows).select("doc_id", F.lit(g).alias("generator"), "question", "answer") for g in ("paraphrase", "joined", "needle", "unknowable")]
    return made[0].unionByName(made[1]).unionByName(made[2]).unionByName(made[3])


def sample_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus's texts with the sample documents put to them."""
    texts = documents(spark, sf_dir).where("text is not null").select(F.concat(F.lit("doc_"), "doc_id").alias("title"), F.col("text").alias("content"), F.col("lang").alias("type"))
    return sample_documents(spark).unionByName(texts).select("title", digest("content").alias("content"), "type")


def anchored_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts of each whole text, copied with other words between, found again in it."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    part = lambda share: F.substring(F.col("text"), F.floor(F.length("text") * share).cast("int") + 1, F.lit(300))
    copied = docs.select(F.col("doc_id").alias("item_id"), "doc_id", F.concat(part(0.25), F.lit(" ### other words ### "), part(0.5)).alias("excerpt"))
    found = grounding.anchored_excerpts(copied, docs)
    return found.select("doc_id", "start", "end", F.length("found").cast("long").alias("n_chars"), digest("found").alias("digest"))


def _sourced_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each benchmark item with two sources, and the documents of all sources."""
    named = F.explode(F.array_distinct(F.array(F.concat(F.lit("src"), F.pmod("item_id", F.lit(20)).cast("string")), F.lit("src3"))))
    return Q._benchmark(spark, sf_dir).select("item_id", "text", named.alias("source")), documents(spark, sf_dir).select("source", "doc_id", "text")


def excerpt_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item in all documents of two sources."""
    return grounding.excerpt_regions(*_sourced_items(spark, sf_dir), by="source")


def grounded_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grounding.grounded_excerpts(*_sourced_items(spark, sf_dir), by="source")
    return found.where("found is not null").select("item_id", "doc_id", "score", "start", "end", digest("found").alias("digest"))


MORE_QUERIES = {
    f.__name__: f
    for f in (
        planted_facts, planted_tags, planted_lists_topk, key_noun_phrases, markdown_parse, paged_parse, section_all_text, text_slices, truncate_sentence, names_and_titles, named_passages,
        question_sources, source_match_ratio, context_rows, run_totals, clean_metrics, first_seen_sources, type_count_metrics, least_used_source, timing_stats, answer_code, fetch_document,
        offline_generators, sample_corpus, anchored_excerpts, excerpt_regions, grounded_excerpts,
    )
}
