"""One query for each operator, over whole tables; scalar columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V
from lexispark.operators import browse, generation, pairs, ranking, selection, summary, validation
from lexispark.operators import sections as D
from lexispark.plans.generate import RunConfig, TypeConfig, run, type_table
from lexispark.sources.corpus import documents

FOLLOW_UP_COLUMNS = ("q1", "a1", "q2", "a2")


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.corpus_view(documents(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> ranking.SearchIndex:
    """Stored once a session for all searches of a corpus."""
    return ranking.corpus_index(spark, f"{sf_dir}/documents.parquet", lambda: _sections(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with facts and tags; nouns in the form that every engine reads alike."""
    return D.facts(D.tags(_sections(spark, sf_dir))).withColumn("nouns", X.plain_nouns(F.col("text")))


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def sections_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = D.plain_sections(documents(spark, sf_dir))
    return made.select("doc_id", "sec_ord", "heading", F.col("n_words").cast("long").alias("wc"), F.length("content").cast("long").alias("n_chars"), F.col("char_start").cast("long"), F.col("char_end").cast("long"))


def section_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.tags(_sections(spark, sf_dir)).select("doc_id", "has_list", "has_dates", "has_numbers", "has_contact", "has_definition", "has_table")


def section_entities_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.facts(_sections(spark, sf_dir))
    return rows.select("doc_id", *(F.size(c).cast("long").alias(f"n_{c}") for c in D.LISTS), F.col("entity_count").cast("long"))


def key_nouns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).select("doc_id", F.size(X.plain_nouns(F.col("text"))).cast("long").alias("n_nouns"))


def tokens_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = _index(spark, sf_dir).postings.groupBy("term").agg(F.sum("tf").alias("tf"))
    return terms.orderBy(F.desc("tf"), "term").limit(20)


def term_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).terms


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).stats.select("n_docs", F.round("avg_dl", 6).alias("avg_dl"))


def _item_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct search terms of each whole benchmark item, in their order."""
    return _benchmark(spark, sf_dir).select(F.col("item_id").alias("query_id"), F.array_distinct(X.tokens(F.coalesce("text", F.lit("")))).alias("terms"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.search(_index(spark, sf_dir), _item_queries(spark, sf_dir), 10)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def bm25_repeated_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubled = _item_queries(spark, sf_dir).select("query_id", F.concat("terms", F.slice("terms", 1, 1)).alias("terms"))
    found = ranking.search(_index(spark, sf_dir), doubled, 5)
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def bm25_source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranking.search(_index(spark, sf_dir), _item_queries(spark, sf_dir), None, "src3")
    return found.select("query_id", "doc_id", "score")


def _top(strategy: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        best = selection.top_passages(strategy, _facts(spark, sf_dir))
        return best.select(F.col("rank").cast("long").alias("rank"), "source", "doc_id", "score", F.length("passage").cast("long").alias("passage_len"))

    return query


def _pairs(within: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sections = _sections(spark, sf_dir).withColumn("nouns", X.plain_nouns(F.col("text"))).withColumn("terms", X.defined_terms(F.col("text")))
        best = pairs.top_pairs(sections, 10, within)
        return best.select(F.col("rank").cast("long").alias("rank"), "doc_a", "doc_b", F.col("n_shared").cast("long").alias("n_shared"))

    return query


def within_pairs_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy choice inside sources: rows of a run that asks for within-corpus questions only."""
    made = run(documents(spark, sf_dir), RunConfig({"multi_hop_within_corpus": TypeConfig(True, 4)}))
    return made.select("id", "type", F.length("context").cast("long").alias("context_len"))


def lists_capped_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag stands in for has_list, which no text of these tables sets: ten lines or more."""
    rows = _sections(spark, sf_dir)
    best = selection.top_lists(rows, 25, flag=F.size(F.split("text", "\n")) >= 10)
    return best.select(F.col("rank").cast("long").alias("rank"), "source", "doc_id", F.col("n_words").cast("long").alias("n_words"), F.length("passage").cast("long").alias("passage_len"))


def long_context_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.long_spans(_sections(spark, sf_dir)).selectExpr("source", "cast(start_idx as bigint) as start_idx", "n_included", "cast(total_chars as bigint) as total_chars", "first_doc_id")


def hallucination_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = selection.hallucination_topics(_sections(spark, sf_dir), 8)
    return best.select(F.col("rank").cast("long").alias("rank"), "doc_id", "draw", F.length("passage").cast("long").alias("passage_len"))


def unused_sections_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _facts(spark, sf_dir)
    used = selection.top_passages("generic", rows, 50)
    return selection.eligible(rows, used).select("doc_id")


def boilerplate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return _sections(spark, sf_dir).select("doc_id", X.boilerplate_hits(text).cast("long").alias("hits"), X.is_boilerplate(text, F.col("n_words")).alias("boilerplate"))


def toc_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.contents_lines(F.col("text"))
    rows = _sections(spark, sf_dir).withColumn("lines", lines)
    digits, short = X.share(F.col("lines"), lambda x: x.rlike(r"\d+$")), X.share(F.col("lines"), lambda x: F.length(x) < 80)
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.round(digits, 6).alias("digit_share"), F.round(short, 6).alias("short_share"), X.is_contents_table(F.col("text")).alias("toc"))


def truncate_passage(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = X.truncated(F.col("text"), V.PASSAGE)
    return _sections(spark, sf_dir).select("doc_id", F.length(cut).cast("long").alias("passage_len"), F.md5(cut.cast("binary")).alias("digest"))


def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir).select("doc_id", F.md5(X.normalised(F.col("text")).cast("binary")).alias("digest"))


def context_match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    contexts = _benchmark(spark, sf_dir).select(F.col("item_id").alias("context_id"), F.col("text").alias("context"))
    return validation.context_matches(contexts, documents(spark, sf_dir)).withColumnRenamed("context_id", "item_id")


def _template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from each section that is long enough, by the offline generator."""
    rows = _sections(spark, sf_dir).where(F.col("n_words") >= V.MIN_WORDS)
    made = rows.select("source", "doc_id", F.col("doc_id").alias("key"), X.truncated(F.col("text"), V.PASSAGE).alias("passage"))
    kind = F.element_at(F.array(*(F.lit(t) for t in V.QUESTION_TYPES)), (F.pmod("doc_id", F.lit(len(V.QUESTION_TYPES))) + 1).cast("int"))
    level = F.element_at(F.array(F.lit("easy"), F.lit("medium"), F.lit("hard")), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    return generation.template_questions(made).withColumn("type", kind).withColumn("difficulty", level)


def qa_template_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _template(spark, sf_dir).select("doc_id", "question", "answer")


def answer_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each section's own answer, and the answer of the section before it as a foreign one."""
    rows = _template(spark, sf_dir).withColumn("foreign", F.lag("answer").over(Window.partitionBy("source").orderBy("doc_id")))
    ratio = lambda a: F.round(X.grounding_ratio(X.normalised(F.coalesce(a, F.lit(""))), X.normalised(F.col("passage"))), 6)
    return rows.select("doc_id", ratio(F.col("answer")).alias("own_ratio"), ratio(F.col("foreign")).alias("foreign_ratio")).withColumn("foreign_grounded", F.col("foreign_ratio") >= V.MIN_KEYWORDS)


def best_matching_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("source", F.coalesce("text", F.lit("")).alias("text"))
    names = rows.agg(F.array_sort(F.collect_set("source")).alias("sources"))
    items = _benchmark(spark, sf_dir).select("item_id", "text").crossJoin(F.broadcast(names))  # one row of source names
    return validation.best_matching(items, rows)


def hallucination_topic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sections(spark, sf_dir)
    asked = _benchmark(spark, sf_dir).select(F.col("item_id").alias("query_id"), F.col("text").alias("question"), F.lit("").alias("passage"))
    return validation.topic_elsewhere(asked, _index(spark, sf_dir), rows).withColumnRenamed("query_id", "item_id")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good, foreign and short answers, so that several rules fire."""
    rows = _template(spark, sf_dir)
    case = F.pmod("doc_id", F.lit(4))
    context = F.when(case == 3, F.left("passage", F.lit(25))).otherwise(F.col("passage"))
    answer = F.when(case == 1, "zzzz qqqq xxxx").otherwise(F.col("answer"))
    ratio = F.when(case == 2, 0.1).otherwise(1.0)
    made = rows.withColumns({"context": context, "answer": answer, "match_ratio": ratio, "same_document": F.lit(True)})
    return validation.validated(made)


def validation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).groupBy("type", "reason").agg(F.count("*").alias("n"))


def llm_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as a model may write them, made from benchmark items in six forms."""
    items = _benchmark(spark, sf_dir).select("item_id", F.to_json(F.struct(F.reverse("text").alias("question"), F.col("text").alias("answer"))).alias("j"))
    form = F.pmod("item_id", F.lit(6))
    raw = F.when(form == 0, F.col("j")).when(form == 1, F.concat(F.lit("```json\n"), "j", F.lit("\n```"))).when(form == 2, F.concat(F.lit("Here it is: "), "j", F.lit(" as asked."))).when(form == 3, F.concat(F.lit("["), "j", F.lit("]"))).when(form == 4, "no answer").otherwise("")
    return generation.parsed_answers(items.select(F.col("item_id").alias("row_id"), raw.alias("raw")))


def prompt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _template(spark, sf_dir).select(F.concat(F.lit("q"), "doc_id").alias("id"), "type", "passage", F.array("source").alias("sources"), "difficulty")
    return generation.prompt_messages(rows).select("id", "role", F.md5(F.col("content").cast("binary")).alias("digest"))


def question_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids over a run's accepted questions."""
    some = {t: TypeConfig(True, 3) for t in ("direct_lookup", "paraphrase_lookup", "tables_extraction", "hallucination_test", "pinpointing_quoting")}
    return run(documents(spark, sf_dir), RunConfig(some)).select("id", "type", "difficulty", F.md5(F.col("context").cast("binary")).alias("digest"))


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _judged(spark, sf_dir).where("valid")
    return made.select(F.col("doc_id").alias("ord"), F.col("doc_id").alias("id"), "type", "difficulty", "question", "answer", "context", F.array("source").alias("source_documents"), "match_ratio", "answer_grounded")


def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.long_format(summary.summary(_accepted(spark, sf_dir), 1000, 2000))


def difficulty_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distribution(_accepted(spark, sf_dir), "difficulty")


def type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distribution(_accepted(spark, sf_dir), "type")


def source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.source_distribution(_accepted(spark, sf_dir))


def duplicate_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).agg((F.count("*") - F.count_distinct("question")).alias("n_duplicates"))


def viewer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.viewer_filter(_accepted(spark, sf_dir), difficulty="medium", search="THE").select("id")


def keyword_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.snippets(documents(spark, sf_dir), "license").select("doc_id", F.col("pos").cast("long").alias("pos"), "snippet")


def doc_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return browse.listing(documents(spark, sf_dir)).withColumn("size", F.col("size").cast("long"))


def keyword_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = browse.keyword_region(documents(spark, sf_dir), "License that with which nicht para dans")
    return found.select("doc_id", F.col("best_start").cast("long").alias("best_start"), "score", F.col("region_start").cast("long").alias("region_start"))


def multi_turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = browse.follow_ups(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return rows.select("conv_id", "turn", *(F.length(c).cast("long").alias(f"{c}_len") for c in FOLLOW_UP_COLUMNS))


def question_type_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = RunConfig({t: TypeConfig(True, 3) for t in list(V.QUESTION_TYPES)[:15]})
    return type_table(spark, config).groupBy("strategy").agg(F.count("*").alias("n_types"), F.sum(F.when(F.col("enabled"), F.col("count")).otherwise(0)).alias("requested"))


QUERIES = {
    f.__name__: f
    for f in (
        sections_parse, section_tags, section_entities_counts, key_nouns, tokens_top_terms, term_df, corpus_stats, bm25_topk, bm25_repeated_term, bm25_source_filter,
        within_pairs_capped, lists_capped_topk, long_context_spans, hallucination_sample, unused_sections_anti, boilerplate_flags, toc_flags, truncate_passage,
        normalised_text, context_match_ratio, answer_grounding, best_matching_doc, hallucination_topic_check, validation_reasons, qa_template_generate, llm_json_parse,
        prompt_messages, question_ids, summary_metrics, difficulty_distribution, type_distribution, source_distribution, duplicate_questions, viewer_filter,
        keyword_snippets, doc_listing, keyword_prefilter, multi_turn_pairs, question_type_dim,
    )
}
_NAMES = {"direct": "direct_lookup_topk", "paraphrase": "paraphrase_topk", "jargon": "jargon_topk", "needle": "needle_topk", "tables": "tables_topk", "generic": "generic_topk", "pinpoint": "pinpoint_topk", "temporal": "temporal_single_doc_topk"}
QUERIES |= {name: _top(strategy) for strategy, name in _NAMES.items()}
QUERIES |= {"within_pairs_topk": _pairs(True), "between_pairs_topk": _pairs(False)}
