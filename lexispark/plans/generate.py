"""A whole run: question types in order, each selecting among what the types before left.

The tracker of used sections is a small set of doc_ids (at most two for each question asked
for), kept on the driver and joined as an anti join; all scoring stays in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V
from lexispark.operators import pairs as P
from lexispark.operators import selection as S
from lexispark.operators import sections as D
from lexispark.operators.generation import generator, question_ids
from lexispark.operators.ranking import stored_index
from lexispark.operators.validation import source_ratios, topic_elsewhere, validated
from lexispark.sources.corpus import folder_documents
from lexispark.sources.work import kept, work_folder


@dataclass(frozen=True)
class TypeConfig:
    enabled: bool = False
    count: int = 5
    difficulty: str = "medium"


@dataclass
class RunConfig:
    types: dict[str, TypeConfig] = field(default_factory=dict)
    generator: str = "template"
    seed: int = 42

    def enabled(self) -> list[tuple[str, TypeConfig]]:
        return [(t, self.types[t]) for t in V.QUESTION_TYPES if t in self.types and self.types[t].enabled]

    def requested(self) -> int:
        return sum(c.count for _, c in self.enabled())


def type_table(spark: SparkSession, config: RunConfig) -> DataFrame:
    """The question types as a table: (ord, type, strategy, enabled, count, difficulty)."""
    rows = [(i, t, s, (c := config.types.get(t, TypeConfig())).enabled, c.count, c.difficulty) for i, (t, s) in enumerate(V.QUESTION_TYPES.items())]
    return spark.createDataFrame(rows, "ord int, type string, strategy string, enabled boolean, count int, difficulty string")


#: The facts and tags that each strategy reads; some facts are slow to find.
READS = {
    "direct": ("numbers", "money", "dates", "emails", "phones", "has_list"), "paraphrase": ("entity_count", "has_definition"), "jargon": ("terms", "has_definition", "nouns"),
    "needle": ("entity_count",), "tables": ("has_table", "numbers", "money"), "generic": ("entity_count",), "pinpoint": ("emails", "phones", "urls", "terms", "money", "numbers"),
    "temporal": ("dates", "has_dates", "nouns", "terms"), "within": ("nouns", "terms"), "between": ("nouns", "terms"), "lists": ("has_list",), "long_context": (), "hallucination": (),
}


def prepared(sections: DataFrame, strategies: Iterable[str] = tuple(READS)) -> DataFrame:
    """Sections with the facts and tags that the strategies read."""
    made = D.facts(D.tags(sections)).withColumn("nouns", X.key_nouns(F.col("text")))
    read = [c for c in made.columns if c not in sections.columns and any(c in READS[s] for s in strategies)]
    return made.select(*(c for c in sections.columns if c != "content"), *read)


def over_fetch(strategy: str, count: int) -> int:
    return count + (6 if strategy in ("hallucination", "long_context") else 2)


def select(spark: SparkSession, sections: DataFrame, qtype: str, count: int, used: set[int], seed: int) -> list[tuple]:
    """(doc_ids, passage, sources) of a type's candidates in order; their number is bounded by count."""
    strategy = V.QUESTION_TYPES[qtype]
    gone = spark.createDataFrame([(u,) for u in sorted(used)], "doc_id long")
    n_sources = sections.agg(F.count_distinct("source")).first()[0] if strategy in ("between", "temporal") else 0
    if strategy in ("within", "between") or (strategy == "temporal" and n_sources >= 2):
        inside = strategy == "within"
        found, n_linked = P.deciding_pairs(sections, count, used, inside)
        taken = P.capped(found, count, used, inside, n_linked)
        ids = [i for p in taken for i in (p["doc_a"], p["doc_b"])]
        text = {r.doc_id: (r.t, r.source) for r in sections.where(F.col("doc_id").isin(ids)).select("doc_id", "source", X.truncated(F.col("text"), V.PAIR_PASSAGE).alias("t")).collect()}
        return [((p["doc_a"], p["doc_b"]), V.SEPARATOR.join(text[p[k]][0] for k in ("doc_a", "doc_b")), list(dict.fromkeys(text[p[k]][1] for k in ("doc_a", "doc_b")))) for p in taken]
    if strategy == "long_context":
        spans = S.long_spans(sections).orderBy("start_idx").limit(count)
        rows = S.top_sections(sections).select("source", "doc_id", "text").join(F.broadcast(spans.drop("start_idx")), "source").where("doc_id >= first_doc_id")  # at most count spans
        place = F.row_number().over(Window.partitionBy("source", "first_doc_id").orderBy("doc_id"))
        parts = rows.withColumn("place", place).where(F.col("place") <= V.LONG_SPAN).where("place <= n_included")
        passage = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "\n\n")
        whole = parts.groupBy("source", "first_doc_id").agg(passage.alias("passage"))
        return [((r.first_doc_id,), r.passage, [r.source]) for r in whole.orderBy("first_doc_id").collect()]
    if strategy == "hallucination":
        best = S.hallucination_topics(sections, count, seed)
    elif strategy == "lists":
        best = S.top_lists(sections, count, gone)
    else:
        best = S.top_passages(strategy, sections, count, gone)
    return [((r.doc_id,), r.passage, [r.source]) for r in best.orderBy("rank").collect()]


def run(documents: DataFrame, config: RunConfig) -> DataFrame:
    """``run_sections`` over documents (doc_id, text, source), each one section of its source."""
    return run_sections(D.corpus_view(documents), config)


def run_files(spark: SparkSession, folder: str, config: RunConfig, parse: Callable[[bytes], list[str]] | None = None) -> DataFrame:
    """``run_sections`` over the sections of a folder's markdown, text and PDF files (``parse`` as in ``folder_documents``), with their dates."""
    files, pages = folder_documents(spark, folder, parse)
    return run_sections(D.file_sections(files, pages), config, files.select(F.col("filename").alias("source"), F.coalesce("year_in_name", "modified").alias("date")))


def run_sections(rows: DataFrame, config: RunConfig, dates: DataFrame | None = None) -> DataFrame:
    """The accepted questions: id, type, question, answer, context, source_documents, difficulty, match_ratio, answer_grounded.

    rows: sections (source, doc_id, heading, content, text, n_words). Generators get, with
    dates (source, date), the dates of each temporal question's sources as strings.
    """
    spark = rows.sparkSession
    # Facts are found once.
    sections = kept(prepared(rows, {V.QUESTION_TYPES[t] for t, _ in config.enabled()}), "sections")
    used: set[int] = set()
    chosen, order = [], 0
    for qtype, c in config.enabled():
        for ids, passage, sources in select(spark, sections, qtype, over_fetch(V.QUESTION_TYPES[qtype], c.count), used, config.seed):
            used |= set(ids)
            chosen.append((order, qtype, c.difficulty, c.count, f"{qtype}:{order}", passage, sources))
            order += 1
    made = spark.createDataFrame(chosen, "ord int, type string, difficulty string, wanted int, key string, passage string, source_documents array<string>")
    if dates is not None:
        named = made.where("type = 'temporal_questions'").select("ord", F.explode("source_documents").alias("source")).join(dates, "source").groupBy("ord").agg(F.array_sort(F.collect_set(F.concat_ws(": ", "source", "date"))).alias("dates"))
        made = made.join(named, "ord", "left")
    # Kept, as a generator may be slow or answer anew; the rows are bounded.
    asked = generator(config.generator)(made).withColumn("context", F.col("passage")).persist()
    ratios = source_ratios(asked.select(F.col("ord").alias("context_id"), "context", F.col("source_documents").alias("sources")), sections)
    matched = asked.join(ratios.select(F.col("context_id").alias("ord"), F.col("ratio").alias("match_ratio")), "ord")
    judged = validated(matched.withColumns({"same_document": (F.size("source_documents") < 2) & F.contains("passage", F.lit(V.SEPARATOR))}))
    if any(r[1] == "hallucination_test" for r in chosen):
        tests = judged.where("valid and type = 'hallucination_test'").select(F.col("ord").alias("query_id"), "question", "passage")
        known = topic_elsewhere(tests, stored_index(sections, work_folder(spark, "index")), sections).where("exists").select(F.col("query_id").alias("ord"))
        judged = judged.join(known, "ord", "left_anti")
    nth = F.row_number().over(Window.partitionBy("type").orderBy("ord"))
    accepted = judged.where("valid").withColumn("nth", nth).where(F.col("nth") <= F.col("wanted"))
    return question_ids(accepted, "ord").select("ord", "id", "type", "question", "answer", "context", "source_documents", "difficulty", "match_ratio", "answer_grounded")
