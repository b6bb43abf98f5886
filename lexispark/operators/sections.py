"""Sections of documents, their tags and their facts.

A table of sections has the columns source, doc_ord, sec_ord, heading, content and text
(heading and content together). ``corpus_view`` reads the documents table that way: a source
is a document, a row is a section.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V

LISTS = ("numbers", "money", "dates", "emails", "phones", "urls", "terms")


def first_line(text: Column) -> Column:
    return F.left(X.strip(F.substring_index(text, "\n", 1)), F.lit(80))


def corpus_view(documents: DataFrame) -> DataFrame:
    content = F.coalesce("text", F.lit(""))
    return documents.select("source", "doc_id", first_line(content).alias("heading"), content.alias("content"), content.alias("text"), X.word_count(content).alias("n_words"))


def plain_sections(documents: DataFrame) -> DataFrame:
    """Paragraphs of plain texts (doc_id, text): the first line is the heading, also of a single-line one."""
    parts = documents.select("doc_id", F.posexplode(F.split("text", r"\n\s*\n")).alias("pos", "raw")).withColumn("part", X.strip("raw"))
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # Offsets follow the stripped lengths, as the texts are rejoined by two line ends.
    placed = parts.withColumn("char_start", F.coalesce(F.sum(F.length("part") + 2).over(before), F.lit(0))).where(F.length("part") >= V.MIN_PARAGRAPH)
    rest = X.strip(F.when(F.contains("part", F.lit("\n")), F.expr(r"substring(part, instr(part, '\n') + 1)")).otherwise(F.col("part")))
    cut = placed.select("doc_id", "pos", first_line(F.col("part")).alias("heading"), rest.alias("content"), "char_start", (F.col("char_start") + F.length("part")).alias("char_end"), F.lit(0).alias("level"))
    return numbered(cut)


def numbered(sections: DataFrame) -> DataFrame:
    """sec_ord in order of pos, parent_sec_ord (of rows with a parent_pos, the last top section before), full_text and word count."""
    text = F.when(F.length("heading") > 0, F.concat_ws("\n", "heading", "content")).otherwise(F.col("content"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    placed = sections.withColumn("sec_ord", F.row_number().over(order) - 1).withColumn("full_text", text).withColumn("n_words", X.word_count(F.col("content")))
    if "parent_pos" not in sections.columns:
        return placed.withColumn("parent_sec_ord", F.lit(None).cast("int")).drop("pos")
    top = F.last(F.when(F.col("level") == 0, F.col("sec_ord")), ignorenulls=True).over(order)
    return placed.withColumn("parent_sec_ord", F.when(F.col("parent_pos").isNotNull(), top)).drop("pos", "parent_pos")


@F.udtf(returnType="pos int, level int, heading string, content string, char_start int, char_end int", useArrow=True)
class MarkdownCut:
    """The sections of a markdown text with their exact places, or one row without a place where it has no heading; the white space behind a heading's marks may hold line ends."""

    def eval(self, text: str):
        found = list(re.finditer(V.MARKDOWN_HEADING, text or "", re.MULTILINE))
        for i, m in enumerate(found):
            end = found[i + 1].start() if i + 1 < len(found) else len(text)
            yield i, len(m[1]) - 1, m[2].strip(), text[m.end() : end].strip(), m.start(), end
        if not found:
            yield None, None, None, None, None, None


def markdown_sections(documents: DataFrame) -> DataFrame:
    """Sections of markdown texts; what stands before the first heading is dropped; a text without headings is plain.

    A section goes from its heading's first mark to the next one's.
    """
    cut = documents.select("doc_id", "text").lateralJoin(MarkdownCut(F.col("text").outer()))
    made, plain = numbered(cut.where("pos is not null").drop("text")), cut.where("pos is null").select("doc_id", "text")
    return made.unionByName(plain_sections(plain), allowMissingColumns=True)


def page_of(position: Column, page_ends: Column) -> Column:
    """The page (from 1) that holds a character position; the last one beyond all."""
    return F.least(F.size(F.filter(page_ends, lambda e: e <= position)) + 1, F.size(page_ends))


def clean_heading(text: Column) -> Column:
    flat = F.regexp_replace(F.regexp_replace(text, r"^\s*\d+\s*\n", ""), r"\n", " ")
    return X.strip(F.regexp_replace(flat, r"\s{2,}", " "))


def paged_sections(pages: DataFrame) -> DataFrame:
    """Sections of texts given page by page (doc_id, page_no, text), by numbered or title-like headings.

    Headings within five characters of a kept one are dropped, chapters before subsections; a
    section under 20 characters is a contents line and goes unless it is the last. Subsections
    hang on the last chapter. Documents with under two top sections have one section a page.
    """
    whole = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p"))
    whole = whole.select("doc_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("raw"), F.expr("transform(p, (x, i) -> aggregate(slice(p, 1, i + 1), 0L, (acc, y) -> acc + length(y.text) + 1))").alias("page_ends"))
    lines = whole.select("doc_id", F.posexplode(F.split("raw", "\n")).alias("pos", "line"))
    upto = Window.partitionBy("doc_id").orderBy("pos")
    lines = lines.withColumn("begin", F.sum(F.length("line") + 1).over(upto) - F.length("line") - 1)
    chapter, sub, title = F.col("line").rlike(V.CHAPTER), F.col("line").rlike(V.SUBSECTION), F.col("line").rlike(V.TITLE_LINE) & (X.word_count(F.col("line")) >= 2)
    level = F.when(chapter, 0).when(sub, 1)
    heads = lines.withColumn("level", level).withColumn("numbered", F.max(F.col("level").isNotNull()).over(Window.partitionBy("doc_id")))
    heads = heads.withColumn("level", F.when(F.col("numbered"), F.col("level")).when(title, 0)).where("level is not null")
    picked = heads.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("begin", "level", "line"))).alias("h"))
    kept = F.expr("aggregate(h, cast(array() as array<struct<begin:bigint,level:int,line:string>>), (acc, x) -> if(exists(acc, k -> abs(k.begin - x.begin) < 5), acc, concat(acc, array(x))))")
    rows = picked.withColumn("h", kept).join(whole, "doc_id").select("doc_id", "raw", "page_ends", F.posexplode("h").alias("pos", "x")).select("doc_id", "raw", "page_ends", "pos", "x.*")
    order = Window.partitionBy("doc_id").orderBy("pos")
    spans = rows.withColumn("next", F.lead("begin").over(order)).withColumn("last", F.col("next").isNull())
    body = X.strip(F.expr("substring(raw, begin + length(line) + 1, coalesce(next, length(raw)) - begin - length(line))"))
    cut = spans.withColumn("content", body).where((F.length("content") >= 20) | F.col("last"))
    cut = cut.withColumn("parent_pos", F.when(F.col("level") == 1, F.last(F.when(F.col("level") == 0, F.col("pos")), ignorenulls=True).over(order)))
    end = F.coalesce("next", F.length("raw"))
    made = cut.select("doc_id", "pos", clean_heading(F.col("line")).alias("heading"), "content", F.col("begin").alias("char_start"), end.alias("char_end"), F.when(F.col("parent_pos").isNull(), 0).otherwise(F.col("level")).alias("level"), "parent_pos", page_of(F.col("begin"), F.col("page_ends")).alias("page_start"), page_of(end - 1, F.col("page_ends")).alias("page_end"))
    enough = made.where("level = 0").groupBy("doc_id").count().where("count >= 2").select("doc_id")
    lone = pages.join(enough, "doc_id", "left_anti").withColumn("body", X.strip("text")).where(F.length("body") >= V.MIN_PAGE)
    filled = F.filter(F.transform(F.split("body", "\n"), X.strip), lambda x: x != "")
    by_page = lone.select("doc_id", F.col("page_no").alias("pos"), clean_heading(filled[0]).alias("heading"), F.array_join(F.slice(filled, F.lit(2), F.size(filled)), "\n").alias("content"), F.lit(0).alias("level"), F.col("page_no").cast("int").alias("page_start"), F.col("page_no").cast("int").alias("page_end"))
    return numbered(made.join(enough, "doc_id", "left_semi").unionByName(by_page, allowMissingColumns=True))


def all_text(sections: DataFrame) -> DataFrame:
    """Top sections with the full texts of themselves and of their subsections, in order."""
    owned = sections.withColumn("top", F.coalesce("parent_sec_ord", "sec_ord"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("sec_ord", "full_text"))), lambda x: x["full_text"])
    return owned.groupBy("doc_id", F.col("top").alias("sec_ord")).agg(F.array_join(parts, "\n\n").alias("all_text"))


def file_sections(files: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Sections of read files (doc_id, filename, raw_text, doc_type) as ``corpus_view`` has them: source is the file, doc_id the section's own id.

    Markdown is cut at its headings, text at blank lines, pages (doc_id, page_no, text) of files
    at numbered or title-like headings; JSON files have no sections. all_text is a section's text
    with those of its subsections, is_top whether it is none itself.
    """
    raw = files.select("doc_id", F.col("raw_text").alias("text"), "doc_type")
    made = markdown_sections(raw.where("doc_type = 'md'")).unionByName(plain_sections(raw.where("doc_type = 'txt'")), allowMissingColumns=True)
    if pages is not None:
        made = made.unionByName(paged_sections(pages), allowMissingColumns=True)
    whole = all_text(made).withColumn("is_top", F.lit(True))
    told = made.join(whole, ["doc_id", "sec_ord"], "left").join(files.select("doc_id", F.col("filename").alias("source")), "doc_id")
    key = F.when(F.col("sec_ord") < 1 << 20, F.shiftleft(F.col("doc_id").cast("long"), 20) + F.col("sec_ord")).otherwise(F.raise_error(F.lit("a file of over a million sections")))
    return told.select("source", key.alias("doc_id"), "heading", "content", F.col("full_text").alias("text"), "n_words", F.coalesce("all_text", "full_text").alias("all_text"), F.coalesce("is_top", F.lit(False)).alias("is_top"))


def tags(sections: DataFrame) -> DataFrame:
    """The six structural flags of each section's text."""
    text = F.col("text")
    wide = lambda mark: F.size(F.filter(F.split(text, "\n"), lambda x: F.length(x) - F.length(F.replace(x, F.lit(mark), F.lit(""))) >= 2)) >= 2
    return sections.withColumns({
        "has_list": X.holds(text, V.BULLET) | X.holds(text, V.NUMBERED), "has_dates": X.holds(text, V.TAG_DATE), "has_numbers": X.holds(text, V.TAG_NUMBER),
        "has_contact": (F.contains(text, F.lit("@")) & X.holds(text, V.TAG_EMAIL)) | X.holds(text, V.TAG_PHONE) | X.holds(text, V.URL), "has_definition": X.holds(text, V.TAG_DEFINITION), "has_table": wide("\t") | wide("|"),
    })


def facts(sections: DataFrame) -> DataFrame:
    """The facts of each section's text as arrays, and entity_count."""
    text = F.col("text")
    some = sections.withColumn("dates", X.dates(text))
    made = some.withColumns({"numbers": X.numbers(text, F.col("dates")), "money": X.money(text), "emails": X.emails(text), "phones": X.phones(text), "urls": X.urls(text), "terms": X.defined_terms(text)})
    return made.withColumn("entity_count", sum((F.size(c) for c in LISTS[1:]), F.size(LISTS[0]))).withColumn("has_factual_content", sum((F.size(c) for c in LISTS[1:-1]), F.size(LISTS[0])) > 0)
