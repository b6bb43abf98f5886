"""Passage selection: a score, an order and a top-k for each strategy.

Ties go to (source, doc_id) order, so every result is determined. ``used`` is a table of
doc_ids that were selected before; it is left out by an anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V

_n = F.size

#: Rows of one source that are put in order together.
STRETCH = 100_000

#: Strategy: score, whether only positive scores count, whether boilerplate is left out.
SCORES: dict[str, tuple] = {
    "direct": (lambda: 2 * _n("numbers") + 3 * _n("money") + 2 * _n("dates") + 2 * _n("emails") + 3 * _n("phones") + F.col("has_list").cast("int"), True, False),
    "paraphrase": (lambda: F.least("n_words", F.lit(200)) / 50 + F.col("entity_count") + 2 * F.col("has_definition").cast("int"), False, True),
    "jargon": (lambda: 3 * _n("terms") + 2 * F.col("has_definition").cast("int") + 0.5 * _n("nouns"), True, False),
    "needle": (lambda: (1 - F.col("entity_count") / F.col("n_words")) * F.col("n_words"), False, False),
    "tables": (lambda: F.when(F.col("has_table"), F.col("n_words") + 100).when(_n("numbers") + _n("money") >= 2, 10 * (_n("numbers") + _n("money"))), True, False),
    "generic": (lambda: F.least("n_words", F.lit(200)) / 50 + 0.5 * F.col("entity_count"), False, True),
    "pinpoint": (lambda: 4 * _n("emails") + 4 * _n("phones") + 3 * _n("urls") + 2 * _n("terms") + 2 * _n("money") + _n("numbers"), True, True),
    "temporal": (lambda: 3 * _n("dates") + F.col("has_dates").cast("int"), True, False),
}


def eligible(sections: DataFrame, used: DataFrame | None = None, min_words: int = V.MIN_WORDS) -> DataFrame:
    rows = sections.where(F.col("n_words") >= min_words)
    return rows if used is None else rows.join(used.select("doc_id"), "doc_id", "left_anti")


def scored(strategy: str, sections: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """All sections that the strategy may select, with their score."""
    score, positive, no_boilerplate = SCORES[strategy]
    rows = eligible(sections, used)
    if strategy == "needle":
        rows = rows.where((F.col("n_words") > 50) & F.col("entity_count").between(1, 4))
    if no_boilerplate:
        rows = rows.where(~X.is_boilerplate(F.col("text"), F.col("n_words")))
    rows = rows.withColumn("score", F.round(score().cast("double"), 6))
    return rows.where("score > 0") if positive else rows


def ranked(rows: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows in the order, with their rank: the limit runs as a top-k, the rank over k rows only."""
    best = rows.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_passages(strategy: str, sections: DataFrame, k: int = 5, used: DataFrame | None = None, size: int = V.PASSAGE) -> DataFrame:
    """(rank, source, doc_id, score, passage) of a strategy's k best sections."""
    best = ranked(scored(strategy, sections, used), k, F.desc("score"), "source", "doc_id")
    return best.withColumn("passage", X.truncated(F.col("text"), size)).select("rank", "source", "doc_id", "score", "passage")


def whole_text(sections: DataFrame) -> Column:
    """A section's text with those of its subsections, where the table knows them."""
    return F.col("all_text" if "all_text" in sections.columns else "text")


def top_sections(sections: DataFrame) -> DataFrame:
    """The sections that are no subsections, with the whole text of each."""
    return sections.where("is_top").withColumn("text", whole_text(sections)) if "is_top" in sections.columns else sections


def top_lists(sections: DataFrame, k: int = 5, used: DataFrame | None = None, flag: Column | str = "has_list") -> DataFrame:
    """Sections with lists, longest first with their subsections, at most ceil(k / documents) of a document before the rest fill up."""
    rows = eligible(sections, used).where(flag)
    if "all_text" in sections.columns:
        rows = rows.withColumn("n_words", X.word_count(F.col("all_text")))
    n = rows.agg(F.count_distinct("source")).first()[0]
    cap = max(1, -(-k // max(1, n)))
    own = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n_words"), "doc_id"))
    # Only the first k of each document can be among the k.
    first = rows.withColumn("own_rank", own).where(F.col("own_rank") <= k).withColumn("fill", (F.col("own_rank") > cap).cast("int"))
    return ranked(first, k, "fill", F.desc("n_words"), "source", "doc_id").withColumn("passage", X.truncated(whole_text(rows), V.LIST_PASSAGE))


def positions(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """rows (source, doc_id, others) with pos, a row's place in its source by doc_id from 0, and n, the rows of the source.

    doc_id is a whole number. A large source is dealt over many tasks: ids are cut into stretches
    of equal width, as many as fit ``stretch`` rows each, and a row's place is its place in the
    stretch and the rows of the stretches before.
    """
    bounds = rows.agg(F.min("doc_id").cast("double").alias("__low"), F.max("doc_id").cast("double").alias("__high"), F.count("*").alias("__rows"))
    width = F.greatest(F.ceil((F.col("__high") - F.col("__low") + 1) / F.ceil(F.col("__rows") / stretch)), F.lit(1))
    cut = rows.join(F.broadcast(bounds)).withColumn("__cut", F.floor((F.col("doc_id").cast("double") - F.col("__low")) / width)).drop("__low", "__high", "__rows")  # one row of bounds
    before, whole = Window.partitionBy("source").orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("source")
    sizes = cut.groupBy("source", "__cut").agg(F.count("*").alias("__n"))
    starts = sizes.select(F.col("source").alias("__source"), F.col("__cut").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"), F.sum("__n").over(whole).alias("n"))
    own = Window.partitionBy("source", "__cut").orderBy("doc_id")
    placed = cut.withColumn("__place", F.row_number().over(own) - 1)
    known = F.col("source").eqNullSafe(F.col("__source")) & F.col("__cut").eqNullSafe(F.col("__of"))
    return placed.join(starts, known).withColumn("pos", F.col("__start") + F.col("__place")).drop("__cut", "__place", "__start", "__source", "__of")


def long_spans(sections: DataFrame, size: int = V.LONG_CONTEXT, span: int = V.LONG_SPAN) -> DataFrame:
    """Runs of neighbouring sections of one document: (source, start_idx, n_included, total_chars, first_doc_id).

    Of top sections with their subsections. Documents of three or more; runs begin every ``span`` sections, take whole sections
    up to ``size`` characters (separators count two) and need two. For each start only the
    first document counts.
    """
    placed = positions(top_sections(sections).select("source", "doc_id", F.length("text").alias("len")))
    width = F.least(F.lit(span), F.col("n"))
    runs = placed.where("n >= 3").withColumn("start_idx", (F.floor(F.col("pos") / width) * width).cast("int")).where(F.col("start_idx") < F.col("n") - 2)
    upto = Window.partitionBy("source", "start_idx").orderBy("pos")
    summed = runs.withColumn("total", F.sum(F.col("len") + 2).over(upto) - 2).where((F.col("total") <= size) | (F.col("pos") == F.col("start_idx")))
    made = summed.groupBy("source", "start_idx").agg(F.count("*").alias("n_included"), F.max("total").alias("total_chars"), F.min("doc_id").alias("first_doc_id")).where("n_included >= 2")
    first = made.groupBy("start_idx").agg(F.min(F.struct("source", "n_included", "total_chars", "first_doc_id")).alias("x"))
    return first.select("x.source", "start_idx", "x.n_included", "x.total_chars", "x.first_doc_id")


def hallucination_topics(sections: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """k sections in an order fixed by a hash of doc_id and the seed; the tracker does not matter here."""
    order = F.md5(F.concat_ws(":", F.lit(seed), "source", F.col("doc_id").cast("string")))
    rows = sections.where(F.col("n_words") >= V.MIN_WORDS).withColumn("draw", order)
    best = ranked(rows, k, "draw", "doc_id")
    return best.withColumn("passage", X.truncated(F.col("text"), V.HALLUCINATION_PASSAGE)).select("rank", "source", "doc_id", "draw", "passage")
