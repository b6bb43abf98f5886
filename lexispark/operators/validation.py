"""Validation of generated questions: context match, grounding, rule cascade, foreign topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V
from lexispark.operators.numbering import numbered_within
from lexispark.operators.ranking import SearchIndex, search
from lexispark.sources.work import kept


def held_parts(words: DataFrame, parts: DataFrame, by: list[str], match: list[str]) -> DataFrame:
    """Distinct (by, context_id, pos) of the parts of one to four words that texts hold as substrings.

    words has the columns ``by`` and w, the words of a normalised text; parts, a stored table, has
    context_id, pos, p (words) and those columns ``match`` of ``by`` that must agree. A part may begin and
    end inside a word, but its inner words stand whole, so it is looked up by these in
    the words' places, and the words before and after decide: no text moves. Parts of one or two
    words have no inner word and are looked up by up to three letters. Spark broadcasts the parts
    where their table is small enough.
    """
    near = lambda w: F.transform(w, lambda x, i: F.struct(F.get(w, i - 1).alias("before"), x.alias("word"), F.get(w, i + 1).alias("after"), F.get(w, i + 2).alias("end")))
    spots = words.select(*by, F.explode(X.once(F.col("w"), near)).alias("s")).select(*by, "s.*")
    letters = lambda x: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.length(x), F.lit(1))), lambda i: F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.substring(x, i, n)))))
    starts = lambda x: F.array_distinct(F.array(*(F.left(x, F.lit(n)) for n in (1, 2, 3))))
    first, second, last = F.get("p", F.lit(0)), F.get("p", F.lit(1)), F.element_at("p", -1)
    # Words of a part: how its key is made, the keys of a place, and what else must hold.
    kinds = {
        4: (F.concat_ws(" ", second, F.get("p", F.lit(2))), spots.withColumn("key", F.concat_ws(" ", "word", "after")), F.endswith("before", first) & F.startswith("end", last)),
        3: (second, spots.withColumn("key", F.col("word")), F.endswith("before", first) & F.startswith("after", last)),
        2: (F.left(last, F.lit(3)), spots.withColumn("key", F.explode(starts(F.col("after")))), F.endswith("word", first) & F.startswith("after", last)),
        1: (F.left(first, F.lit(3)), spots.select(*by, "word").distinct().withColumn("key", F.explode(letters(F.col("word")))), F.contains("word", first)),
    }
    sizes = {r.n for r in parts.select(F.size("p").alias("n")).distinct().collect()}  # at most four
    found = None
    for n, (key, places, good) in kinds.items():
        if n in sizes or (found is None and n == 1):
            met = places.join(parts.where(F.size("p") == n).select("context_id", "pos", "p", *match, key.alias("key")), [*match, "key"]).where(good)
            one = met.select(*by, "context_id", "pos").distinct()
            found = one if found is None else found.unionByName(one)
    return found


def words_of(text: Column) -> Column:
    """The words of a text's normal form."""
    return F.array_remove(F.split(X.normalised(text), " "), "")


def parts_of(contexts: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """(context_id, n, carried) and a stored table (context_id, pos, p, carried) of the chunks of contexts, or of the whole of those under four words."""
    w = contexts.select("context_id", *carried, X.normalised(F.col("context")).alias("c")).withColumn("chunks", X.chunks(F.col("c")))
    texts = F.when(F.size("chunks") > 0, F.col("chunks")).when(F.col("c") != "", F.array("c")).otherwise(F.array().cast("array<string>"))
    cut = kept(w.select("context_id", *carried, texts.alias("parts")), "contexts")
    listed = cut.select("context_id", *carried, F.posexplode("parts").alias("pos", "part")).withColumn("p", F.split("part", " ")).drop("part")
    return cut.select("context_id", F.size("parts").alias("n"), *carried), listed


def context_matches(contexts: DataFrame, documents: DataFrame, least: float = V.MIN_MATCH) -> DataFrame:
    """(context_id, doc_id, ratio) of contexts (context_id, context) that documents (doc_id, text) hold to ``least`` or more."""
    sizes, listed = parts_of(contexts)
    found = held_parts(documents.select("doc_id", words_of(F.col("text")).alias("w")), kept(listed, "parts"), ["doc_id"], [])
    counted = found.groupBy("doc_id", "context_id").agg(F.count("*").alias("held")).join(sizes, "context_id")
    return counted.select("context_id", "doc_id", F.round(F.col("held") / F.col("n"), 6).alias("ratio")).where(F.col("ratio") >= least)


def borders(words: DataFrame) -> DataFrame:
    """(source, w): the last three words before and the first three from each section of a source on; words has source, doc_id and w."""
    # Few words of each section, found once.
    cut = lambda w: F.struct(F.slice(w, F.lit(1), F.lit(3)).alias("head"), F.slice(w, F.greatest(F.size(w) - 2, F.lit(1)), F.lit(3)).alias("tail"))
    ends = kept(words.where("source is not null").select("source", "doc_id", X.once(F.col("w"), cut).alias("e")), "ends")
    placed = numbered_within(ends.where("size(e.head) > 0").select("source", "doc_id", "e.head", "e.tail"), ["source"], "doc_id")
    # A section has a word at least, so three of them reach across a border.
    tails = placed.select("source", F.explode(F.array(*(F.col("ord") + i for i in (1, 2, 3)))).alias("border"), "ord", F.col("tail").alias("w"))
    heads = placed.select("source", F.explode(F.array(*(F.col("ord") - i for i in (0, 1, 2)))).alias("border"), "ord", F.col("head").alias("w"))
    around = tails.unionByName(heads).groupBy("source", "border").agg(F.array_sort(F.collect_list(F.struct("ord", "w"))).alias("x"))
    side = lambda before: F.flatten(F.transform(F.filter("x", lambda x: (x["ord"] < F.col("border")) == F.lit(before)), lambda x: x["w"]))
    both = around.select("source", side(True).alias("t"), side(False).alias("h")).where("size(t) > 0 and size(h) > 0")
    return both.select("source", F.concat(F.expr("slice(t, -least(3, size(t)), 3)"), F.slice("h", F.lit(1), F.lit(3))).alias("w"))


def source_ratios(contexts: DataFrame, sections: DataFrame) -> DataFrame:
    """(context_id, ratio): the share of a context's chunks that the texts of its sources hold, 0 if none.

    contexts has context_id, context and sources; sections has source, doc_id and text. The texts
    of a source count as one, in the order of doc_id: chunks that cross from one section to the next
    are found in the words around each border.
    """
    sizes, listed = parts_of(contexts, "sources")
    wanted = kept(listed.withColumn("source", F.explode(F.array_distinct("sources"))).drop("sources"), "parts")
    named = wanted.select("source").distinct()
    words = sections.join(named, "source", "left_semi").select("source", "doc_id", words_of(F.col("text")).alias("w"))
    found = held_parts(words.select("source", "w").unionByName(borders(words)), wanted, ["source"], ["source"])
    counted = found.select("context_id", "pos").distinct().groupBy("context_id").agg(F.count("*").alias("held"))
    ratio = F.round(F.coalesce(F.col("held") / F.col("n"), F.lit(0.0)), 6)
    return sizes.join(counted, "context_id", "left").select("context_id", ratio.alias("ratio"))


def best_matching(excerpts: DataFrame, documents: DataFrame) -> DataFrame:
    """(item_id, source, score): for each excerpt (item_id, text, sources) the source whose text has most of its long words.

    documents has source and texts of its sections; ties go to the first source named. Work
    starts from sources with a hit, however many an excerpt names.
    """
    words = F.array_distinct(F.filter(F.split(X.normalised(F.col("text")), " "), lambda w: F.length(w) >= 4))
    asked = excerpts.select("item_id", "sources", words.alias("words"))
    long = asked.select("item_id", F.explode("words").alias("word"))
    # A word has no spaces, so a text holds it where one of its own words does; four letters of it find those words.
    wanted = kept(long.select("word").distinct().withColumn("start", F.left("word", F.lit(4))), "words")
    terms = documents.select("source", F.explode(words).alias("term")).distinct()
    starts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("term") - 3), lambda i: F.substring(F.col("term"), i, F.lit(4))))
    found = terms.withColumn("start", F.explode(starts)).join(wanted, "start").where(F.contains("term", F.col("word"))).select("source", "word").distinct()
    hits = long.join(found, "word").groupBy("item_id", "source").agg(F.count("*").alias("hits"))
    rated = hits.join(asked, "item_id").withColumn("pos", F.array_position("sources", F.col("source"))).where("pos > 0")
    best = rated.withColumn("score", F.round(F.col("hits") / F.size("words"), 6)).withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "pos")))
    return best.where("r = 1").select("item_id", "source", "score")


def reason(qtype: Column, ratio: Column, context: Column, answer: Column, same_document: Column) -> Column:
    """The first rule that a question breaks, or passed."""
    grounded = qtype.isin(*V.UNGROUNDED) | (X.grounding_ratio(X.normalised(answer), X.normalised(context)) >= V.MIN_KEYWORDS)
    return (
        F.when(ratio < V.MIN_MATCH, "context_not_found").when(X.is_contents_table(context), "contents_table").when(~grounded, "answer_not_grounded")
        .when(F.length(X.strip(context)) < V.MIN_CONTEXT, "context_too_short").when((qtype == "multi_hop_between_documents") & same_document, "same_document").otherwise("passed")
    )


def validated(questions: DataFrame) -> DataFrame:
    """questions (type, context, answer, match_ratio, same_document) with answer_grounded, reason and valid."""
    grounded = F.col("type").isin(*V.UNGROUNDED) | (X.grounding_ratio(X.normalised(F.col("answer")), X.normalised(F.col("context"))) >= V.MIN_KEYWORDS)
    why = reason(F.col("type"), F.col("match_ratio"), F.col("context"), F.col("answer"), F.col("same_document"))
    return questions.withColumn("answer_grounded", grounded).withColumn("reason", why).withColumn("valid", F.col("reason") == "passed")


def topic_elsewhere(questions: DataFrame, index: SearchIndex, sections: DataFrame) -> DataFrame:
    """(query_id, exists): whether a clearly different section answers a question (query_id, question, passage)."""
    asked = questions.select("query_id", X.topic_words(F.col("question")).alias("topic"), "passage").where(F.size("topic") >= 2)
    queries = asked.select("query_id", X.tokens(F.array_join(F.slice("topic", 1, 5), " ")).alias("terms"))
    hits = search(index, queries, 3).where(F.col("score") >= V.TOPIC_SCORE).select("query_id", "doc_id")
    start = lambda c: F.array_distinct(F.filter(F.split(F.regexp_replace(F.left(F.lower(c), F.lit(300)), r"\s+", " "), " "), lambda w: w != ""))
    rows = hits.join(sections.select("doc_id", "text"), "doc_id").join(asked, "query_id").withColumn("own", start(F.col("text")))
    far = F.size(F.array_intersect("own", start(F.col("passage")))) / F.greatest(F.size("own"), F.lit(1)) <= V.TOPIC_OVERLAP
    told = F.size(F.expr("filter(topic, w -> contains(lower(text), w))")) >= 2
    known = rows.where(far & told).select("query_id").distinct().withColumn("exists", F.lit(True))
    return questions.select("query_id").join(known, "query_id", "left").select("query_id", F.coalesce("exists", F.lit(False)).alias("exists"))
