"""Benchmark passages in documents, by a distributed positional inverted index.

The index stores one posting (word, doc_id, key of the text, pos) for each word of the documents
that stands anywhere in the benchmark; no other word can be part of a match (a vocabulary too
large to be sent leaves nothing out). A window of an item is looked up from its rarest word:
the postings, moved by the word's place in the item, are the places where the window may begin
(``diag``, the document position of the item's first word). They are met with the moved postings
of the second rarest word: where both stand at the window's distance, the postings of all other
words of the item on that diagonal follow, and a window whose places are all there is an exact
match; where they stand within ``slack`` words of it, the item is near. So a very frequent word
is only read where a window has nothing rarer, texts are read and split once, and no pair of
documents is ever made.

All of it is DataFrame and SQL expressions. A table is broadcast only while its bytes, counted
first, stay under ``BROADCAST_BYTES``; beyond that the words of more than a ``HOT_WORDS``-th of
all postings (so at most as many words) are looked up apart from the others, which are joined by
word as any other table.

Defined cases: a null text has no words; items without words, text or id are left out; rows
that repeat are judged each on its own text, also under the same or no doc_id; items that
repeat an id count once. Only doc_id, text, item_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.shared import stored

WINDOW, SLACK = 10, 3
#: Bytes of a table that may be sent to every executor; most words that are looked up apart; bits of the filter of documents and of one of its rows.
BROADCAST_BYTES, HOT_WORDS, FILTER_BITS, ROW_BITS = 32 << 20, 1_000, 22, 16
#: A document's row: the same id and text give the same results.
ROW = ["doc_id", "text_key"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, capitals left in: they become small letters word by word.
SEPARATOR = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def small(word: str) -> str:
    """SQL: A-Z in lower case; most words have none and skip the slow way."""
    return f"if({word} = lower({word}), {word}, translate({word}, '{UPPER}', '{LOWER}'))"


def split_words(text: str) -> str:
    return f"array_remove(split(coalesce({text}, ''), '{SEPARATOR}'), '')"


def item_table(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, item_id, words, width): distinct items with words; width is the number of words of a window."""
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    items = items.selectExpr("xxhash64(item_id, text) as key", "item_id", f"transform({split_words('text')}, w -> {small('w')}) as words")
    return items.where("size(words) > 0").withColumn("width", F.least(F.size("words"), F.lit(window)))


def small_enough(df: DataFrame) -> bool:
    """Whether the rows of df, their strings and 16 bytes for each column, may be broadcast."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    size = sum(texts, F.lit(16 * len(df.columns)))
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= BROADCAST_BYTES


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The stored postings (word, doc_id, text_key, pos) of the vocabulary's words; the empty word stands once in each row, at its end."""
    split_up = docs.selectExpr("doc_id", "xxhash64(text) as text_key", f"posexplode(concat({split_words('text')}, array(''))) as (pos, token)")
    tokens = split_up.selectExpr(f"{small('token')} as word", *ROW, "pos")
    wanted = vocabulary.select("word").unionByName(docs.sparkSession.range(1).select(F.lit("").alias("word"))).distinct().checkpoint()
    return stored(tokens.join(F.broadcast(wanted), "word") if small_enough(wanted) else tokens, "postings")


@dataclass
class Postings:
    """A stored index, how often each word stands in it, and its most frequent words."""

    index: DataFrame
    frequency: DataFrame
    hot: DataFrame

    def of(self, side: DataFrame) -> DataFrame:
        """The postings joined with the rows of side (word, ...)."""
        if small_enough(side):
            return self.index.join(F.broadcast(side), "word")
        apart = lambda df, how: df.join(F.broadcast(self.hot), "word", how)
        some, rest = apart(side, "left_semi"), apart(side, "left_anti")
        some = F.broadcast(some) if small_enough(some) else some
        return apart(self.index, "left_semi").join(some, "word").unionByName(apart(self.index, "left_anti").join(rest, "word"))


def open_index(docs: DataFrame, items: DataFrame) -> Postings:
    index = build_index(docs, items.select(F.explode("words").alias("word")))
    frequency = index.groupBy("word").agg(F.count("*").alias("df")).checkpoint()
    total = frequency.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    return Postings(index, frequency, frequency.where(F.col("df") > total / HOT_WORDS).select("word"))


def look_ups(items: DataFrame, frequency: DataFrame) -> DataFrame:
    """For each window that can occur: its item, and place and word of its rarest and second rarest words."""
    places = items.selectExpr("key", "width", "posexplode(words) as (place, word)")
    rated = places.join(frequency, "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    starts = items.selectExpr("key", "explode(sequence(0, size(words) - width)) as start")
    windows = starts.join(rated, "key").where("place >= start and place < start + width")
    order = Window.partitionBy("key", "start").orderBy("df", "place")
    ranked = windows.withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    found = ranked.groupBy("key", "start").agg(F.min("df").alias("df"), *(at(k, c).alias(f"{c}{k}") for k in (1, 2) for c in ("place", "word")))
    return found.where("df > 0").select("key", "place1", "word1", "place2", "word2").distinct()


def same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & F.col(f"{a}.text_key").eqNullSafe(F.col(f"{b}.text_key"))


def meetings(postings: Postings, wanted: DataFrame, slack: int) -> DataFrame:
    """(doc_id, text_key, key, diag, apart): the two rarest words of a window, ``apart`` words off their distance; null for items of one word."""
    first = wanted.select("key", F.col("place1").alias("place"), F.col("word1").alias("word")).distinct()
    begin = postings.of(first).selectExpr(*ROW, "key", "place as place1", "pos - place as diag")
    second = wanted.select("key", "place1", "place2", "word2")
    pairs = begin.join(F.broadcast(second) if small_enough(second) else second, ["key", "place1"])
    single = pairs.where("word2 is null").select(*ROW, "key", "diag", F.lit(None).cast("int").alias("apart"))
    # An expected place and what lies within the slack of it are in one bucket or in two that lie side by side.
    step = 2 * slack + 1
    expected = pairs.where("word2 is not null").selectExpr(*ROW, "key", "diag", "word2 as word", "diag + place2 as aim", f"explode(array_distinct(array(floor((diag + place2 - {slack}) / {step}), floor((diag + place2 + {slack}) / {step})))) as bucket")
    other = postings.of(wanted.where("word2 is not null").selectExpr("word2 as word").distinct()).selectExpr(*ROW, "word", "pos", f"floor(pos / {step}) as bucket")
    met = expected.alias("e").join(other.alias("i"), same_row("e", "i") & F.expr("e.word = i.word and e.bucket = i.bucket")).where(F.expr(f"abs(i.pos - e.aim) <= {slack}"))
    return single.unionByName(met.select("e.doc_id", "e.text_key", "e.key", "e.diag", F.expr("i.pos - e.aim as apart")))


def rows_filter(rows: DataFrame) -> DataFrame:
    """(bucket, bits): a filter of fixed size that all the given rows pass."""
    place = rows.selectExpr(f"pmod(xxhash64(doc_id, text_key), {1 << FILTER_BITS}) as p").selectExpr(f"p div {1 << ROW_BITS} as bucket", f"p % {1 << ROW_BITS} div 64 as word", "shiftleft(1L, cast(p % 64 as int)) as bit")
    longs = place.groupBy("bucket", "word").agg(F.bit_or("bit").alias("bit"))
    listed = longs.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("word", "bit"))).alias("m"))
    return listed.selectExpr("bucket", f"transform(sequence(0L, {(1 << ROW_BITS) // 64 - 1}L), w -> coalesce(m[w], 0L)) as bits")


def passing(index: DataFrame, kept: DataFrame) -> DataFrame:
    """The postings whose rows pass a filter of at most 2**(FILTER_BITS - ROW_BITS) rows."""
    placed = index.withColumn("p", F.expr(f"pmod(xxhash64(doc_id, text_key), {1 << FILTER_BITS})")).withColumn("bucket", F.expr(f"p div {1 << ROW_BITS}"))
    held = f"shiftrightunsigned(get(bits, cast(p % {1 << ROW_BITS} div 64 as int)), cast(p % 64 as int)) & 1 = 1"
    return placed.join(F.broadcast(kept), "bucket").where(held).select(*index.columns)


def exact(postings: Postings, items: DataFrame, met: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, positions): the document positions that windows of an item cover, diagonal by diagonal."""
    near = met.where("apart is null or apart = 0").select(*ROW, "key", "diag").distinct().checkpoint()
    known = items.select("key", "item_id", "width", F.size("words").alias("n"))
    names = F.broadcast(known) if small_enough(known) else known
    ones = near.join(names, "key").where("n = 1").selectExpr(*ROW, "item_id", "array(diag) as positions")
    places = items.selectExpr("key", "posexplode(words) as (place, word)")
    expected = near.join(F.broadcast(places) if small_enough(places) else places, "key").selectExpr(*ROW, "key", "diag", "place", "word", "diag + place as pos").where("pos >= 0")
    some = passing(postings.index, rows_filter(near.select(*ROW)))
    meet = same_row("e", "i") & F.expr("e.word = i.word and e.pos = i.pos")
    held = expected.alias("e").join(some.alias("i"), meet, "left_semi")
    runs = held.groupBy(*ROW, "key", "diag").agg(F.array_sort(F.collect_set("place")).alias("p")).join(names, "key").where("n > 1")
    starts = runs.withColumn("starts", F.expr("filter(p, (x, i) -> coalesce(get(p, i + width - 1) = x + width - 1, false))")).where("size(starts) > 0")
    return ones.unionByName(starts.selectExpr(*ROW, "item_id", "array_distinct(flatten(transform(starts, s -> sequence(s + diag, s + diag + width - 1)))) as positions"))


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Every row's doc_id, n_words, n_hit, item_ids and near_ids (sorted as strings), and contaminated.

    near_ids are the items that have a window whose two rarest words stand within ``slack`` words of their distance.
    """
    items = item_table(benchmark, window).checkpoint()
    postings = open_index(docs.select("doc_id", "text"), items)
    wanted = look_ups(items, postings.frequency).checkpoint()
    met = stored(meetings(postings, wanted, slack), "meetings")
    hits = stored(exact(postings, items, met), "hits")
    covered = hits.select(*ROW, F.explode("positions").alias("pos")).distinct().groupBy(*ROW).agg(F.count("*").alias("n_hit"))
    ids = lambda df: df.groupBy(*ROW).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    named = items.select("key", "item_id")
    close = met.where("apart is not null").select(*ROW, "key").distinct().join(F.broadcast(named) if small_enough(named) else named, "key")
    rows = postings.index.where("word = ''").select(*ROW, F.col("pos").cast("bigint").alias("n_words"))
    for name, found in (("covered", covered), ("found", ids(hits)), ("close", ids(close))):
        rows = rows.alias("r").join(found.alias(name), same_row("r", name), "left").select("r.*", *(F.col(f"{name}.{c}").alias(f"{name}_{c}") for c in found.columns[2:]))
    none = F.array().cast("array<string>")
    made = rows.select("doc_id", "n_words", F.coalesce("covered_n_hit", F.lit(0)).alias("n_hit"), F.coalesce("found_ids", none).alias("item_ids"), F.coalesce("close_ids", none).alias("near_ids"))
    return made.withColumn("contaminated", F.col("n_hit") > 0)


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slack: int = SLACK, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, pos, apart): the two rarest words of a window of an item, which begins at pos of the text, stand ``apart`` words off their distance."""
    items = item_table(benchmark, window).checkpoint()
    postings = open_index(docs.select("doc_id", "text"), items)
    met = meetings(postings, look_ups(items, postings.frequency).checkpoint(), slack).where("apart is not null")
    return met.join(items.select("key", "item_id"), "key").select("doc_id", "item_id", F.col("diag").alias("pos"), "apart").distinct()


def contaminated_ids(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The doc_ids of rows that hold a window of the benchmark."""
    return find_passages(docs, benchmark).where("contaminated").select("doc_id").distinct()
