"""Phrases whose words stand together more often than their parts would have it.

Texts are dealt to tasks in shards of a bounded number of bytes. A shard gives every word a
bitmap of the positions where it stands; pieces of a text are a free position apart. Bitmaps
are compressed to their bytes that are not zero. A phrase is extended depth-first: its
bitmap, moved on by one position, is combined by AND with the bitmaps of the words that have a
bit in the same byte; what is left marks the phrase that is one word longer, and the number of its
bits is its count in the shard. Spark adds the counts of all shards, so a hot phrase is one row of a
task by then.

Words and phrases of two words are counted first. A longer phrase cannot be frequent unless the
phrases one word shorter inside it are, so each further length is a pass of its own, in which
phrases go on only through frequent ones. These are marked in a bit table of fixed size, the only thing
that is broadcast; hashes that meet there cost rows but do not change the result.

A text null or without words gives nothing; a null lang counts as ``und``. Repeated rows
all count. Long texts are cut into runs of words with the next words in view, so that memory follows neither
the length of a text nor the number of texts. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import LOWER, blocks, buffers, mix, prefix_sums, span_hash
from lexispark.llm.shared import ready, stored

#: Bytes of a shard; bitmap bytes that are extended at once; rows of a batch that goes out.
SHARD, GROUP, ROWS = 1 << 20, 1 << 14, 1 << 14
#: Bits of the table of frequent phrases, as a power of two: 16 MB.
TABLE = 27
#: What a byte is: of a word, between words (space, tab), between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
#: Odd factors of the words of a phrase in its hash.
FACTOR = [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(16)]

COUNTS = "lang string, size int, phrase string, f long"


@dataclass
class Run:
    """Bytes of whole texts, or of a part of one, with the language of each; words from byte ``own`` on are only looked at."""

    data: np.ndarray
    offsets: np.ndarray
    langs: pa.Array
    own: int


def _next(data: np.ndarray, at: int, word: bool) -> int:
    """The first place from ``at`` on that is (not) of a word, or the end."""
    step = 64
    while at < len(data):
        hit = (KIND[data[at : at + step]] == 0) == word
        if hit.any():
            return at + int(hit.argmax())
        at, step = at + step, min(step * 2, 1 << 20)
    return len(data)


def runs(batches: Iterator[pa.RecordBatch], most: int, ahead: int) -> Iterator[Run]:
    """Shards of about ``most`` bytes; a longer text is cut between words, each part with ``ahead`` words behind it."""
    for block in blocks(batches, most):
        langs = block.column("lang")
        if len(block) > 1 or len(block.data) <= 2 * most:
            yield Run(block.data, block.offsets, langs, len(block.data))
            continue
        start = 0
        while start < len(block.data):
            end = _next(block.data, min(start + most, len(block.data)), False)
            seen = end
            for _ in range(ahead):
                seen = _next(block.data, _next(block.data, seen, True), False)
            part = block.data[start:seen]
            yield Run(part, np.array([0, len(part)]), langs, end - start)
            start = end


@dataclass
class Bitmaps:
    """For ids in order: the places of bytes that are not zero, and these bytes."""

    ids: np.ndarray
    place: np.ndarray
    byte: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, chosen) -> Bitmaps:
        return Bitmaps(self.ids[chosen], self.place[chosen], self.byte[chosen])

    @classmethod
    def of(cls, ids: np.ndarray, positions: np.ndarray) -> Bitmaps:
        """From ascending positions."""
        order = np.argsort(ids, kind="stable")
        ids, positions = ids[order], positions[order]
        place = positions >> 3
        first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (place[1:] != place[:-1])) if len(ids) else np.zeros(0, bool))
        bits = np.left_shift(1, positions & 7).astype(np.uint8)
        return cls(ids[first], place[first], np.bitwise_or.reduceat(bits, first) if len(first) else bits)

    def moved(self) -> Bitmaps:
        """All bits one position on; the last bit of a byte goes to the next one."""
        over = np.flatnonzero(self.byte >> 7)
        return Bitmaps(np.concatenate([self.ids, self.ids[over]]), np.concatenate([self.place, self.place[over] + 1]), np.concatenate([self.byte << np.uint8(1), np.ones(len(over), np.uint8)]))


class Shard:
    """The words of a run, their bitmaps, and the same by place."""

    def __init__(self, run: Run):
        data, kind = LOWER[run.data], KIND[run.data]
        inside = kind == 0
        start, end = inside.copy(), inside.copy()
        start[1:] &= kind[:-1] != 0
        end[:-1] &= kind[1:] != 0
        borders = run.offsets[1:-1][run.offsets[1:-1] < len(data)]
        start[borders] = inside[borders]
        last = borders[borders > 0] - 1
        end[last] = inside[last]
        starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.n = int(np.searchsorted(starts, run.own))  # own words
        doc = np.searchsorted(run.offsets, starts, "right") - 1
        piece = np.cumsum(kind == 2)[starts] if len(starts) else starts
        apart = np.zeros(len(starts), np.int64)
        apart[1:] = (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])
        self.position = np.arange(len(starts)) + np.cumsum(apart)
        borders = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=borders[1:])
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(borders), pa.py_buffer(data[inside].tobytes())]).dictionary_encode()
        langs = run.langs.dictionary_encode()
        self.langs = langs.dictionary
        # A word of two languages is two words.
        of_doc = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both, self.word = np.unique(words.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(self.langs) + of_doc[doc], return_inverse=True)
        self.lang = both % max(1, len(self.langs))
        self.texts = words.dictionary.take(pa.array(both // max(1, len(self.langs))))
        self.all = Bitmaps.of(self.word, self.position)
        self.own = self.all if self.n == len(starts) else Bitmaps.of(self.word[: self.n], self.position[: self.n])
        self.by_place = np.argsort(self.all.place, kind="stable")
        self.first = np.searchsorted(self.all.place[self.by_place], np.arange((int(self.position[-1]) >> 3) + 3 if len(starts) else 2))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.word[: self.n], minlength=len(self.texts))

    def extended(self, prefix: Bitmaps, on: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, Bitmaps | None]:
        """Prefix id, word, count and, to go on, bitmaps of all phrases one word longer; bitmaps are numbered in the order of these."""
        moved = prefix.moved()
        begin, n = self.first[moved.place], np.diff(self.first)[moved.place]
        left = np.repeat(np.arange(len(moved)), n)
        right = self.by_place[np.arange(len(left)) - np.repeat(np.cumsum(n) - n - begin, n)]
        byte = moved.byte[left] & self.all.byte[right]
        met = np.flatnonzero(byte)
        left, right, byte = left[met], right[met], byte[met]
        key, number = np.unique(moved.ids[left] * len(self.texts) + self.all.ids[right], return_inverse=True)
        count = np.bincount(number, np.bitwise_count(byte), len(key)).astype(np.int64)
        first, word = key // max(1, len(self.texts)), key % max(1, len(self.texts))
        if not on:
            return first, word, count, None
        order = np.argsort(number, kind="stable")
        return first, word, count, Bitmaps(number[order], moved.place[left][order], byte[order])

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the words and, for each, of its language."""
        return hashed(self.texts), hashed(self.langs)[self.lang] if len(self.lang) else np.zeros(0, np.uint64)

    def rows(self, words: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts of phrases given as a matrix of words, a column for each place."""
        for i in range(0, len(count), ROWS):
            part = words[i : i + ROWS]
            text = pc.binary_join_element_wise(*(self.texts.take(pa.array(part[:, j])) for j in range(part.shape[1])), pa.scalar(" ", pa.large_string()))
            yield batch(self.langs.take(pa.array(self.lang[part[:, 0]])), part.shape[1], text, count[i : i + ROWS])


def batch(lang: pa.Array, size: int, text: pa.Array, count) -> pa.RecordBatch:
    columns = [lang.cast(pa.string()), pa.array(np.full(len(lang), size, np.int32)), text.cast(pa.string()), pa.array(count, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "f"])


def hashed(texts: pa.Array) -> np.ndarray:
    data, offsets, _ = buffers(texts)
    if not len(texts):
        return np.zeros(0, np.uint64)
    return span_hash(prefix_sums(data[offsets[0] : offsets[-1]]), offsets[:-1] - offsets[0], offsets[1:] - offsets[0])


def bit_of(word_hash: list[np.ndarray], lang_hash: np.ndarray) -> np.ndarray:
    """The places in the bit table of phrases, given the hashes of their first, second ... words."""
    total = lang_hash.copy()
    for h, factor in zip(word_hash, FACTOR, strict=False):
        total = total + h * np.uint64(factor)
    return (mix(total + np.uint64(len(word_hash))) >> np.uint64(64 - TABLE)).astype(np.int64)


def marked(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (table[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 > 0


def groups(prefix: Bitmaps) -> Iterator[Bitmaps]:
    """Runs of whole prefixes of about GROUP bytes, so that memory stays bounded while one is extended."""
    start = 0
    while start < len(prefix):
        end = min(start + GROUP, len(prefix))
        end = int(np.searchsorted(prefix.ids, prefix.ids[end - 1], "right"))
        yield prefix.part(slice(start, end))
        start = end


def short_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words (size 1), of phrases of two words, and of all words of a language (size 0) in each shard."""
    for run in runs(batches, SHARD, 1):
        shard = Shard(run)
        count = shard.word_counts()
        found = np.flatnonzero(count)
        yield from shard.rows(found[:, None], count[found])
        total = np.bincount(shard.lang, count, len(shard.langs)).astype(np.int64)
        yield batch(shard.langs, 0, pa.array([""] * len(shard.langs)), total)
        for part in groups(shard.own):
            first, word, count, _ = shard.extended(part, False)
            yield from shard.rows(np.stack([first, word], 1), count)


def longer_phrases(size: int, table):
    """Counts of phrases of ``size`` words, all of whose shorter parts are marked in the (broadcast) table."""

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value
        for run in runs(batches, SHARD, size - 1):
            shard = Shard(run)
            of_word, of_lang = shard.hashes()

            def frequent(words: np.ndarray) -> np.ndarray:
                return marked(bits, bit_of([of_word[words[:, j]] for j in range(words.shape[1])], of_lang[words[:, 0]]))

            def deepen(prefix: Bitmaps, words: np.ndarray) -> Iterator[pa.RecordBatch]:
                """prefix: bitmaps of the phrases of the matrix ``words``."""
                for part in groups(prefix):
                    last = words.shape[1] + 1 == size
                    at, word, count, found = shard.extended(part, not last)
                    longer = np.concatenate([words[at], word[:, None]], axis=1)
                    # The part before the last word led here; the one behind the first word is left to ask.
                    good = frequent(longer[:, 1:] if last else longer)
                    if last:
                        yield from shard.rows(longer[good], count[good])
                        continue
                    number = np.cumsum(good) - 1
                    kept = found.part(good[found.ids])
                    yield from deepen(Bitmaps(number[kept.ids], kept.place, kept.byte), longer[good])

            yield from deepen(shard.own, np.arange(len(shard.texts))[:, None])

    return run_


def bit_table(phrases: DataFrame) -> np.ndarray:
    """A table of fixed size in which the bits of phrases (lang, phrase) are set; Spark sets them in parts of 4 KB."""

    def bits(batches):
        for b in batches:
            data, offsets, _ = buffers(b.column("phrase"))
            if not b.num_rows:
                continue
            data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
            gaps = np.flatnonzero(data == 0x20)
            n = np.diff(np.searchsorted(gaps, offsets)) + 1
            sums, lang = prefix_sums(data), hashed(b.column("lang"))
            for size in np.unique(n):
                rows = np.flatnonzero(n == size)
                inner = gaps[np.searchsorted(gaps, offsets[rows])[:, None] + np.arange(size - 1)] if size > 1 else np.zeros((len(rows), 0), np.int64)
                starts, ends = np.column_stack([offsets[rows], inner + 1]), np.column_stack([inner, offsets[rows + 1]])
                made = bit_of([span_hash(sums, starts[:, j], ends[:, j]) for j in range(size)], lang[rows])
                yield pa.RecordBatch.from_arrays([pa.array(made + 1)], ["bit"])

    made = phrases.select("lang", "phrase").mapInArrow(bits, "bit long")
    parts = made.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    table = np.zeros(1 << (TABLE - 3), np.uint8)
    for row in parts:
        table[(row.part - 1) * 4096 : row.part * 4096] = np.frombuffer(row.bits, np.uint8)[: len(table)]
    return table


def summed(parts: DataFrame, least: int) -> DataFrame:
    return parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("size") == 0))


def count_phrases(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """(lang, size, phrase, f), a stored table: words and phrases of up to ``longest`` words found ``least`` times or more; size 0 counts all words of a lang."""
    spark = ready(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").alias("text")).where("text is not null")
    found = stored(summed(texts.mapInArrow(short_phrases, COUNTS), least), "phrases")
    for size in range(3, longest + 1):
        table = spark.sparkContext.broadcast(bit_table(found.where(F.col("size") > 1)))
        found = found.unionByName(stored(summed(texts.mapInArrow(longer_phrases(size, table), COUNTS), least), "phrases"))
    return found


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, percent: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of docs (lang, text).

    The score of a cut into two parts is floor(1000000 * a * a / (l * r)); a phrase has that of its worst cut, the first
    of several. Phrases go that a longer one contains with ``percent`` of their count or more.
    """
    counts = count_phrases(docs, longest, least)
    parts = counts.where(F.col("size").between(1, longest - 1)).select("lang", F.col("phrase").alias("part"), F.col("f").alias("n_part"))
    phrases = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    said = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = phrases.select("lang", "size", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "size", "phrase", "a", "k", said(F.lit(1), F.col("k")).alias("left"), said(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    rated = cuts.join(parts.select("lang", F.col("part").alias("left"), F.col("n_part").alias("l")), ["lang", "left"]).join(parts.select("lang", F.col("part").alias("right"), F.col("n_part").alias("r")), ["lang", "right"])
    # Products of 31 and 38 digits.
    score = F.expr("(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    worst = rated.select("*", score.cast("long").alias("score")).groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    covers = phrases.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    alone = worst.join(covers, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # One row for each language.
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
