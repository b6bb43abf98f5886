"""Excerpts found again in whole documents: the region that speaks of an excerpt, and the part it was copied from.

Both start from places in texts: of words, and of hashed seeds of characters. No excerpt is compared
with all of a text character by character. Excerpts meet texts in parts of some PART characters, so
a text is read once for many of them, and neither texts nor places of words move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.operators.excerpts import CHUNK, SEED, blocks, common_runs, common_shifts, paragraph_around, seeds
from lexispark.sources.work import bounded_batches, kept

#: Characters of the excerpts of a part; distinct words of texts that a part remembers; cells that a task's parts hold in all.
PART, WORDS, CELLS = 1 << 17, 1 << 13, 1 << 24
#: Windows that are counted together; rows of a batch.
SPAN, ROWS = 1024, 1 << 16


def parted(excerpts: DataFrame, by: str) -> DataFrame:
    """(part, by, asked), a stored table: the excerpts (item_id, by, text) of each value of ``by`` in parts; asked has item_id, words and text."""
    words = F.array_distinct(F.filter(F.split(X.normalised(F.coalesce("text", F.lit(""))), " "), lambda w: F.length(w) >= 4))
    rows = excerpts.where(F.col(by).isNotNull()).select("item_id", by, F.array_join(words, " ").alias("words"), "text")
    sized = rows.withColumn("size", F.length("words") + F.length(F.coalesce("text", F.lit(""))) + 64)
    dealt = sized.join(sized.groupBy(by).agg(F.ceil(F.sum("size") / PART).alias("parts")), by).withColumn("part", F.pmod(F.xxhash64("item_id", "words"), "parts"))
    whole = dealt.groupBy(by, "part").agg(F.collect_list(F.struct("item_id", "words", "text")).alias("asked"))
    return kept(whole.select(F.monotonically_increasing_id().alias("part"), by, "asked"), "asked")


class Asked:
    """The excerpts of a part, and which of them have which keyword."""

    def __init__(self, rows: pa.StructArray):
        self.ids, self.texts = rows.field("item_id"), rows.field("text").to_pylist()
        keys: dict[str, int] = {}
        lists = [[keys.setdefault(w, len(keys)) for w in x.split(" ") if w] for x in rows.field("words").to_pylist()]
        self.has = np.zeros((len(keys), len(lists)), np.float32)
        for i, x in enumerate(lists):
            self.has[x, i] = 1
        self.sizes, self.lengths = np.array([len(x) for x in lists], np.int64), np.array([len(w) for w in keys], np.int64)
        self.starts: dict[str, list[tuple[str, int]]] = {}
        for w, k in keys.items():
            self.starts.setdefault(w[:4], []).append((w, k))
        self.known: dict[str, tuple] = {}
        self.seeds: tuple[np.ndarray, np.ndarray] | None = None

    def inside(self, word: str) -> tuple:
        """(keyword, place in the word) of the keywords that a word holds."""
        found = self.known.get(word)
        if found is None:
            found = tuple((k, i) for i in range(len(word) - 3) for w, k in self.starts.get(word[i : i + 4], ()) if word.startswith(w, i))
            if len(self.known) < WORDS:
                self.known[word] = found
        return found

    def best_windows(self, text: str, window: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """The first window that holds most of each excerpt's keywords, and how many it holds."""
        low = text.lower()
        if len(low) != len(text):  # a few capitals have two small letters
            low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
        spots = [(k, m.start() + i) for m in re.finditer(r"\w{4,}", low) for k, i in self.inside(m[0])]
        keys, at = np.array(spots, np.int64).reshape(-1, 2).T
        n = max(len(text) - window, 0) // step + 1
        first, last = np.maximum(-((window - at - self.lengths[keys]) // step), 0), np.minimum(at // step, n - 1)
        best, most = np.zeros(len(self.sizes), np.int64), np.zeros(len(self.sizes), np.float32)
        for begin in range(0, n if len(keys) else 0, SPAN):
            a, b = np.maximum(first, begin), np.minimum(last, min(n, begin + SPAN) - 1)
            good = a <= b
            held, row = np.unique(keys[good], return_inverse=True)
            a, b = a[good] - begin, b[good] - begin
            grid = np.zeros((len(held), min(SPAN, n - begin)), np.float32)
            while len(a):
                grid[row, a] = 1
                more = a < b
                row, a, b = row[more], a[more] + 1, b[more]
            hits = self.has[held].T @ grid
            m = hits.argmax(1)
            top = hits[np.arange(len(m)), m]
            better = top > most
            best[better], most[better] = m[better] + begin, top[better]
        return best, most.astype(np.int64)

    def copied_from(self, text: str) -> set[int]:
        """The excerpts that have SEED characters in common with a text, by hashes of these; some may have none."""
        if self.seeds is None:
            own = [seeds(x or "") for x in self.texts]
            hashes, of = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
            order = np.lexsort((of, hashes))
            hashes, of = hashes[order], of[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1]))[: len(hashes)]
            self.seeds = hashes[new], of[new]
        hashes, of = self.seeds
        found: set[int] = set()
        for start in range(0, len(text) if len(hashes) else 0, CHUNK):
            here = seeds(text[start : start + CHUNK + SEED - 1])
            low = np.searchsorted(hashes, here)
            low = np.unique(low[hashes[np.minimum(low, len(hashes) - 1)] == here])
            for a, b in zip(low.tolist(), np.searchsorted(hashes, hashes[low], "right").tolist(), strict=True):
                found.update(of[a:b].tolist())
        return found


def met(excerpts: DataFrame, documents: DataFrame, by: str, window: int, step: int, region: int, least: int | None = None) -> DataFrame:
    """(item_id, doc_id, n, best_start, hits, region_start, region_end) of each excerpt and each text that agrees with it in ``by``; n counts an excerpt's words.

    With ``least`` also (start, end, found) of the part of that region that the excerpt was copied from, as ``anchored_excerpts`` has them.
    """
    bounded_batches(documents.sparkSession)
    texts = documents.where("text is not null").select(*dict.fromkeys((by, "doc_id", "text")))
    columns = ("n", "best_start", "hits", "region_start", "region_end")
    kinds = {"item_id": dict(excerpts.dtypes)["item_id"], "doc_id": dict(documents.dtypes)["doc_id"]} | dict.fromkeys(columns, "long")
    if least is not None:
        kinds |= {"start": "long", "end": "long", "found": "string"}

    def regions(asked: Asked, text: str) -> list[np.ndarray]:
        m, hits = asked.best_windows(text, window, step)
        start, size = m * step, len(text)
        middle = np.where(asked.sizes == 0, 0, (start + np.minimum(start + window, size)) // 2)
        end = np.minimum(np.maximum(middle - region // 2, 0) + region, size)
        return [asked.sizes, start, hits, np.maximum(end - region, 0), end]

    def anchors(asked: Asked, text: str, low: np.ndarray, high: np.ndarray) -> list[tuple]:
        near = asked.copied_from(text)
        return [anchor(x, text, int(low[i]), int(high[i]), least) if i in near else (None, None, None) for i, x in enumerate(asked.texts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, Asked] = {}
        for batch in batches:
            at, ids, found, copied, size = [], [], [], [], 0

            def made() -> pa.RecordBatch:
                docs = batch.column("doc_id").take(pa.array(np.repeat(at, [len(x) for x in ids]), pa.int64()))
                ends = [pa.array([x[i] for x in copied], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))] if least is not None else []
                return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), docs, *(pa.array(np.concatenate(x), pa.int64()) for x in zip(*found, strict=True)), *ends], list(kinds))

            for i, (part, text) in enumerate(zip(batch.column("part").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                if part not in parts:
                    parts[part] = Asked(batch.column("asked")[i].values)
                    while len(parts) > 1 and sum(p.has.size for p in parts.values()) > CELLS:
                        del parts[next(iter(parts))]
                at.append(i)
                ids.append(parts[part].ids)
                found.append(regions(parts[part], text))
                size += len(parts[part].ids)
                if least is not None:
                    own = anchors(parts[part], text, *found[-1][3:])
                    size += sum(len(x[2]) for x in own if x[2]) // 64
                    copied += own
                if size > ROWS:
                    yield made()
                    at, ids, found, copied, size = [], [], [], [], 0
            if at:
                yield made()

    return texts.join(parted(excerpts, by), by).select("doc_id", "text", "part", "asked").mapInArrow(run, ", ".join(f"{c} {k}" for c, k in kinds.items()))


def _score() -> Column:
    return F.round(F.col("hits") / F.greatest(F.col("n"), F.lit(1)), 6)


def excerpt_regions(excerpts: DataFrame, documents: DataFrame, window: int = 800, step: int = 200, region: int = 4000, by: str = "doc_id") -> DataFrame:
    """(item_id, doc_id, best_start, score, region_start, region_end) for excerpts (item_id, doc_id, text) and documents (doc_id, text), whole.

    Windows of ``window`` characters begin every ``step``; the best holds most of an excerpt's distinct
    words of four letters or more as substrings, the first of equals, the first of all where
    none holds any. A word's place lies in a few windows, so windows get their counts from places. The region is
    ``region`` characters around the best window, moved to lie in the text. With another column
    ``by`` that both have, an excerpt (item_id, by, text) meets all documents (by, doc_id, text) that agree in it.
    """
    return met(excerpts, documents, by, window, step, region).select("item_id", "doc_id", "best_start", _score().alias("score"), "region_start", "region_end")


def anchor(copied: str | None, text: str, low: int, high: int, least: int) -> tuple[int | None, int | None, str | None]:
    """(start, end, found) of the part of text[low:high] that an excerpt was copied from; found is grown to paragraphs."""
    copied = copied or ""
    found = blocks(common_runs(copied, text, common_shifts(copied, text)), 0, len(copied), low, high)
    start, end = (min(b for _, b, _ in found), max(b + n for _, b, n in found)) if found else (0, 0)
    return (start, end, paragraph_around(text[low:high], start - low, end - low)) if end - start >= least else (None, None, None)


def anchored_excerpts(excerpts: DataFrame, documents: DataFrame, regions: DataFrame | None = None, least: int = 30) -> DataFrame:
    """(item_id, doc_id, start, end, found): the part of a whole text that an excerpt (item_id, doc_id, excerpt) was copied from.

    From the first to the last of the matching blocks of SEED characters or more, ``least`` characters
    at least, and ``found`` grown to paragraphs; null without such a part. Excerpts meet their texts
    once, by doc_id; hashed seeds of both give the shifts between them, along which runs are
    compared. Matching blocks are
    the longest common run, then those of what lies before and behind it in both. With regions
    (item_id, doc_id, region_start, region_end), only these parts of the texts count. An item_id names one
    excerpt of a document, a doc_id one text; nulls hold nothing.
    """
    rows = excerpts.select("item_id", "doc_id", "excerpt")
    if regions is not None:
        rows = rows.join(regions.select("item_id", "doc_id", "region_start", "region_end"), ["item_id", "doc_id"], "left")
    else:
        rows = rows.withColumns({"region_start": F.lit(0).cast("long"), "region_end": F.lit(None).cast("long")})
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.select(["excerpt", "region_start", "region_end", "text"]).to_pylist():
                text = r["text"] or ""
                out.append(anchor(r["excerpt"], text, r["region_start"] or 0, len(text) if r["region_end"] is None else r["region_end"], least))
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("doc_id"), *columns], ["item_id", "doc_id", "start", "end", "found"])

    whole = rows.join(documents.select("doc_id", "text"), "doc_id")
    return whole.mapInArrow(run, f"item_id {kinds['item_id']}, doc_id {kinds['doc_id']}, start long, end long, found string")


def grounded_excerpts(excerpts: DataFrame, documents: DataFrame, by: str = "doc_id", window: int = 800, step: int = 200, region: int = 4000, least: int = 30) -> DataFrame:
    """(item_id, doc_id, score, start, end, found): each excerpt anchored in the region of the document that speaks of it; arguments as of ``excerpt_regions``."""
    return met(excerpts, documents, by, window, step, region, least).select("item_id", "doc_id", _score().alias("score"), "start", "end", "found")
