"""Excerpts that a model named or copied loosely, tied back to the documents' own text."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V

PASSAGES = "array<struct<passage: string, source_documents: array<string>, chapter: string>>"
#: Least characters of a common run; places of a text that are hashed together.
SEED, CHUNK = 20, 1 << 20
LIST_MARK = re.compile(V.LIST_MARK)


def context_rows(rows: DataFrame) -> DataFrame:
    """(filename, content, type) of loose rows that may have filename, content, text and type; rows without a text are left out."""
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    content = F.coalesce(has("content"), has("text"))
    return rows.select(F.coalesce(has("filename"), F.lit("unknown")).alias("filename"), content.alias("content"), F.coalesce(has("type"), F.lit("text")).alias("type")).where("content is not null")


def text_slice(documents: DataFrame, start: Column, end: Column) -> DataFrame:
    """(doc_id, slice): the characters start..end of each text, counted from 0."""
    return documents.select("doc_id", F.substring(F.col("text"), start + 1, F.greatest(end - start, F.lit(0))).alias("slice"))


def json_array(text: Column) -> Column:
    """The JSON array of an answer as text: the whole, or what stands between the outer brackets; null else."""
    array = lambda t: F.when(F.schema_of_variant(F.try_parse_json(t)).startswith("ARRAY"), t)
    return F.coalesce(array(X.strip(text)), array(F.regexp_extract(text, r"(?s)\[.*\]", 0)))


def named_passages(answers: DataFrame, known: DataFrame) -> DataFrame:
    """(row_id, pos, passage, sources, chapter) of answers (row_id, raw) that list passages of known documents (source).

    Passages under 80 characters, tables of contents and those without a known source are left
    out. Names are compared as base names in small letters; long passages end with a sentence.
    """
    listed = answers.select("row_id", F.posexplode(F.from_json(json_array(F.col("raw")), PASSAGES)).alias("pos", "x")).where("x is not null")
    rows = listed.select("row_id", "pos", X.strip(F.col("x.passage")).alias("passage"), F.col("x.source_documents").alias("named"), F.coalesce("x.chapter", F.lit("N/A")).alias("chapter"))
    good = rows.where((F.length("passage") >= V.LEAST_EXCERPT) & ~X.is_contents_table(F.col("passage")))
    names = known.select("source", X.basename(F.col("source")).alias("name")).distinct()
    named = good.select("row_id", "pos", F.posexplode("named").alias("nth", "file")).select("row_id", "pos", "nth", X.basename(F.col("file")).alias("name"))
    held = named.join(names, "name").groupBy("row_id", "pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "source"))), lambda s: s["source"]).alias("sources"))
    return good.join(held, ["row_id", "pos"]).select("row_id", "pos", X.truncated(F.col("passage"), V.LIST_PASSAGE, ".").alias("passage"), "sources", "chapter")


def question_sources(questions: DataFrame, documents: DataFrame) -> DataFrame:
    """(id, doc_id, pos): the documents (doc_id, filename) that each question names, by base name in small letters."""
    named = questions.select("id", F.posexplode("source_documents").alias("pos", "file")).withColumn("name", X.basename(F.col("file")))
    return named.join(documents.select("doc_id", X.basename(F.col("filename")).alias("name")), "name").select("id", "doc_id", "pos")


def paragraph_around(text: str, start: int, end: int, reach: int = 500) -> str:
    """text[start:end] grown to the blank lines around it, on through those that a list goes on behind, at most ``reach`` further."""
    head = text[max(0, start - reach) : start]
    for mark in ("\n\n", "\n"):
        if mark in head:
            start += head.rindex(mark) + len(mark) - len(head)
            break
    limit = min(len(text), end + reach)
    while end < limit:
        gap = text.find("\n\n", end, limit)
        if gap < 0:
            end = limit
        elif LIST_MARK.match(text[gap + 2 : gap + 22]):
            end = gap + 2
            continue
        else:
            end = gap
        break
    return text[start:end].strip()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def seeds(text: str) -> np.ndarray:
    """64-bit hashes of the SEED characters from each place of a text."""
    codes = code_points(text).astype(np.uint64)
    n = len(codes) - SEED + 1
    hashes = np.zeros(max(n, 0), np.uint64)
    for i in range(SEED if n > 0 else 0):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n] + np.uint64(1)
    return hashes ^ (hashes >> np.uint64(29))


def common_runs(a: str, b: str, shifts: np.ndarray) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the longest common runs of SEED characters or more of two texts, with one of the ``shifts`` between them."""
    first, second, found = code_points(a), code_points(b), []
    for shift in np.unique(shifts).tolist():
        low, high = max(0, -shift), min(len(first), len(second) - shift)
        if high - low >= SEED:
            edge = np.flatnonzero(np.diff(np.concatenate([[False], first[low:high] == second[low + shift : high + shift], [False]]).astype(np.int8)))
            start, end = edge[::2], edge[1::2]
            found += [(low + i, low + i + shift, j - i) for i, j in zip(start.tolist(), end.tolist(), strict=True) if j - i >= SEED]
    return found


def common_shifts(a: str, b: str) -> np.ndarray:
    """The shifts from a to b at which they have SEED characters in common; b may be long, and pairs of equal seeds many."""
    first = seeds(a)
    order = np.argsort(first, kind="stable")
    known, found = first[order], [np.zeros(0, np.int64)]
    for start in range(0, len(b) if len(first) else 0, CHUNK):
        hashes = seeds(b[start : start + CHUNK + SEED - 1])
        low = np.searchsorted(known, hashes, "left")
        n = np.searchsorted(known, hashes, "right") - low
        hits = np.flatnonzero(n)
        group = np.cumsum(n[hits]) // CHUNK
        for g in np.unique(group):
            at = hits[group == g]
            many = n[at]
            mine = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - low[at], many)]
            found.append(np.unique(np.repeat(at, many) + start - mine))
    return np.unique(np.concatenate(found))


def blocks(runs: list[tuple[int, int, int]], low: int, high: int, start: int, end: int) -> list[tuple[int, int, int]]:
    """The matching blocks of SEED characters or more of a[low:high] and b[start:end], given all common runs.

    The longest of them (the first in a, then in b), and the same of what lies before and behind it in both.
    """
    found, open_ = [], [(low, high, start, end)]
    while open_:
        low, high, start, end = open_.pop()
        best = (0, 0, 0)
        for a, b, n in runs:
            cut = max(low - a, start - b, 0)
            best = max(best, (min(n, high - a, end - b) - cut, -(a + cut), -(b + cut)))
        n, a, b = best[0], -best[1], -best[2]
        if n >= SEED:
            found.append((a, b, n))
            open_ += [(low, a, start, b), (a + n, high, b + n, end)]
    return found


def anchored(excerpt: str, text: str, least: int = 30) -> str | None:
    """The part of a text that an excerpt was copied from: from its first to its last matching block of SEED characters, grown to paragraphs."""
    found = blocks(common_runs(excerpt, text, common_shifts(excerpt, text)), 0, len(excerpt), 0, len(text))
    start, end = (min(b for _, b, _ in found), max(b + n for _, b, n in found)) if found else (0, 0)
    return paragraph_around(text, start, end) if end - start >= least else None
