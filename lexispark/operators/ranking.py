"""An inverted index as tables, and BM25 search over it for many queries at once.

A stored index is cut by sections: SPAN sections that are read one after the other make a run, whose postings
are one row, so building it moves only counts of terms. Queries come to the runs in parts, and a task scores all terms of
a section and keeps the k best of each query. What its terms can add at most bounds
the scores of a run: the runs of the highest bounds are scored first, and then only those whose bound reaches the k-th best
score. Nothing that can be among the k best is left, so the result equals that of all postings.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V
from lexispark.sources.corpus import corpus_key
from lexispark.sources.work import bounded_batches, kept, work_folder

#: Sections of a run; runs that are scored to get a first k-th best.
SPAN, FIRST = 64, 8
#: Characters of the queries of a part; cells that a task's parts hold in all; bytes of a group of stored runs.
PART, CELLS, GROUP = 1 << 16, 1 << 22, 8 << 20
#: Scores are rounded to 6 digits; a score or bound that is as near as that to the k-th best still counts.
NEAR = 2e-6


@dataclass
class SearchIndex:
    """postings (source, doc_id, dl, term, tf), terms (term, df) and one row of n_docs and avg_dl.

    A stored index also has runs: sources, doc_ids and dls of the sections, the distinct terms, and for each posting
    the places of its term and section (of, at) and its tf; and blocks (term, run), the terms of each run.
    """

    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    blocks: DataFrame | None = None
    runs: DataFrame | None = None


def build_index(sections: DataFrame) -> SearchIndex:
    """From sections with source, doc_id, text and n_words; short ones are not indexed."""
    counted = sections.where(F.col("n_words") >= V.INDEX_MIN_WORDS).select("source", "doc_id", X.tokens(F.col("text")).alias("tokens"))
    sized = counted.select("source", "doc_id", F.size("tokens").alias("dl"), "tokens")
    terms = sized.select("source", "doc_id", "dl", F.explode("tokens").alias("term")).groupBy("source", "doc_id", "dl", "term").agg(F.count("*").alias("tf"))
    stats = sized.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avg_dl"))
    return SearchIndex(terms, terms.groupBy("term").agg(F.count("*").alias("df")), stats)


def gain(tf: Column, dl: Column) -> Column:
    """What a term adds to a score, without its weight."""
    return tf * (V.K1 + 1) / (tf + V.K1 * (1 - V.B + V.B * dl / F.col("avg_dl")))


def stored_index(sections: DataFrame, folder: str) -> SearchIndex:
    """The index written once as tables under a folder and read again, for many searches.

    Terms are counted in the task that reads their section, and postings stay there.
    """
    spark = sections.sparkSession
    bounded_batches(spark)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("parquet.block.size", GROUP).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    read = sections.where(F.col("n_words") >= V.INDEX_MIN_WORDS).select("source", "doc_id", X.tokens(F.col("text")).alias("tokens"))
    kinds = dict(read.dtypes)
    runs = written(read.mapInArrow(_runs_of(SPAN), f"run long, sources array<{kinds['source']}>, doc_ids array<{kinds['doc_id']}>, dls array<int>, terms array<string>, of array<int>, at array<int>, tfs array<int>"), "runs")
    stats = written(runs.agg(F.sum(F.size("dls")).alias("n_docs"), F.sum(F.aggregate("dls", F.lit(0).cast("long"), lambda acc, x: acc + x)).alias("length")).select(F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"), (F.coalesce("length", F.lit(0)) / F.nullif("n_docs", F.lit(0))).alias("avg_dl")), "stats")
    listed = runs.select(F.explode(F.transform("of", lambda i: F.get("terms", i))).alias("term"))
    terms = written(listed.groupBy("term").agg(F.count("*").alias("df")), "terms")
    posting = lambda x: F.struct(*(F.get(c, x["at"]).alias(n) for c, n in (("sources", "source"), ("doc_ids", "doc_id"), ("dls", "dl"))), F.get("terms", x["of"]).alias("term"), x["tfs"].cast("long").alias("tf"))
    postings = runs.select(F.explode(F.transform(F.arrays_zip("of", "at", "tfs"), posting)).alias("x")).select("x.*")
    return SearchIndex(postings, terms, stats, runs.select(F.explode("terms").alias("term"), "run"), runs)


def _runs_of(span: int):
    """A function that makes rows of runs from batches of sections with their tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []
        kinds: list[pa.DataType] = []

        def made() -> pa.RecordBatch:
            places: dict[str, list[tuple[int, int]]] = {}
            for i, (_, _, tokens) in enumerate(held):
                for term, tf in Counter(tokens).items():
                    places.setdefault(term, []).append((i, tf))
            of = np.repeat(np.arange(len(places)), [len(x) for x in places.values()])
            at, tfs = np.array([x for y in places.values() for x in y], np.int32).reshape(-1, 2).T
            row = ([x[0] for x in held], [x[1] for x in held], [len(x[2]) for x in held], list(places), of, at, tfs)
            types = (*kinds, pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t)) for x, t in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), *columns], ["run", "sources", "doc_ids", "dls", "terms", "of", "at", "tfs"])

        for batch in batches:
            kinds = [batch.schema.field(c).type for c in ("source", "doc_id")]
            for row in zip(*(batch.column(c).to_pylist() for c in ("source", "doc_id", "tokens")), strict=True):
                held.append(row)
                if len(held) == span:
                    yield made()
                    held, n = [], n + 1
        if held:
            yield made()

    return run


_indexes: dict[tuple, SearchIndex] = {}


def corpus_index(spark: SparkSession, path: str, sections) -> SearchIndex:
    """The stored index of the corpus in the files of ``path``: built from ``sections()`` at first, and again when the files have changed."""
    key = (spark.sparkContext.applicationId, *corpus_key(spark, path))
    if key not in _indexes:
        for old in [k for k in _indexes if k[:2] == key[:2]]:
            del _indexes[old]
        _indexes[key] = stored_index(sections(), work_folder(spark, "index"))
    return _indexes[key]


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term, weight) from (query_id, terms); a repeated term weighs double."""
    return queries.select("query_id", F.explode("terms").alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("weight"))


def _asked(index: SearchIndex, queries: DataFrame) -> DataFrame:
    """(query_id, term, avg_dl, w): the terms that the index has, with their weight in scores."""
    rows = query_terms(queries).join(index.terms, "term").join(F.broadcast(index.stats))  # one row of statistics
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    return rows.select("query_id", "term", "avg_dl", (F.col("weight") * idf).alias("w"))


def _scored(posted: DataFrame) -> DataFrame:
    part = F.col("w") * gain(F.col("tf"), F.col("dl"))
    return posted.groupBy("query_id", "source", "doc_id").agg(F.round(F.sum(part), 6).alias("score")).where("score > 0")


def _ranked(scored: DataFrame, k: int | None) -> DataFrame:
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "source", "doc_id")))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def search(index: SearchIndex, queries: DataFrame, k: int | None = 10, source: str | None = None) -> DataFrame:
    """(query_id, rank, source, doc_id, score) of the k best sections of each query; all with k None.

    A source filter narrows the sections, not the statistics, as document frequencies are the corpus's.
    """
    if k is not None and index.blocks is not None:
        return search_blocks(index, queries, k, source)
    posted = index.postings if source is None else index.postings.where(F.col("source") == source)
    return _ranked(_scored(posted.join(_asked(index, queries), "term")), k)


def _parts(asked: DataFrame, least: DataFrame | None = None) -> DataFrame:
    """(part, avg_dl, asked), a stored table: the terms and weights of each query, in parts of about PART characters, and the score that counts at least."""
    by_query = asked.groupBy("query_id").agg(F.first("avg_dl").alias("avg_dl"), F.collect_list("term").alias("terms"), F.collect_list("w").alias("ws"))
    rows = by_query.withColumn("least", F.lit(0.0)) if least is None else by_query.join(least, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    sizes = asked.agg(F.greatest(F.ceil(F.sum(F.length("term") + 16) / PART), F.lit(1)).alias("parts"))  # one row
    dealt = rows.join(F.broadcast(sizes)).withColumn("part", F.pmod(F.xxhash64("query_id"), "parts"))
    return kept(dealt.groupBy("part").agg(F.first("avg_dl").alias("avg_dl"), F.collect_list(F.struct("query_id", "least", "terms", "ws")).alias("asked")), "parts")


class _Queries:
    """The queries of a part as a matrix of their weights."""

    def __init__(self, rows: pa.StructArray, avg_dl: float):
        lists, weights = rows.field("terms"), rows.field("ws")
        self.ids, self.least, self.avg_dl = rows.field("query_id"), rows.field("least").to_numpy(), avg_dl
        sizes = pc.list_value_length(lists).to_numpy()
        coded = lists.flatten().dictionary_encode()
        self.terms = coded.dictionary
        self.w = np.zeros((len(self.terms), len(rows)))
        self.w[coded.indices.to_numpy(), np.repeat(np.arange(len(rows)), sizes)] = weights.flatten().to_numpy()

    def gains(self, run: dict[str, pa.Array], source) -> tuple[np.ndarray, np.ndarray]:
        """The weights of the terms that a run has, and what each of them adds to its sections."""
        known = pc.fill_null(pc.index_in(run["terms"], value_set=self.terms), -1).to_numpy()
        of, at, tf, dl = (run[c].to_numpy() for c in ("of", "at", "tfs", "dls"))
        term = known[of]
        good = term >= 0
        if source is not None:
            good &= pc.fill_null(pc.equal(run["sources"], source), False).to_numpy(zero_copy_only=False)[at]
        at, tf = at[good], tf[good]
        held, row = np.unique(term[good], return_inverse=True)
        grid = np.zeros((len(held), len(dl)))
        grid[row, at] = tf * (V.K1 + 1) / (tf + V.K1 * (1 - V.B + V.B * dl[at] / self.avg_dl))
        return self.w[held].T, grid


def _met(batches: Iterator[pa.RecordBatch], source) -> Iterator[tuple[pa.RecordBatch, int, _Queries, np.ndarray, np.ndarray]]:
    """Each run with each part of the queries, and the weights and gains of the terms that both have."""
    parts: dict[int, _Queries] = {}
    for batch in batches:
        for i, (part, avg_dl) in enumerate(zip(batch.column("part").to_pylist(), batch.column("avg_dl").to_pylist(), strict=True)):
            if part not in parts:
                parts[part] = _Queries(batch.column("asked")[i].values, avg_dl)
                while len(parts) > 1 and sum(p.w.size for p in parts.values()) > CELLS:
                    del parts[next(iter(parts))]
            weights, grid = parts[part].gains({c: batch.column(c)[i].values for c in ("sources", "dls", "terms", "of", "at", "tfs")}, source)
            if len(grid):
                yield batch, i, parts[part], weights, grid


def _bounds_of(source):
    """A function that makes (query_id, run, bound): the most that a section of a run can score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, part, weights, grid in _met(batches, source):
            bound = weights @ grid.max(1)
            some = np.flatnonzero(bound > 0)
            yield pa.RecordBatch.from_arrays([part.ids.take(pa.array(some)), pa.array(np.full(len(some), batch.column("run")[i].as_py()), pa.int64()), pa.array(bound[some])], ["query_id", "run", "bound"])

    return run


def _scores_of(k: int, source):
    """A function that makes (query_id, source, doc_id, score), the k best of a task's sections for each query, from runs and parts.

    Runs have queries, those that are asked of them, where not all are. Scores are not rounded yet, but the k best are chosen by the rounded ones, by source and doc_id among equals.
    """
    digits = Decimal("0.000001")
    key = lambda x: (x is not None, x.encode() if isinstance(x, str) else x or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        kinds = None
        for batch, i, part, weights, grid in _met(batches, source):
            kinds = kinds or [part.ids.type, *(batch.schema.field(c).type.value_type for c in ("sources", "doc_ids")), pa.float64()]
            least = np.array([max(x, float(-best[q][-1][0]) if len(best.get(q, ())) == k else 0.0) for q, x in zip(part.ids.to_pylist(), part.least.tolist(), strict=True)])
            alive = weights @ grid.max(1) >= least - NEAR
            if "queries" in batch.schema.names:
                alive &= pc.is_in(part.ids, value_set=batch.column("queries")[i].values).to_numpy(zero_copy_only=False)
            some = np.flatnonzero(alive)
            scores = weights[some] @ grid
            rows, at = np.nonzero((scores > 0) & (scores >= least[some, None] - NEAR))
            if len(rows):
                sources, docs = (batch.column(c)[i].values for c in ("sources", "doc_ids"))
                ids = part.ids.to_pylist()
                for q, d, score in zip(some[rows].tolist(), at.tolist(), scores[rows, at].tolist(), strict=True):
                    own = best.setdefault(ids[q], [])
                    rounded = Decimal(repr(score)).quantize(digits, ROUND_HALF_UP)
                    if len(own) < k or -rounded <= own[-1][0]:
                        name, doc = sources[d].as_py(), docs[d].as_py()
                        insort(own, (-rounded, key(name), key(doc), name, doc, score), key=lambda x: x[:3])
                        del own[k:]
        if best:
            rows = [(q, x[3], x[4], x[5]) for q, own in best.items() for x in own]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], ["query_id", "source", "doc_id", "score"])

    return run


def search_blocks(index: SearchIndex, queries: DataFrame, k: int, source: str | None = None) -> DataFrame:
    """As ``search``, from the runs of sections that can hold one of the k best."""
    bounded_batches(queries.sparkSession)
    asked = kept(_asked(index, queries), "asked")
    parts = _parts(asked)
    kinds = {c: dict([*asked.dtypes, *index.postings.dtypes])[c] for c in ("query_id", "source", "doc_id")}
    bounds = kept(index.runs.crossJoin(parts).mapInArrow(_bounds_of(source), f"query_id {kinds['query_id']}, run long, bound double"), "bounds")
    first = bounds.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "run"))).where(F.col("n") <= FIRST)
    # The terms of the first runs of each query, which give a k-th best score.
    wanted = kept(asked.join(first.select("query_id", "run"), "query_id"), "wanted")
    chosen = kept(wanted.groupBy("run").agg(F.collect_set("query_id").alias("queries")), "chosen")

    def best(runs: DataFrame, parts: DataFrame) -> DataFrame:
        made = runs.crossJoin(parts).mapInArrow(_scores_of(k, source), ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", score double")
        return _ranked(made.withColumn("score", F.round("score", 6)).where("score > 0"), k)

    least = best(index.runs.join(chosen, "run"), parts).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    return best(index.runs, _parts(asked, least)).select("query_id", "rank", "source", "doc_id", "score")
