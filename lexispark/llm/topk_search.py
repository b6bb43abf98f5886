"""Exact top-k by inner product over whole-number vectors, by MaxScore.

A component is a term, and a vector's weight in it a posting. The index is a stored table of
shards of at most SHARD vectors, each with its postings by term and every term's largest and
smallest weight, which bound what the term can add to any score. Queries are packed into blocks;
each block meets each shard once, dealt by both, so that neither passes through one task.

For a query, a shard's terms are put in order of their bounds. Terms at the end whose bounds
together stay under the k-th best score so far are non-essential: a vector that only they speak
for cannot win. The postings of the essential terms are traversed and added up, a group of
terms at a time, and vectors whose sum and the bounds of all terms to come stay under the k-th
best are left; the non-essential terms are probed for the others, as long as they compete. The
best of each shard are merged by a window. Nothing that equals the k-th best is left, so ties
are decided exactly.

Vectors that are null or hold null, NaN or infinite components (also after scaling) take no
part. Where lengths differ, missing components count as zero. A row whose vec_id equals the
query's is the query's own and no candidate; each of several query rows with one vec_id gets its
own k rows. Candidates without vec_id take part and come last among ties. Scores that 64
bits cannot hold are returned as null, in their true order. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.centroid_clustering import LONG, finite
from lexispark.llm.shared import stored

#: Vectors of a shard, queries of a block, and components of either that are held at once.
SHARD, BLOCK, MOST = 8192, 8192, 1 << 20
#: Vectors that are scored whole to get a first k-th best, and terms that are added up between two cuts.
START, GROUP = 256, 8

PACKED = "part int, piece int, ids array<long>, width int, kind string, weights binary"


def pack(scale: int, most: int):
    """Rows (vec_id, embedding) as packed rows of ``most`` vectors at most: weights by term, each term's in the order of ids."""

    def packed(part: int, piece: int, rows: list[tuple]) -> pa.RecordBatch:
        width = max(len(v) for _, v in rows)
        weights = np.zeros((width, len(rows)))
        for i, (_, v) in enumerate(rows):
            weights[: len(v), i] = np.floor(v * scale)
        largest = np.abs(weights).max(initial=0)
        kind = "i2" if largest < 1 << 15 else "i4" if largest < 1 << 31 else "f8"
        columns = [pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([[i for i, _ in rows]], pa.list_(pa.int64())), pa.array([width], pa.int32()), pa.array([kind]), pa.array([weights.astype(kind).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["part", "piece", "ids", "width", "kind", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, piece, rows, width = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            column = batch.column("embedding")
            values, borders = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum([0, *column.value_lengths().to_pylist()])
            for i, key in enumerate(batch.column("vec_id").to_pylist()):
                v = values[borders[i] : borders[i + 1]]
                if rows and (len(rows) >= most or max(width, len(v)) * (len(rows) + 1) > MOST):
                    yield packed(part, piece, rows)
                    piece, rows, width = piece + 1, [], 0
                rows.append((key, v))
                width = max(width, len(v))
        if rows:
            yield packed(part, piece, rows)

    return run


def unpacked(row: dict) -> np.ndarray:
    return np.frombuffer(row["weights"], row["kind"]).astype(np.float64).reshape(row["width"], len(row["ids"]))


class Shard:
    """Postings by term, with bounds; ids for ties."""

    def __init__(self, weights: np.ndarray, ids: list):
        self.weights, self.n = weights, weights.shape[1]
        self.none = np.array([x is None for x in ids], bool)
        self.ids = np.array([0 if x is None else x for x in ids], np.int64)
        self.high, self.low = (weights.max(axis=1, initial=-np.inf), weights.min(axis=1, initial=np.inf)) if self.n else (np.zeros(len(weights)),) * 2
        self.size = np.abs(weights).max(initial=0)
        self.read = 0

    def scores(self, query: np.ndarray, places) -> np.ndarray:
        """Exact scores of vectors by all terms: float64 where that is exact, Python's whole numbers else."""
        weights = self.weights[: len(query), places]
        query = query[: len(weights)]
        if self.size * np.abs(query).max(initial=0) * max(1, len(query)) < 1 << 53:
            return query @ weights
        ints = np.frompyfunc(int, 1, 1)
        return (ints(weights) * ints(query)[:, None]).sum(axis=0) if len(query) else np.zeros(weights.shape[1])

    def others(self, own) -> np.ndarray:
        return self.none | (self.ids != own) if own is not None else np.ones(self.n, bool)

    def best(self, query: np.ndarray, own, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the shard's k best for a query, among those that reach ``floor``."""
        query = query[: len(self.weights)]
        allowed = self.others(own)
        if self.size * np.abs(query).max(initial=0) * max(1, len(query)) >= 1 << 53:
            places = np.flatnonzero(allowed)
            return self.top(places, self.scores(query, places), k)
        head = np.flatnonzero(allowed[:START])
        if len(head) >= k:
            self.read += len(head) * len(query)
            floor = max(floor, np.partition(self.scores(query, head), len(head) - k)[len(head) - k])
        bounds = np.maximum(query * self.high[: len(query)], query * self.low[: len(query)])
        order = np.argsort(-bounds, kind="stable")
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0.0)  # what terms from here on can add
        if rest[0] < floor:
            return self.top(np.zeros(0, np.int64), np.zeros(0), k)
        # From this place on, terms are not essential: all of them together stay under the floor.
        essential = min(len(order), int(np.flatnonzero(rest >= floor)[-1]) + 1)
        steps = [*range(0, essential, GROUP), *range(essential, len(order), GROUP), len(order)]
        places, total, all_places = np.arange(self.n), np.zeros(self.n), True
        for a, b in zip(steps, steps[1:], strict=False):
            terms = order[a:b]
            total = total + query[terms] @ (self.weights[terms] if all_places else self.weights[np.ix_(terms, places)])
            self.read += len(terms) * len(places)
            keep = total + rest[b] >= floor
            if (kept := np.count_nonzero(keep)) < 0.7 * len(places):
                places, total, all_places = places[keep], total[keep], False
            if not kept:
                break
        good = allowed[places] & (total >= floor)
        return self.top(places[good], total[good], k)

    def top(self, places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(places) > 4 * k:  # ties with the k-th stay
            least = np.sort(scores)[len(scores) - k]
            places, scores = places[scores >= least], scores[scores >= least]
        rank = sorted(range(len(places)), key=lambda i: (-scores[i], self.none[places[i]], self.ids[places[i]]))[:k]
        return places[rank], scores[rank]


def searcher(k: int):
    """Rows of a shard and a block of queries to the shard's best of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floors = None, np.zeros(0)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                shard, asked = Shard(unpacked(row), row["ids"]), unpacked({"weights": row["q_weights"], "kind": row["q_kind"], "width": row["q_width"], "ids": row["q_ids"]}).T.copy()
                if block != (row["block"], row["q_piece"]):
                    block, floors = (row["block"], row["q_piece"]), np.full(len(asked), -np.inf)
                slots, ids, scores = [], [], []
                for slot, own in enumerate(row["q_ids"]):
                    places, found = shard.best(asked[slot], own, k, floors[slot])
                    if len(found) == k and found.dtype != object:  # this task has given k that are as good
                        floors[slot] = max(floors[slot], found[-1])
                    slots += [slot] * len(places)
                    ids += [None if shard.none[p] else int(shard.ids[p]) for p in places]
                    scores += [str(int(s)) for s in found]
                columns = [pa.array([row["block"]] * len(slots), pa.int32()), pa.array([row["q_piece"]] * len(slots), pa.int32()), pa.array(slots, pa.int32()), pa.array([row["q_ids"][s] for s in slots], pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "piece", "slot", "query_id", "vec_id", "score"])

    return run


@dataclass
class Packed:
    """A stored table of packed rows, and the number of parts they were dealt to."""

    rows: DataFrame
    parts: int


def packed_table(rows: DataFrame, scale: int, most: int, name: str) -> Packed:
    """The rows dealt out evenly, packed and written once, so that a lost task cannot pack them anew in another order."""
    parts = max(1, -(-rows.count() // most))
    return Packed(stored(rows.repartition(parts).mapInArrow(pack(scale, most), PACKED), name), parts)


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(finite(None, scale))


def build_shards(vectors: DataFrame, scale: int = 256) -> Packed:
    """The index: a stored table of shards of vectors (vec_id, embedding)."""
    return packed_table(usable(vectors, scale), scale, SHARD, "vector-shards")


def top_by_product(index: Packed, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best of ``build_shards`` for each query (vec_id, embedding)."""
    blocks = packed_table(usable(queries, scale), scale, BLOCK, "query-blocks")
    deal = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = blocks.rows.select(F.col("part").alias("block"), deal(index.parts).alias("shard"), *(F.col(c).alias(f"q_{c}") for c in ("piece", "ids", "width", "kind", "weights")))
    shards = index.rows.select(F.col("part").alias("shard"), deal(blocks.parts).alias("block"), "ids", "width", "kind", "weights")
    # Merged, as each side has every row as often as the other has parts, of which Spark's sizes know nothing: it would broadcast them.
    found = shards.hint("merge").join(asked, ["block", "shard"]).mapInArrow(searcher(k), "block int, piece int, slot int, query_id long, vec_id long, score string")
    score = F.col("score").cast("decimal(38,0)")
    order = Window.partitionBy("block", "piece", "slot").orderBy(score.desc(), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.when(F.abs(score) <= LONG, score.cast("long")).alias("score"))
