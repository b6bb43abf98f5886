"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most vertices that are hubs; links up to which none is looked for.
HUBS, FEW = 500, 10_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.expr("cast(xxhash64(u, v) as decimal(20, 0))"))).first())


def _hubs(both: DataFrame, n: int) -> DataFrame:
    """(hub, least): vertices with more than a HUBS-th of the n links, so at most HUBS of them, and the smallest of each and its neighbours."""
    return both.groupBy(F.col("u").alias("hub")).agg(F.count("*").alias("n"), F.min("v").alias("least")).where(F.col("n") > n / HUBS).select("hub", F.least("hub", "least").alias("least"))


def _star(edges: DataFrame, n: int, large: bool) -> DataFrame:
    """Ties neighbours to the smallest of a vertex and its neighbours; n: how many links there are.

    The large star moves the larger neighbours of u, the small star u itself and its smaller
    neighbours. Links of hubs stay where they are: their smallest neighbours come from a
    partial aggregate, a table of at most HUBS rows. The others are dealt by vertex and come in
    order, so the smallest neighbour is a vertex's first row and none is held in memory.
    """

    def run(batches):
        last = None  # u, smallest of u and its neighbours, neighbour of the row before
        for batch in batches:
            u, v = batch.column("u").to_numpy(), batch.column("v").to_numpy()
            if not len(u):
                continue
            new = np.ones(len(u), bool)
            new[1:] = u[1:] != u[:-1]
            repeated = np.zeros(len(u), bool)
            repeated[1:] = ~new[1:] & (v[1:] == v[:-1])
            if last is not None and last[0] == u[0]:
                new[0], repeated[0] = False, last[2] == v[0]
            heads = np.flatnonzero(new)
            least = np.minimum(u[heads], v[heads])
            if not new[0]:
                least = np.append(last[1], least)
            m = least[np.cumsum(new) - int(new[0])]
            if large:
                keep = (v > u) & ~repeated
                a, b = v[keep], m[keep]
            else:
                keep = (v != m) & ~repeated
                a, b = np.concatenate([v[keep], u[new]]), np.concatenate([m[keep], m[new]])
            differ = a != b
            yield pa.RecordBatch.from_arrays([pa.array(a[differ]), pa.array(b[differ])], ["u", "v"])
            last = (u[-1], m[-1], v[-1])

    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*") if large else edges
    if n <= FEW:
        return both.repartition("u").sortWithinPartitions("u", "v").mapInArrow(run, "u long, v long")
    hubs = _hubs(both, 2 * n if large else n)
    marked = both.join(F.broadcast(hubs), F.col("u") == F.col("hub"), "left")
    dealt = marked.where("hub is null").select("u", "v").repartition("u").sortWithinPartitions("u", "v").mapInArrow(run, "u long, v long")
    of_hubs = marked.where("hub is not null and v > u" if large else "hub is not null").selectExpr("v as u", "least as v")
    own = hubs.where(F.lit(not large)).selectExpr("hub as u", "least as v")
    return dealt.unionByName(of_hubs.unionByName(own).where("u <> v"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (u, v), two longs; component is its smallest id.

    Links to itself and repeated links count for nothing. Each round is checkpointed, so a
    lost executor costs one round at most.
    """
    edges = links.where("u is not null and v is not null and u <> v").selectExpr("greatest(u, v) as u", "least(u, v) as v").checkpoint()
    state = _state(edges)
    while state[0]:
        edges = _star(edges, state[0], True).checkpoint()
        edges = _star(edges, edges.count(), False).checkpoint()
        state, before = _state(edges), state
        if state == before:
            break
    return edges.selectExpr("u as id", "v as component").unionByName(edges.selectExpr("v as id", "v as component")).distinct()
