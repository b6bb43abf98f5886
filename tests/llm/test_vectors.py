"""Clusters and top-k search over vectors against plain versions, and how much of the work is left out."""

import hashlib
import math
import random

import numpy as np
import pytest

from lexispark.llm import topk_search
from lexispark.llm.centroid_clustering import ball_kmeans, by_balls, exact, nearest
from lexispark.llm.shared import ready
from lexispark.llm.topk_search import Shard, build_shards, top_by_product

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance double, part int, ids string, rank string"


def made(seed: int, n: int, width: int, spread: float = 0.3) -> list[tuple]:
    """Vectors around a few centres, with copies, ties and all that is left out."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + spread * rng.normal(size=width)]) for i in range(n)]
    rows += [(n + i, rows[i % 3][1]) for i in range(20)] + [(2, rows[2][1]), (2, rows[3][1]), (None, rows[4][1])]
    odd = [None, [], [1.0] * (width - 1), [None] + [1.0] * (width - 1), [math.nan] + [0.0] * (width - 1), [math.inf] + [0.0] * (width - 1), [0.0] * width]
    return rows + [(50 * (900 + i), v) for i, v in enumerate(odd)]


def frame(spark, rows):
    ready(spark)
    return spark.createDataFrame([(i, v, "c", 1.5, 7, "x", "y") for i, v in rows], SCHEMA).repartition(3)


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def kmeans(rows, k, rounds, width):
    points = [(i, v, [math.floor(1024 * x) for x in v]) for i, v in rows if usable(v) and len(v) == width]
    digest = lambda i: (i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centres = [p for _, _, p in sorted(points, key=lambda x: (digest(x[0]), x[1]))[:k]]
    for turn in range(rounds + 1):
        own = [min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), j) for j, c in enumerate(centres)) for _, _, p in points]
        if turn < rounds:
            members = [[p for (_, _, p), (_, j) in zip(points, own, strict=True) if j == c] for c in range(len(centres))]
            centres = [[sum(x) // len(m) for x in zip(*m, strict=True)] if m else c for m, c in zip(members, centres, strict=True)]
    sums = [sum(d for d, j in own if j == c) for c in range(len(centres))]
    return sorted(((i is None, i, j, d, centres[j], sums[j], sum(sums)) for (i, _, _), (d, j) in zip(points, own, strict=True)), key=str)


@pytest.mark.parametrize(("k", "rounds", "n"), [(8, 10, 300), (3, 2, 40), (4, 0, 30), (60, 3, 10)])
def test_clusters(spark, k, rounds, n):
    rows = made(k, n, 6)
    got = ball_kmeans(frame(spark, rows), k, rounds, 6).collect()
    assert sorted(((r.vec_id is None, r.vec_id, r.cluster, r.distance, r.centroid, r.cluster_inertia, r.inertia) for r in got), key=str) == kmeans(rows, k, rounds, 6)


def test_large_components(spark):
    """Beyond what float64 holds exactly, whole numbers of any size decide; what 64 bits cannot hold is null."""
    rows = [(i, [float(np.float32(x)) for x in (10.0 ** (i % 30), -3.0 * i, 7.5)]) for i in range(25)]
    got = {r.vec_id: (r.cluster, r.distance, r.inertia) for r in ball_kmeans(frame(spark, rows), 3, 4, 3).collect()}
    assert got == {i: (j, d if d < 2**63 else None, None) for _, i, j, d, *_ in kmeans(rows, 3, 4, 3)}
    found = top_by_product(build_shards(frame(spark, rows)), frame(spark, rows[:1]), 5).collect()
    scores = sorted(((sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(rows[0][1], v, strict=True)), -i) for i, v in rows[1:]), reverse=True)[:5]
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(-i, s if s < 2**63 else None) for s, i in scores]


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        assert ball_kmeans(frame(spark, rows), width=6).collect() == []
        assert top_by_product(build_shards(frame(spark, [])), frame(spark, rows)).collect() == []
    assert top_by_product(build_shards(frame(spark, [(1, [1.0])])), frame(spark, [(1, [1.0])])).collect() == []


def test_balls_compare_less():
    """Members of balls far from each other are in stable cores; the result is that of all comparisons."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (8, 64)).astype(object)
    points = (centres[rng.integers(0, 8, 2000)] + rng.integers(-300, 300, (2000, 64))).astype(float)
    p, c = exact(points, centres)
    own, _ = nearest(p, c)
    shifted = c + rng.integers(-40, 40, c.shape)
    cluster, distance, compared = by_balls(p, own, shifted, np.ones(8, bool))
    assert [x.tolist() for x in nearest(p, shifted)] == [cluster.tolist(), distance.tolist()]
    assert compared < 1.2 * len(points) < 8 * len(points)
    wide = rng.integers(-5000, 5000, (3000, 64)).astype(float)
    own, _ = nearest(wide, c)
    assert [x.tolist() for x in nearest(wide, shifted)] == [x.tolist() for x in by_balls(wide, own, shifted, np.ones(8, bool))[:2]]


def best(rows, k):
    floors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if usable(v)]
    out = []
    for q, a in floors:
        if q is not None and q % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i is None, i or 0) for i, b in floors if i != q)[:k]
            out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(found)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("shard", "block", "most"), [(8192, 8192, 1 << 20), (70, 3, 1 << 20), (50, 4, 100)])
def test_search(spark, monkeypatch, shard, block, most):
    monkeypatch.setattr(topk_search, "SHARD", shard), monkeypatch.setattr(topk_search, "BLOCK", block), monkeypatch.setattr(topk_search, "MOST", most)
    monkeypatch.setattr(topk_search, "START", 20)
    rows = made(5, 400, 12) + [(50, made(5, 60, 12)[50][1])]
    vectors = frame(spark, rows)
    got = top_by_product(build_shards(vectors), vectors.where("vec_id % 50 = 0"), 5).collect()
    assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str) == best(rows, 5)


def test_search_broadcasts_no_vectors(spark):
    """Shards times blocks of rows would meet in the driver."""
    vectors = frame(spark, made(8, 40, 12))
    found = top_by_product(build_shards(vectors), vectors, 5)
    assert found.count() > 0
    assert "Broadcast" not in found._jdf.queryExecution().toString()


def test_postings_left_out():
    """Non-essential terms are read for vectors that compete only; ties with the k-th best are all kept."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(10, 64)) * 60
    weights = np.floor(centres[rng.integers(0, 10, 5000)] + rng.normal(size=(5000, 64)) * 15).T.copy()
    shard, asked = Shard(weights, list(range(5000))), random.Random(1).sample(range(5000), 40)
    for q in asked:
        places, scores = shard.best(weights[:, q], q, 5, -np.inf)
        whole = weights[:, q] @ weights
        want = sorted((-s, i) for i, s in enumerate(whole) if i != q)[:5]
        assert list(zip(-scores, places, strict=True)) == want
    assert shard.read < 0.75 * len(asked) * weights.size
