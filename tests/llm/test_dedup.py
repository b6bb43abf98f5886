"""Repeated strings, near copies and shared lines, against plain versions."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.llm import jaccard_join, line_dedup, substring_dedup
from lexispark.llm.arrowtext import blocks
from lexispark.llm.components import components
from lexispark.llm.line_dedup import build, dedup_lines, find

from . import brute
from .conftest import frame


def by_id(texts):
    return list(dict(texts).items())


@pytest.mark.parametrize("many,combined", [(4_000, 400_000), (2, 40), (1, 1)])
def test_substrings(docs, texts, empty, monkeypatch, many, combined):
    monkeypatch.setattr(substring_dedup, "MANY", many)
    monkeypatch.setattr(substring_dedup, "COMBINED", combined)
    monkeypatch.setattr(substring_dedup, "SPREAD", 2_048 if many > 1 else 3)
    got = substring_dedup.dedup_substrings(docs).withColumn("sha", F.sha2("kept", 256)).collect()
    want = brute.substrings(by_id(texts))
    assert len(got) == len(texts)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got} == want
    if many > 2:
        assert substring_dedup.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("many", [4_000, 1])
def test_substrings_of_many_copies_and_runs(spark, monkeypatch, many):
    """Copies in every document, texts without triggers (long runs), one row twice, parts of a long text."""
    rng = random.Random(9)
    passage = " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(60))
    rows = [(i, f"{rng.random()} own {i * 7919} " * rng.randint(1, 9) + (passage[i % 40 :] if i % 2 else passage[: 150 + i])) for i in range(60)]
    rows += [(100, "z" * 900), (101, "z" * 300 + "yx" * 200 + passage * 2), (102, passage), (102, passage), (3, rows[3][1])]
    monkeypatch.setattr(substring_dedup, "MANY", many)
    monkeypatch.setattr(substring_dedup, "PLACE_BITS", 10)
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 500)
    got = substring_dedup.dedup_substrings(frame(spark, rows)).withColumn("sha", F.sha2("kept", 256)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in got} == brute.substrings(by_id(rows))


def test_substrings_without_ids_keep_all(spark):
    text = "abcdefghij" * 30
    rows = frame(spark, [(None, text), (None, text), (1, text)])
    got = {(r.doc_id, r.n_removed) for r in substring_dedup.dedup_substrings(rows).collect()}
    assert got == {(None, 0), (1, 290)}


@pytest.mark.parametrize("hot,chunk", [(16, 400_000), (2, 900), (1, 120)])
def test_jaccard_join(docs, texts, empty, monkeypatch, hot, chunk):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    got = jaccard_join.join_documents(docs, 4, 85).collect()
    assert len(got) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(by_id(texts))
    if hot > 2:
        assert jaccard_join.join_documents(empty, 4, 85).count() == 0


def test_jaccard_join_by_default_takes_five_words_and_four_fifths(docs, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_documents(docs).collect()} == brute.components(by_id(texts), 5, 80)


def test_jaccard_join_without_ids_and_with_repeated_ids(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = frame(spark, [(None, a), (None, a), (3, a), (4, a), (4, b), (9, b), (8, b)])
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0) for r in jaccard_join.join_documents(rows, 4, 85).collect())
    assert [x[1] for x in got] == [4, 4, 4, 3, 4, 3, 3]
    assert {x[2] for x in got if not x[0]} == {0}  # rows without doc_id link with nothing
    linked = {d: c for d, _, c in got if d}
    assert linked[8] in (4, 8) and linked[3] == 3 and linked[9] == linked[8]  # of the two texts of 4, one links
    assert (linked[4] == 3) != (linked[8] == 4)


def test_pairs_skip_what_cannot_link_only(spark):
    rng, n_lists = random.Random(6), 40
    rows = [(s, 100 * s + i, n := rng.randint(20, 30), rng.randint(0, n - 1)) for s in range(n_lists) for i in range(rng.randint(2, 16))]
    found = jaccard_join.meetings(spark.createDataFrame(rows, "shingle long, rep long, n int, pos int").repartition(3), 85)
    got = sorted((r.shingle, r.a, r.b) for r in found.collect())
    want = []
    for x in rows:
        for y in rows:
            if x[0] == y[0] and (x[2], x[3], x[1]) < (y[2], y[3], y[1]):
                least = -(-85 * (x[2] + y[2]) // 185)
                if 100 * x[2] >= 85 * y[2] and x[3] < x[2] - -(-170 * x[2] // 185) + 3 and min(x[2] - x[3], y[2] - y[3]) + 2 >= least:
                    want.append((x[0], min(x[1], y[1]), max(x[1], y[1])))
    assert got == sorted(want) and want


def test_blocks_of_texts_are_small():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 3000})
    sizes = [len(b.data) for b in blocks([batch])]
    assert max(sizes) <= 1 << 18 and sum(sizes) == 3_000_000


def test_few_sets_are_made_but_the_wanted_however_many_there_are(spark):
    rows = spark.range(400_000).selectExpr("id as doc_id", "concat('a b c d ', id) as text")
    made = jaccard_join.whole_sets(rows, rows.where("doc_id % 2 = 0").selectExpr("doc_id as rep"), 4).select("rep")
    assert made.where("rep % 2 = 0").count() == 200_000
    assert made.count() < 220_000


def test_long_lists_take_sets_only_that_could_meet_there_alone(spark):
    met = [(1, 10, 11, 3), (2, 20, 21, 3), (3, 30, 31, 3), (4, 30, 31, 3), (5, 40, 41, 1)]
    lists = {10: 2, 11: 5, 20: 1, 21: 2, 50: 3, 51: 2, 52: 1, 53: 1}
    met += [(100 + i, rep, None, 1 if rep == 53 else 40) for rep, n in lists.items() for i in range(n)]
    met = spark.createDataFrame(met, "shingle long, a long, b long, least long")
    hot = spark.createDataFrame(list(lists.items()), "rep long, h long")
    assert sorted(map(tuple, jaccard_join.paired(met, hot).collect())) == [(10, 11), (40, 41)]
    long = met.where("b is null").selectExpr("shingle", "a as rep", "cast(least as int) as n")
    assert {r.rep for r in jaccard_join.only_hot(long, hot, 85).collect()} == {11, 50, 53}


def test_chunk_links_equal_all_pairs():
    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 120 - int(k), replace=False), rng.integers(0, 2**63, int(k), dtype=np.uint64)])) for k in rng.integers(0, 25, 60)]
    for two in (False, True):
        side = np.array([int(two and i % 2) for i in range(60)])
        links = jaccard_join.chunk_links(side, np.arange(60), sets, 85)
        want, have = jaccard_join.Parts(60), jaccard_join.Parts(60)
        for i in range(60):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if (not two or side[i] != side[j]) and 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    want.join(i, j)
        for u, v in links:
            have.join(u, v)
        assert {frozenset(m) for m in have.members.values()} == {frozenset(m) for m in want.members.values()}


def test_components_around_hubs(spark, docs, monkeypatch):
    from lexispark.llm import components as stars

    monkeypatch.setattr(stars, "FEW", 20)
    monkeypatch.setattr(stars, "HUBS", 8)
    links = [(500, i) for i in range(90)] + [(0, i) for i in range(200, 260)] + [(300, 301), (301, 302), (250, 499), (499, 400), (500, 3), (500, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "u long, v long").repartition(4)).collect()}
    assert got == {x: 300 if 300 <= x <= 302 else 0 for e in links for x in e}


def test_components(spark, docs):
    rng = random.Random(8)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 3)]
    up = {x: x for e in links for x in e if x is not None}

    def top(x):
        return x if up[x] == x else top(up[x])

    for u, v in links:
        if u is not None:
            a, b = top(u), top(v)
            up[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: top(x) for u, v in links if u is not None and u != v for x in (u, v)}


def test_lines(docs, texts, empty):
    got = dedup_lines(docs).withColumn("sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.sha) for r in got) == brute.lines(texts)
    assert {r.kept for r in got} == {"b"}
    assert dedup_lines(empty).count() == 0


def test_lines_in_salted_shards_and_with_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 50)
    common, rare = "a line that stands in all of the documents", "a line that two of the documents have"
    rows = [(i, f"{common}\nown line of document number {i} alone\n{rare if i in (3, 9) else 'short'}\n{common.upper() if i % 3 else ''}") for i in range(200)]
    rows += [(None, f"{common}\nnothing else of any length here"), (7, None)]
    named = spark.createDataFrame([(d, t, [1], "x", 5, 6) for d, t in rows], "doc_id long, text string, drop array<int>, owner string, __doc long, Runs long").repartition(5)
    found = dedup_lines(named)
    assert found.columns == ["doc_id", "text", "drop", "owner", "__doc", "Runs", "n_lines", "n_dropped"]
    got = found.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).collect()
    assert {tuple(r["drop"]) for r in got} == {(1,)} and {r["owner"] for r in got} == {"x"}
    want = brute.lines([x for x in rows if x[0] is not None])
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.sha) for r in got if r.doc_id is not None) == want
    assert [(r.n_lines, r.n_dropped) for r in got if r.doc_id is None] == [(2, 0)]


def test_a_document_without_id_counts_towards_the_threshold(spark):
    line = "one line of twenty characters or more"
    got = dedup_lines(frame(spark, [(1, line), (2, line), (None, line)])).collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in got) == [(0, 0), (1, 1), (2, 0)]


def test_perfect_hash_is_minimal():
    import numpy as np

    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(-(2**62), 2**62, 5000) for _ in range(2))
    levels, at = build(h1, h2)
    assert sorted(at) == list(range(5000))
    assert (find(levels, h1, h2) == at).all()
