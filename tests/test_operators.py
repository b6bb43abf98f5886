"""Ranking, pairs, selection, validation and generation against small direct computations."""

import itertools
import math
import random

from pyspark.sql import functions as F

from lexispark.functions import values as V
from lexispark.operators import generation, pairs, ranking, selection, summary, validation
from lexispark.operators import sections as D
from lexispark.plans import generate
from lexispark.plans.generate import RunConfig, TypeConfig, run
from lexispark.sources import corpus


def sections(spark, rows):
    return spark.createDataFrame(rows, "source string, doc_id long, heading string, text string, n_words int, nouns array<string>, terms array<string>")


def test_top_pairs_equals_all_pairs(spark):
    rng = random.Random(3)
    rows = [(f"s{i % 3}", i, f"h{i % 7}", "t", 20, rng.sample([f"Name{j}" for j in range(25)] + ["Manager"], 8), rng.sample(["term a", "Term A", "x y z"], 2)) for i in range(60)]
    clean = lambda r: {("n", x) for x in r[5] if x != "Manager"} | {("t", x.lower()) for x in r[6]}
    for within in (True, False):
        got = [(r.doc_a, r.doc_b, r.n_shared) for r in pairs.top_pairs(sections(spark, rows), 12, within).orderBy("rank").collect()]
        want = []
        for a, b in itertools.permutations(rows, 2):
            fits = a[0] == b[0] and a[1] < b[1] and a[2] != b[2] if within else a[0] < b[0]
            n = len({x for _, x in clean(a) & clean(b)})
            if fits and n:
                want.append((-n, a[0], a[1], b[0], b[1]))
        assert got == [(w[2], w[4], -w[0]) for w in sorted(want)[:12]]


def test_capped_pairs_fill_up_after_the_cap():
    rows = [{"doc_a": a, "doc_b": b, "source_a": s} for a, b, s in ((1, 2, "x"), (1, 3, "x"), (2, 3, "x"), (7, 8, "y"))]
    assert pairs.capped(rows, 3, set(), True) == [rows[0], rows[3], rows[1]]
    assert pairs.capped(rows, 3, {1, 2, 3}, False) == [rows[3]]


def test_bm25(spark):
    texts = {1: "red fox red fox jumps over lazy dogs near river banks", 2: "red house stands alone upon green hill beside river banks", 3: "too short red"}
    rows = [("s", i, "", t, len(t.split()), [], []) for i, t in texts.items()]
    got = ranking.search(ranking.build_index(sections(spark, rows)), spark.createDataFrame([(1, ["fox", "red", "red"])], "query_id long, terms array<string>"), 10).orderBy("rank").collect()
    tokens = {i: [w for w in texts[i].split() if w not in ("over",)] for i in (1, 2)}
    avg = sum(map(len, tokens.values())) / 2
    score = lambda i: sum(math.log((2 - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(tokens[i]) / avg)) for w in ("fox", "red", "red") if (tf := tokens[i].count(w)) for df in [sum(w in x for x in tokens.values())])
    assert [r.doc_id for r in got] == [1, 2]
    assert abs(got[1].score - score(2)) < 1e-3


def test_long_spans_take_whole_sections(spark):
    rows = [("a", i, "", "x" * 1500, 1, [], []) for i in range(6)] + [("b", 10 + i, "", "x" * 10, 1, [], []) for i in range(3)]
    got = {(r.source, r.start_idx, r.n_included, r.total_chars) for r in selection.long_spans(sections(spark, rows)).collect()}
    assert got == {("a", 0, 2, 3002)}  # the first source of a start


def test_validation_reports_the_first_broken_rule(spark):
    context = "The valve opens after ten minutes and closes again."
    rows = [("direct_lookup", 0.1, context, "valve"), ("direct_lookup", 1.0, context, "zzzz"), ("hallucination_test", 1.0, context, "zzzz"), ("direct_lookup", 1.0, "The valve", "valve"), ("multi_hop_between_documents", 1.0, context, "valve")]
    df = spark.createDataFrame(rows, "type string, match_ratio double, context string, answer string").withColumn("same_document", F.lit(True))
    assert [r.reason for r in validation.validated(df).collect()] == ["context_not_found", "answer_not_grounded", "passed", "context_too_short", "same_document"]


def test_json_answers(spark):
    good = '{"question": "q", "answer": "a"}'
    rows = [(1, good), (2, f"```json\n{good}\n```"), (3, f"Sure: {good} done"), (4, "[1, 2]"), (5, "text"), (6, ""), (7, '{"question": "q", "answer": "N/A"}'), (8, '{"question": "q"}'), (9, None)]
    got = generation.parsed_answers(spark.createDataFrame(rows, "row_id int, raw string")).collect()
    assert sorted(r.row_id for r in got) == [1, 2, 3]


def test_generators_are_found_by_name():
    import pytest

    with pytest.raises(ValueError):
        generation.generator("none such")


def test_run_is_reproducible_and_uses_no_section_twice(spark):
    words = [f"word{i}" for i in range(40)]
    rows = [(i, " ".join(random.Random(i).sample(words, 30)) + f" {100 + i} items. Contact a{i}@ex.org", "en", f"s{i % 3}", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    config = RunConfig({"direct_lookup": TypeConfig(True, 3), "pinpointing_quoting": TypeConfig(True, 3), "hallucination_test": TypeConfig(True, 2)})
    first, second = (sorted(map(tuple, run(docs, config).drop("source_documents").collect())) for _ in range(2))
    assert first == second and len(first) == 8
    facts = [r for r in first if r[2] != "hallucination_test"]
    assert len({r[5] for r in facts}) == len(facts)
    one = summary.summary(run(docs, config), 8, 10).first()
    assert one.n_questions == 8 and one.yield_ratio == 1.0


def test_sources(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "b 2023.TXT").write_bytes(b"some text \xff here")
    (tmp_path / "sub" / "a.md").write_text("# Head\nbody")
    (tmp_path / "c.bin").write_text("left out")
    rows = corpus.text_files(spark, str(tmp_path)).orderBy("doc_ord").collect()
    assert [(r.filename, r.raw_text, r.doc_type, r.year_in_name) for r in rows] == [("b 2023.TXT", "some text  here", "txt", "2023"), ("a.md", "# Head\nbody", "md", None)]
    assert corpus.sample_documents(spark).count() == 5


def test_stream_refreshes_the_index(spark, tmp_path):
    from lexispark.streaming import index_refresh

    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven", "en", "s", 1)], index_refresh.SCHEMA)
    docs.write.parquet(str(tmp_path / "in"))
    index_refresh.refresh_index(index_refresh.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    assert {r.term: r.df for r in index_refresh.term_frequencies(spark, str(tmp_path / "out")).collect()}["seven"] == 1


def test_pairs_of_all_sources_meet_the_cap(spark):
    rng = random.Random(5)
    hot = [("hot", i, f"h{i}", "t", 20, [f"Name{j}" for j in range(9)], []) for i in range(25)]  # its pairs lead the list
    others = [(f"s{i % 4}", 100 + i, f"h{i % 5}", "t", 20, rng.sample([f"Other{j}" for j in range(12)], 4), []) for i in range(40)]
    rows = hot + others + [("alone", 900, "h", "t", 20, ["Name1"], []), ("same", 901, "h", "t", 20, ["Name1"], []), ("same", 902, "h", "t", 20, ["Name1"], [])]
    every = []
    for a, b in itertools.combinations(rows, 2):
        n = len(set(a[5]) & set(b[5]))
        if a[0] == b[0] and a[2] != b[2] and n:
            every.append({"doc_a": a[1], "doc_b": b[1], "source_a": a[0], "source_b": b[0], "n_shared": n})
    every.sort(key=lambda p: (-p["n_shared"], p["source_a"], p["doc_a"], p["doc_b"]))
    for count, used in ((3, set()), (6, set()), (12, {0, 1, 2, 3, 4, 5, 100, 104, 108}), (40, {0, 1, 2})):
        allowed = [p for p in every if not {p["doc_a"], p["doc_b"]} <= used]
        want = pairs.capped(allowed, count, used, True)
        found, n = pairs.deciding_pairs(sections(spark, rows), count, used, True)
        assert n == 5
        assert [(p["doc_a"], p["doc_b"]) for p in pairs.capped(found, count, used, True, n)] == [(p["doc_a"], p["doc_b"]) for p in want]
        assert len({p["source_a"] for p in want}) == min(count, 5)


def test_positions_over_stretches(spark):
    ids = [(None if i % 7 == 0 else "ab"[i % 3 > 0], i * i * (-1) ** i) for i in range(60)] + [("c", 2**62), ("c", -(2**62))]
    rows = spark.createDataFrame(ids, "source string, doc_id long")
    for stretch in (4, 1_000):
        got = {(r.source, r.doc_id): (r.pos, r.n) for r in selection.positions(rows, stretch).collect()}
        for source in (None, "a", "b", "c"):
            own = sorted(d for s, d in ids if s == source)
            assert [got[source, d] for d in own] == [(i, len(own)) for i in range(len(own))]
    assert selection.positions(rows.limit(0)).count() == 0


def test_long_context_holds_all_sections_of_a_span(spark):
    texts = [" ".join(random.Random(i).choices([f"word{j}" for j in range(90)], k=40 + 150 * (i % 5 == 3))) for i in range(14)]
    docs = spark.createDataFrame([(i, t, "en", "ab"[i > 8], 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    made = run(docs, RunConfig({"long_context_synthesis": TypeConfig(True, 9)})).orderBy("ord").collect()
    want = ["\n\n".join(texts[i:j]) for i, j in ((0, 4), (4, 8))]
    assert [r.context for r in made] == want and all(len(w) <= 4000 for w in want)


def test_run_checks_contexts_and_topics(spark):
    rng = random.Random(11)
    text = lambda i: " ".join(f"term{i:02d}{rng.randint(0, 9)}x" for _ in range(40))
    rows = [(i, text(i)) for i in range(10)]
    rows += [(10 + i, "other words at the very start of it " * 12 + rows[i][1]) for i in range(5)]  # the topics of 0 to 4 stand elsewhere
    docs = spark.createDataFrame([(i, t, "en", f"s{i}", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    made = run(docs, RunConfig({"hallucination_test": TypeConfig(True, 15)})).orderBy("ord").collect()
    contexts = [r.context for r in made]
    assert [r.id for r in made] == [f"v2_hallucination_test_{k}" for k in range(len(made))]
    assert all(r.match_ratio == 1.0 for r in made)
    assert not any(c == t for c in contexts for _, t in rows[:5]) and {t for _, t in rows[5:10]} <= set(contexts)


def test_contexts_that_no_source_holds_are_rejected(spark):
    generation.register_generator("foreign", lambda made: generation.template_questions(made).withColumn("passage", F.when(F.col("ord") % 2 == 0, F.lit("none of these words stand in any text of the corpus")).otherwise(F.col("passage"))))
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(30)), "en", "s", 0) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    made = run(docs, RunConfig({"hallucination_test": TypeConfig(True, 6)}, generator="foreign")).collect()
    assert len(made) == 3 and all(r.context.startswith("w") for r in made)


def test_source_ratios_read_sources_as_one_text(spark):
    rows = [("a", 1, "one two three four five"), ("a", 2, "six"), ("a", 3, "Seven, eight nine ten"), ("a", 4, ""), ("b", 5, "alpha beta gamma delta epsilon zeta")]
    asked = [(1, "four five six seven eight nine", ["a"]), (2, "one two three four -- alpha beta gamma delta", ["a", "b"]), (3, "alpha beta gamma delta", ["a"]), (4, "five six", ["a"]), (5, "zeta one", ["a", "b"]), (6, "", ["a"]), (7, "three four five six seven eight nine ten", ["a", "c"])]
    whole = {s: " ".join(t.lower().replace(",", "") for x, _, t in rows if x == s and t) for s in "ab"}
    want = {}
    for i, c, sources in asked:
        w = c.replace("--", "").split()
        parts = [" ".join(w[k : k + 4]) for k in range(0, len(w) - 3, 2)] or [" ".join(w)] * bool(w)
        want[i] = round(sum(any(p in whole.get(s, "") for s in sources) for p in parts) / max(len(parts), 1), 6)
    got = validation.source_ratios(spark.createDataFrame(asked, "context_id int, context string, sources array<string>"), spark.createDataFrame(rows, "source string, doc_id long, text string")).collect()
    assert {r.context_id: r.ratio for r in got} == want and want[1] == want[7] == 1.0 and want[3] == 0.0


def all_pairs(rows, within, k):
    """rows: (source, doc_id, heading, names)."""
    want = []
    for a, b in itertools.permutations(rows, 2):
        fits = a[0] == b[0] and a[1] < b[1] and a[2] != b[2] if within else a[0] < b[0]
        if fits and (n := len(set(a[3]) & set(b[3]))):
            want.append((-n, a[0], a[1], b[0], b[1]))
    return [(s, a, t, b, -n) for n, s, a, t, b in sorted(want)[:k]]


def test_pairs_with_names_in_every_section(spark, monkeypatch):
    """Lists of frequent names meet block by block, in rounds until no block can beat the k-th pair."""
    monkeypatch.setattr(pairs, "BLOCK", 16), monkeypatch.setattr(pairs, "FIRST", 2)
    expanded = []
    monkeypatch.setattr(pairs, "_expanded", lambda chosen, *rest, f=pairs._expanded: expanded.append(chosen.count()) or f(chosen, *rest))
    rng = random.Random(8)
    one = [(f"s{i % 3}", i, f"h{i % 4}", ["Common"]) for i in range(400)]
    some = [(f"s{i % 3}", i, f"h{i % 4}", ["Common", "Often"][: 1 + (i % 5 == 0)] + rng.sample([f"Wide{j}" for j in range(6)], 3) + [f"Rare{i // 2}"] * (i > 390)) for i in range(400)]
    hot = [("hot" if i % 3 else f"s{i}", i, f"h{i % 2}", [f"Name{j}" for j in range(5) if (i >> j) & 1]) for i in range(1, 300)]
    for rows in (one, some, hot):
        frame = sections(spark, [(s, i, h, "t", 20, names, []) for s, i, h, names in rows])
        for within in (True, False):
            expanded.clear()
            got = pairs.top_pairs(frame, 7, within).orderBy("rank").collect()
            assert [(r.source_a, r.doc_a, r.source_b, r.doc_b, r.n_shared) for r in got] == all_pairs(rows, within, 7)
            assert rows is not one or sum(expanded) < 40  # of some hundreds
    assert pairs.top_pairs(sections(spark, [("a", 1, "h", "t", 20, ["Name"], [])]), 3).collect() == []


def test_numbering(spark):
    from lexispark.operators.numbering import numbered, numbered_within

    rows = spark.createDataFrame([(f"p{(i * 37) % 101:03d}", "ab"[i % 7 > 0]) for i in range(101)], "path string, g string").repartition(5)
    assert [r.path for r in numbered(rows, "path").orderBy("ord").collect()] == [f"p{i:03d}" for i in range(101)]
    got = numbered_within(rows, ["g"], F.desc("path"), name="at").collect()
    for g in "ab":
        own = sorted((r for r in got if r.g == g), key=lambda r: r.path, reverse=True)
        assert [r["at"] for r in own] == list(range(len(own))) and {r.n for r in own} == {len(own)}
    assert numbered(rows.limit(0), "path").count() == 0


def test_parts_inside_words(spark):
    """Parts of one to four words are found wherever the plain text contains them, over borders of sections too."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abé", k=rng.randint(1, 5)))
    texts = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 25])))) for i in range(40)]
    asked = []
    for i in range(80):
        t = " ".join(x for _, x in texts if x)
        start, n = rng.randrange(len(t) - 40), rng.randint(1, 30)
        asked.append((i, t[start : start + n].strip() if i % 3 else " ".join(word() for _ in range(rng.randint(1, 4)))))
    asked += [(90, ""), (91, "a"), (92, None), (93, "é a")]

    def ratio(c, d):
        w = c.split()
        parts = [" ".join(w[k : k + 4]) for k in range(0, len(w) - 3, 2)] or [" ".join(w)] * bool(w)
        return round(sum(p in d for p in parts) / max(len(parts), 1), 6)

    contexts = spark.createDataFrame(asked, "context_id long, context string")
    got = {(r.context_id, r.doc_id): r.ratio for r in validation.context_matches(contexts, spark.createDataFrame(texts, "doc_id long, text string"), 0.3).collect()}
    assert got == {(i, d): r for i, c in asked for d, t in texts if (r := ratio(c or "", t)) >= 0.3} and len(got) > 100
    rows = spark.createDataFrame([("xy"[d % 3 == 0], d, t) for d, t in texts], "source string, doc_id long, text string")
    whole = {s: " ".join(t for d, t in texts if t and "xy"[d % 3 == 0] == s) for s in "xy"}
    named = contexts.withColumn("sources", F.array(F.lit("x"), F.lit("none")))
    got = {r.context_id: r.ratio for r in validation.source_ratios(named, rows).collect()}
    assert got == {i: ratio(c or "", whole["x"]) for i, c in asked}


def test_no_text_moves_for_context_matches(spark):
    docs = spark.createDataFrame([(1, "one two three four five")], "doc_id long, text string")
    plan = validation.context_matches(spark.createDataFrame([(1, "one two three four")], "context_id long, context string"), docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2  # the texts are read once and joined with nothing but parts


def test_best_source_of_excerpts(spark):
    docs = spark.createDataFrame([("a", "wooden bridges over rivers"), ("b", "iron bridges"), ("c", None)], "source string, text string")
    asked = spark.createDataFrame([(1, "Bridge of iron", ["a", "b"]), (2, "rivers, bridges", ["b", "a"]), (3, "bridges", ["b", "a"]), (4, "nothing here at all", ["a"]), (5, "iron", ["a"]), (6, "ab", ["a", "b"])], "item_id long, text string, sources array<string>")
    assert sorted(map(tuple, validation.best_matching(asked, docs).collect())) == [(1, "b", 1.0), (2, "a", 1.0), (3, "b", 1.0)]


def test_search_skips_runs_of_sections(spark, monkeypatch, tmp_path):
    """The same rows as from all postings, from a part of the blocks."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"word{j}" for j in range(30)], k=20) + rng.choices([f"rare{j}" for j in range(60)], k=rng.choice([0, 0, 0, 1, 6]))) for _ in range(600)]
    rows = [(f"s{i % 3}" if i % 50 else None, i if i % 31 else -i, "", t, len(t.split()), [], []) for i, t in enumerate(texts)] + [("s1", 1000, "", "the and or to for on with at by from", 10, [], [])]
    asked = [(q, rng.sample([f"word{j}" for j in range(30)], 1) + rng.sample([f"rare{j}" for j in range(60)], 2)) for q in range(6)] + [(6, ["none"]), (7, ["rare1", "rare1"]), (8, [])]
    queries = spark.createDataFrame(asked, "query_id long, terms array<string>")
    monkeypatch.setattr(ranking, "SPAN", 8), monkeypatch.setattr(ranking, "FIRST", 2)
    index = ranking.stored_index(sections(spark, rows), str(tmp_path))
    plain = ranking.SearchIndex(index.postings, index.terms, index.stats)
    read = []
    monkeypatch.setattr(ranking, "kept", lambda df, name, f=ranking.kept: (out := f(df, name), read.append(index.blocks.join(out, ["term", "run"]).count() if name == "wanted" else 0))[0])
    for k, source in ((3, None), (4, "s1"), (1000, None)):
        read.clear()
        columns = ("query_id", "rank", "source", "doc_id", "score")
        got, want = (sorted(map(tuple, ranking.search(i, queries, k, source).select(*columns).collect()), key=str) for i in (index, plain))
        assert got == want and got
        if k == 3:
            blocks = index.blocks.join(ranking.query_terms(queries), "term").count()
            assert 0 < sum(read) < 0.7 * blocks, (read, blocks)


def test_a_task_gives_on_the_best_of_its_runs_only(spark, monkeypatch, tmp_path):
    """Postings are stored where their sections are read, a section is scored in one task, and copies give no more rows than are asked for."""
    monkeypatch.setattr(ranking, "SPAN", 4)
    text = "red fox jumps over lazy dogs near wide river banks today"
    rows = [(None if i % 5 == 0 else f"s{i % 2}", 1000 - i, "", text if i % 3 else f"{text} stone {i}", 11, [], []) for i in range(120)]
    index = ranking.stored_index(sections(spark, rows), str(tmp_path))
    assert sorted(len(r.dls) for r in index.runs.collect())[-20:] == [4] * 20 and index.runs.select(F.sum(F.size("dls"))).first()[0] == 120
    queries = spark.createDataFrame([("a", ["fox", "river"]), ("b", ["stone", "fox", "fox"]), ("c", ["none"])], "query_id string, terms array<string>")
    plain = ranking.SearchIndex(index.postings, index.terms, index.stats)
    for source in (None, "s1"):
        got, want = (sorted(map(tuple, ranking.search(i, queries, 7, source).select("query_id", "rank", "source", "doc_id", "score").collect()), key=str) for i in (index, plain))
        assert got == want and len(got) == 14
    parts = ranking._parts(ranking._asked(index, queries), spark.createDataFrame([("b", 1e6)], "query_id string, least double"))
    pairs = index.runs.crossJoin(parts)
    made = pairs.mapInArrow(ranking._scores_of(7, None), "query_id string, source string, doc_id long, score double").collect()
    assert {r.query_id for r in made} == {"a"} and len(made) <= 7 * pairs.rdd.getNumPartitions()


def test_a_run_finds_the_facts_that_its_strategies_read(spark):
    """Each strategy scores as it does on all facts, and the facts of others are not looked for."""
    words = [f"word{i}" for i in range(40)]
    texts = [" ".join(random.Random(i).sample(words, 30)) + f" Grace Period means {100 + i} items on 12-05-2024 for $9{i}.\n- Call 020-12345{10 + i} or a{i}@ex.org, https://ex.org/{i}\na | b | c\nd | e | f" for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = D.corpus_view(docs)
    every = generate.prepared(rows)
    assert set(generate.READS) == set(V.QUESTION_TYPES.values()) | {"temporal"}
    for strategy in selection.SCORES:
        own = generate.prepared(rows, [strategy])
        got, want = (sorted(map(tuple, selection.top_passages(strategy, t, 9).collect())) for t in (own, every))
        assert got == want and "content" not in own.columns
    assert {"has_dates", "urls", "entity_count"}.isdisjoint(generate.prepared(rows, ["within", "lists"]).columns)


def test_index_is_stored_once(spark, tmp_path):
    path, made = str(tmp_path / "docs"), []
    frame = sections(spark, [("s", 1, "", "one two three four five six seven eight nine ten", 10, [], [])])
    frame.write.parquet(path)
    build = lambda: made.append(1) or frame
    assert ranking.corpus_index(spark, path, build) is ranking.corpus_index(spark, path, build) and len(made) == 1
    frame.write.mode("append").parquet(path)
    assert ranking.corpus_index(spark, path, build).stats.first().n_docs == 1 and len(made) == 2


def test_chosen_pairs_are_those_of_all_pairs(spark, monkeypatch):
    """However few pairs are fetched at first; a group of copies makes many that are skipped."""
    fetched = []
    monkeypatch.setattr(pairs, "_collected", lambda p, f=pairs._collected: fetched.append(rows := f(p)) or rows)
    rng = random.Random(12)
    rows = [(f"s{i % 4}", i, f"h{i}", [f"Copy{j}" for j in range(6)] if i < 16 else rng.sample([f"Name{j}" for j in range(14)], 4)) for i in range(60)]
    frame = sections(spark, [(s, i, h, "t", 20, names, []) for s, i, h, names in rows])
    for within, count, used in ((False, 3, set()), (False, 9, {0, 1, 2}), (True, 5, set()), (True, 12, {0, 4, 8})):
        fetched.clear()
        every = [{"source_a": s, "doc_a": a, "source_b": t, "doc_b": b} for s, a, t, b, _ in all_pairs(rows, within, 10**6) if not {a, b} <= used]
        found, n = pairs.deciding_pairs(frame, count, used, within)
        taken = pairs.capped(found, count, used, within, n)
        assert [(p["doc_a"], p["doc_b"]) for p in taken] == [(p["doc_a"], p["doc_b"]) for p in pairs.capped(every, count, used, within)]
        assert max(map(len, fetched)) < len(every) / 2


def test_changed_documents_count_once(spark, tmp_path):
    from lexispark.streaming import index_refresh

    words = "one two three four five six seven eight nine ten"
    batches = [
        [(1, f"{words} apple", "en", "s", 1), (2, f"{words} apple", "en", "s", 1), (3, f"{words} pear", "en", "s", 1)],
        [(1, f"{words} apple", "en", "s", 1), (2, f"{words} plum", "en", "t", 1), (4, f"{words} apple", "en", "s", 1), (4, f"{words} plum", "en", "s", 1)],
        [(3, None, "en", "s", 1), (5, "short", "en", "s", 1)],
    ]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, index_refresh.SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        index_refresh.refresh_index(index_refresh.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
        found = {r.term: r.df for r in index_refresh.term_frequencies(spark, str(tmp_path / "out")).collect()}
        assert {t: found.get(t, 0) for t in ("apple", "plum", "pear", "seven")} == [{"apple": 2, "plum": 0, "pear": 1, "seven": 3}, {"apple": 1, "plum": 2, "pear": 1, "seven": 4}, {"apple": 1, "plum": 2, "pear": 0, "seven": 3}][n]
