"""Runs over files, sinks, Unicode facts, parents of sections, and excerpts tied back to texts."""

import datetime
import difflib
import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.operators import excerpts, generation, grounding, summary
from lexispark.operators import sections as D
from lexispark.plans.generate import RunConfig, TypeConfig, run_files
from lexispark.sources import corpus, sinks


def test_facts_of_accented_words(spark):
    text = "Privé regeling betekent rust. Coördinatie means work. Mail rené.x@ex.org, drie\u00a0weken, één\u00a0twee."
    row = spark.createDataFrame([(text,)], "t string").select(X.defined_terms(F.col("t")).alias("terms"), X.emails(F.col("t")).alias("mail"), X.dates(F.col("t")).alias("dates"), X.word_count(F.lit("a\u00a0b c")).alias("n")).first()
    assert row.terms == ["Privé regeling", "Coördinatie"] and row.mail == ["rené.x@ex.org"]
    assert row.dates == ["drie\u00a0weken"] and row.n == 3


def test_triggers_spare_texts_without_matches_only(spark):
    from lexispark.functions import values as V

    texts = ["vier weken", "a 12-05-2024 b", "€ 5", "7 euro", "9EUR", "$3", "x@y.zz", "020-1234567", "http://a", "(ABC)", "Rent is een plicht", "Rent means x", "nothing here", "", "the week", "twee jaar"]
    for trigger, pattern in ((V.HAS_DATE, V.DATE), (V.HAS_MONEY, V.MONEY), (V.HAS_EMAIL, V.EMAIL), (V.HAS_PHONE, V.PHONE), (V.HAS_URL, V.URL), (V.HAS_ABBREVIATION, V.ABBREVIATION), (V.HAS_TERM, V.DEFINED_TERM)):
        got = spark.createDataFrame([(t,) for t in texts], "t string").select(X.found_where(trigger, F.col("t"), pattern).alias("a"), X.found(F.col("t"), pattern).alias("b")).collect()
        assert all(r.a == r.b for r in got) and any(r.b for r in got)


def test_subsections_know_their_chapters(spark):
    pages = [(1, 1, "1. First chapter\nbody text of the first chapter, long enough\n1.1 A part here\nits body is long enough as well"), (1, 2, "2. Second chapter\nbody text of the second chapter too\n2.1 Another part\nmore than twenty characters here")]
    made = D.paged_sections(spark.createDataFrame(pages, "doc_id int, page_no int, text string"))
    assert [(r.sec_ord, r.parent_sec_ord, r.level) for r in made.orderBy("sec_ord").collect()] == [(0, None, 0), (1, 0, 1), (2, None, 0), (3, 2, 1)]
    whole = {r.sec_ord: r.all_text for r in D.all_text(made).collect()}
    assert sorted(whole) == [0, 2] and whole[0].split("\n\n")[1].startswith("1.1 A part here\nits body")


def write_corpus(folder):
    rng = random.Random(1)
    words = [f"word{i}" for i in range(60)]
    body = lambda: " ".join(rng.sample(words, 30)) + f" costs {rng.randint(100, 999)} since 12-05-2024 at Harbour Street."
    (folder / "a 2023.md").write_text("\n".join(f"# Head {i}\n{body()}" for i in range(4)))
    (folder / "sub").mkdir()
    (folder / "sub" / "b.txt").write_text("\n\n".join(f"Start of part {i}\n{body()}" for i in range(4)))
    (folder / "c.json").write_text("{}")


def test_a_folder_goes_through_as_sections(spark, tmp_path):
    write_corpus(tmp_path)
    seen = []
    generation.register_generator("telling", lambda made: seen.append(made) or generation.template_questions(made))
    types = {"direct_lookup": TypeConfig(True, 3), "long_context_synthesis": TypeConfig(True, 1), "temporal_questions": TypeConfig(True, 1), "pinpointing_quoting": TypeConfig(True, 1)}
    made = run_files(spark, str(tmp_path), RunConfig(types, "telling")).collect()
    assert {r.type for r in made} >= {"direct_lookup", "long_context_synthesis"}
    direct = [r for r in made if r.type == "direct_lookup"]
    assert len(direct) == 3 and all(r.context.startswith(("Head", "Start of part")) and r.match_ratio == 1.0 for r in direct)
    spans = [r for r in made if r.type == "long_context_synthesis"]
    assert all(r.context.count("\n\n") >= 1 for r in spans)
    temporal = [r for r in seen[0].collect() if r.type == "temporal_questions"]
    assert temporal and any("a 2023.md: 2023" in r.dates for r in temporal)
    told = generation.prompt_messages(seen[0].select(F.col("key").alias("id"), "type", "passage", F.col("source_documents").alias("sources"), "difficulty", "dates"))
    assert any("Dates of the documents: " in r.content for r in told.collect())


def test_files_keep_their_own_replacement_characters(spark, tmp_path):
    (tmp_path / "own.txt").write_text("a \ufffd b")
    (tmp_path / "bad.txt").write_bytes(b"a \xff b \xef\xbf\xbd")
    assert {r.filename: r.raw_text for r in corpus.text_files(spark, str(tmp_path)).collect()} == {"own.txt": "a \ufffd b", "bad.txt": "a  b "}
    assert corpus.text_files(spark, str(tmp_path), recursive=False).count() == 2


def test_a_test_set_is_one_json_file(spark, tmp_path):
    rows = [(0, "v2_x_0", "x", "q", "a", "c", ["s"], "easy", 1.0, True)]
    questions = spark.createDataFrame(rows, "ord int, id string, type string, question string, answer string, context string, source_documents array<string>, difficulty string, match_ratio double, answer_grounded boolean")
    at = datetime.datetime(2024, 5, 12, 9, 30)
    path = sinks.write_test_set(questions, summary.summary(questions, 1, 1), str(tmp_path), "my corpus", at)
    assert path.endswith("my_corpus/v2_my_corpus_12_05_24_T09_30.json")
    whole = json.load(open(path))
    assert whole["questions"][0]["id"] == "v2_x_0" and whole["summary"]["n_questions"] == 1
    sinks.append_run_metrics(summary.long_format(summary.clean_metrics(questions.withColumn("hallucination_detected", F.lit(False)))), "r1", str(tmp_path / "m"))
    assert {r.metric: r.value for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {"n_questions": 1.0, "n_hallucinated": 0.0, "clean_ratio": 1.0}
    assert summary.clean_metrics(questions.limit(0).withColumn("hallucination_detected", F.lit(False))).first().clean_ratio == 0.0


def test_named_passages(spark):
    long = "This is a passage of more than eighty characters, so that it may be kept as one. " * 30
    item = lambda p, *s: {"passage": p, "source_documents": list(s)}
    raw = [json.dumps([item(long, "A/B.TXT", "none"), item("short", "b.txt"), item(long, "none")]), "text [" + json.dumps(item(long, "c.txt", "b.txt")) + "] end", "no list", "{}", None, "[1, 2"]
    got = excerpts.named_passages(spark.createDataFrame(list(enumerate(raw)), "row_id int, raw string"), spark.createDataFrame([("b.txt",), ("c.txt",)], "source string")).orderBy("row_id").collect()
    assert [(r.row_id, r.pos, r.sources, len(r.passage), r.chapter) for r in got] == [(0, 0, ["b.txt"], 1457, "N/A"), (1, 0, ["c.txt", "b.txt"], 1457, "N/A")]


def test_excerpts_grow_to_paragraphs():
    text = "Head\n\nFirst paragraph with some words.\n\n- a point\n\n- another one\n\nLast paragraph."
    at = text.index("with some")
    assert excerpts.paragraph_around(text, at, at + 9) == "First paragraph with some words.\n\n- a point\n\n- another one"
    assert excerpts.paragraph_around("a\nb c", 4, 5) == "b c"
    assert excerpts.anchored("paragraph with some words and more beside", "x\n\n" + text) is None
    copied = "The tower was built of brick and has a small door on its north side, they say."
    assert excerpts.anchored(copied, f"Intro.\n\n{copied.replace('brick', 'stone')}\n\nEnd.") == copied.replace("brick", "stone")


def test_loose_context_rows_and_joined_questions(spark):
    rows = spark.createDataFrame([("f", "c", None, None), (None, None, "t", "x"), ("g", None, None, "y")], "filename string, content string, text string, type string")
    assert sorted(map(tuple, excerpts.context_rows(rows).collect())) == [("f", "c", "text"), ("unknown", "t", "x")]
    made = generation.generator("joined")(spark.createDataFrame([(1, "a b c d e f g h i\n\n---\n\nj k")], "key int, passage string")).first()
    assert made.answer == "a b c d e f g h; j k" and made.question == "How do these go together: a b c d e f g h... and j k...?"


def plainly_anchored(excerpt: str, text: str) -> tuple:
    """By the standard library's matcher."""
    found = [b for b in difflib.SequenceMatcher(None, excerpt, text, autojunk=False).get_matching_blocks() if b.size >= 20]
    if not found or max(b.b + b.size for b in found) - min(b.b for b in found) < 30:
        return None, None, None
    start, end = min(b.b for b in found), max(b.b + b.size for b in found)
    return start, end, excerpts.paragraph_around(text, start, end)


def test_excerpts_are_anchored_in_whole_texts(spark):
    rng = random.Random(6)
    some = ["tower", "brick", "été", "small door", "on its north side,", "🙂", "they say", "built of", "ab ab ab ab ab ab ab ab ab ab"]
    text = lambda n: " ".join(rng.choices(some, k=n)).replace("side,", rng.choice(["side,\n\n", "side\n", "side"]))
    docs = [(i, text(rng.randint(5, 120))) for i in range(14)] + [(20, None), (21, ""), (22, "short")]
    asked = []
    for i in range(60):
        own = docs[i % 14][1]
        at, cut = rng.randrange(len(own)), rng.randint(5, 90)
        asked.append((i, i % 14, own[at : at + cut] + rng.choice(["", " new words ", "x"]) + own[at + cut + rng.randint(0, 9) :][: rng.randint(0, 90)] + text(rng.randint(0, 3))))
    asked += [(90, 20, "some text that is long enough to be a seed"), (91, 21, "the same text, that is long enough"), (92, 0, None), (93, 1, ""), (94, 22, "short"), (95, 99, "no such document, whatever it is")]
    frame, texts = spark.createDataFrame(asked, "item_id long, doc_id long, excerpt string").repartition(3), spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = {r.item_id: (r.start, r.end, r.found) for r in grounding.anchored_excerpts(frame, texts).collect()}
    known = dict(docs)
    want = {i: plainly_anchored(e or "", known[d] or "") for i, d, e in asked if d in known}
    assert got == want and sum(x[0] is not None for x in want.values()) > 30
    for i, d, e in asked[:60]:
        assert excerpts.anchored(e, known[d]) == want[i][2]
    regions = spark.createDataFrame([(i, d, 30, 150) for i, d, _ in asked], "item_id long, doc_id long, region_start long, region_end long")
    got = {r.item_id: (r.start, r.end, r.found) for r in grounding.anchored_excerpts(frame, texts, regions).collect()}
    inside = {i: plainly_anchored(e, known[d][30:150]) for i, d, e in asked[:60]}
    assert {i: got[i] for i in inside} == {i: (None if s is None else s + 30, None if s is None else t + 30, f) for i, (s, t, f) in inside.items()}


def test_seeds_meet_over_chunks(monkeypatch):
    """Whatever is hashed together, and with seeds that repeat."""
    long = "".join(random.Random(1).choices("abcdefgh \n", k=3_000)) + "ab" * 200 + "x" * 100
    part = long[650:760] + "ab" * 30 + long[-60:]
    want = {j - i for i in range(len(part) - 19) for j in range(len(long) - 19) if part[i : i + 20] == long[j : j + 20]}
    for chunk in (1 << 20, 700, 37):
        monkeypatch.setattr(excerpts, "CHUNK", chunk)
        assert set(excerpts.common_shifts(part, long).tolist()) == want
    assert excerpts.common_shifts("short", long).tolist() == excerpts.common_shifts(part, "").tolist() == []


def plain_region(hint: str, text: str) -> tuple:
    words = {w for w in re.sub(r"\W", " ", hint.lower()).split() if len(w) >= 4}
    best, middle, at = -1.0, 0, 0
    for start in range(0, max(1, len(text) - 799), 200) if words else ():
        end = min(start + 800, len(text))
        score = sum(w in text[start:end].lower() for w in words) / len(words)
        if score > best:
            best, middle, at = score, (start + end) // 2, start
    end = min(len(text), max(0, middle - 2000) + 4000)
    return at, round(max(best, 0.0), 6), max(0, end - 4000), end


def test_regions_of_excerpts(spark):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(40)] + ["Straße", "İstanbul", "été", "ab", "swordfish", "word1word1"]
    docs = [(i, rng.choice([" ", "\n"]).join(rng.choices(words, k=n))) for i, n in enumerate((3, 90, 150, 400, 1500, 2000))] + [(10, ""), (11, None)]
    asked = [(k, d, " ".join(rng.choices([*words, "none at all"], k=5))) for k in range(6) for d, _ in docs] + [(9, 3, "a b c"), (10, 4, None), (11, 1, "sword fish")]
    got = {(r.item_id, r.doc_id): tuple(r)[2:] for r in grounding.excerpt_regions(spark.createDataFrame(asked, "item_id long, doc_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    known = dict(docs)
    assert got == {(k, d): plain_region(t or "", known[d]) for k, d, t in asked if known[d] is not None}


def test_grounded_excerpts(spark):
    copied = "The tower was built of brick and has a small door on its north side, they say."
    rng = random.Random(8)
    noise = lambda n: " ".join(f"noise{rng.randint(0, 99)}" for _ in range(n))
    docs = spark.createDataFrame([(1, f"{noise(900)}\n\n{copied.replace('brick', 'stone')}\n\n{noise(900)}"), (2, noise(50))], "doc_id long, text string")
    got = {r.doc_id: (r.score, r.found) for r in grounding.grounded_excerpts(spark.createDataFrame([(7, 1, copied), (7, 2, copied)], "item_id long, doc_id long, text string"), docs).collect()}
    assert got == {1: (0.875, copied.replace("brick", "stone")), 2: (0.0, None)}


def test_excerpts_of_sources_are_anchored_where_texts_lie(spark, monkeypatch):
    """Excerpts meet the texts of a source in parts; the same as pair by pair, and neither texts nor places are shuffled."""
    monkeypatch.setattr(grounding, "PART", 400)
    rng = random.Random(4)
    vocabulary = [f"{a}{b}{i}" for a in ("stone", "river") for b in ("gate", "") for i in range(12)]
    docs = [(i, f"s{i % 3}" if i % 7 else None, " ".join(rng.choices(vocabulary, k=rng.choice([0, 40, 300, 900])))) for i in range(30)] + [(40, "s1", None)]
    items = [(k, s, d[2][50:170] if k % 2 else " ".join(rng.choices(vocabulary, k=6))) for k, d in enumerate(rng.choices(docs[:30], k=12)) for s in ("s0", "s1")] + [(90, "s2", None), (91, None, "stone1"), (92, "s1", "a b")]
    texts = spark.createDataFrame(docs, "doc_id long, source string, text string")
    asked = spark.createDataFrame(items, "item_id long, source string, text string")
    each = spark.createDataFrame([(k, d, t) for k, s, t in items for d, own, _ in docs if s and s == own], "item_id long, doc_id long, text string")
    got = grounding.grounded_excerpts(asked, texts, by="source")
    want = sorted(map(tuple, grounding.grounded_excerpts(each, texts.drop("source")).collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    regions = grounding.excerpt_regions(asked, texts, by="source")
    whole = {(r.item_id, r.doc_id): r for r in regions.collect()}
    known = {d: t for d, _, t in docs}
    assert len(whole) == len(want) and all(tuple(whole[k, d])[2:] == plain_region(t or "", known[d]) for k, s, t in items for d, own, x in docs if s and s == own and x is not None)
    plain = grounding.anchored_excerpts(each.withColumnRenamed("text", "excerpt"), texts, regions).join(regions.select("item_id", "doc_id", "score"), ["item_id", "doc_id"])
    assert sorted(map(tuple, plain.select(*got.columns).collect()), key=str) == want and sum(r[5] is not None for r in want) > 5
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_windows_of_long_texts_are_counted_in_stretches(monkeypatch):
    monkeypatch.setattr(grounding, "SPAN", 3)
    rng = random.Random(6)
    for n in (5, 200, 1500):
        text = " ".join(rng.choices([f"word{i}" for i in range(30)], k=n))
        words = [rng.sample([f"word{i}" for i in range(40)], 5) for _ in range(20)]
        asked = grounding.Asked(pa.array([{"item_id": i, "words": " ".join(w), "text": ""} for i, w in enumerate(words)]))
        best, most = asked.best_windows(text, 800, 200)
        assert [(m * 200, round(h / 5, 6)) for m, h in zip(best.tolist(), most.tolist())] == [plain_region(" ".join(w), text)[:2] for w in words]


def test_repeated_and_failed_writes(spark, tmp_path):
    """A file is whole after a second write of the run, and stays as it was when a write fails."""
    rows = [(i, f"v2_x_{i}", "é 🙂" if i % 3 else None) for i in range(300)]
    questions = spark.createDataFrame(rows, "ord int, id string, question string").repartition(7)
    totals, at = spark.createDataFrame([(300, None)], "n_questions int, other string"), datetime.datetime(2024, 5, 12, 9, 30)
    for _ in range(2):
        path = sinks.write_test_set(questions, totals, str(tmp_path), "c", at, "r1")
        whole = json.load(open(path, encoding="utf-8"))
        assert [q["ord"] for q in whole["questions"]] == list(range(300)) and whole["questions"][1]["question"] == "é 🙂" and whole["summary"] == {"n_questions": 300, "other": None}
    broken = questions.withColumn("question", F.when(F.col("ord") == 299, F.raise_error(F.lit("broken"))).otherwise(F.col("question")))
    with pytest.raises(Exception, match="broken"):
        sinks.write_test_set(broken, totals, str(tmp_path), "c", at, "r2")
    assert json.load(open(path, encoding="utf-8")) == whole
    assert [f.name for f in (tmp_path / "c").iterdir()] == ["v2_c_12_05_24_T09_30.json"]
    empty = json.load(open(sinks.write_test_set(questions.limit(0), totals, str(tmp_path), "e", at, "r3"), encoding="utf-8"))
    assert empty["questions"] == []


def test_metrics_of_a_repeated_run_count_once(spark, tmp_path):
    for run, value in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        sinks.append_run_metrics(spark.createDataFrame([("m", value)], "metric string, value double"), run, str(tmp_path / "m"))
    assert {(r.run_id, r.value) for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {("a", 3.0), ("b", 2.0)}


def pages_of(data: bytes) -> list[str]:
    """Stands in for a PDF library: pages are cut at form feeds."""
    if data.startswith(b"broken"):
        raise ValueError("no pages")
    return data.decode().split("\f")


def test_pages_of_a_folder_go_through_as_sections(spark, tmp_path):
    rng = random.Random(5)
    body = lambda n=30: " ".join(rng.sample([f"word{i}x" for i in range(60)], n))
    chapters = [f"{i}. Chapter of {'abcd'[i - 1]} matters\n{body()} costs {100 + i} in all\n{i}.1 Part of it\n- {body(8)}\n- {body(8)}" for i in range(1, 5)]
    (tmp_path / "m.pdf").write_text("\f".join(chapters))
    (tmp_path / "a.PDF").write_text("broken")
    (tmp_path / "z.txt").write_text("\n\n".join(f"Start of part {i}\n{body()}" for i in range(4)))
    files, pages = corpus.folder_documents(spark, str(tmp_path), pages_of)
    rows = files.orderBy("doc_ord").collect()
    assert [(r.doc_id, r.filename, r.doc_type) for r in rows] == [(1, "m.pdf", "pdf"), (2, "z.txt", "txt")] and rows[0].raw_text == "\n".join(chapters)
    assert sorted((r.doc_id, r.page_no, r.text) for r in pages.collect()) == [(1, i + 1, c) for i, c in enumerate(chapters)]
    made = D.file_sections(files, pages)
    tops = {r.heading: r.all_text for r in made.where("is_top and source = 'm.pdf'").collect()}
    assert len(tops) == 4 and all("Part of it\n- " in t for t in tops.values()) and made.where("not is_top").count() == 4
    asked = run_files(spark, str(tmp_path), RunConfig({"direct_lookup": TypeConfig(True, 2), "lists_extraction": TypeConfig(True, 2), "long_context_synthesis": TypeConfig(True, 1)}), pages_of).collect()
    assert {r.type for r in asked} == {"direct_lookup", "lists_extraction", "long_context_synthesis"}
    assert "m.pdf" in {s for r in asked for s in r.source_documents}
    long = next(r for r in asked if r.type == "long_context_synthesis" and r.source_documents == ["m.pdf"])
    assert long.context == "\n\n".join(tops[h] for h in sorted(tops))


def test_folders_without_a_pdf_library_leave_pdf_files_out(spark, tmp_path):
    (tmp_path / "m.pdf").write_text("x")
    (tmp_path / "b.md").write_text("# A\nb")
    files, pages = corpus.folder_documents(spark, str(tmp_path))
    assert [r.filename for r in files.collect()] == ["b.md"] and pages is None
