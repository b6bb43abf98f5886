"""Quality rules and decontamination: results, and plans without Python."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.llm import decontamination
from lexispark.llm.decontamination import find_passages, proximity_matches
from lexispark.llm.quality_rules import STOP_WORDS, Rule, apply_rules

from . import brute


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quality_rules(docs, texts, empty):
    got = apply_rules(docs)
    rows = got.collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == sorted((d, *brute.quality(t)) for d, t in texts)
    assert all(not r.kept for r in rows if r.base_failed)
    assert {r.doc_id for r in rows if r.kept == bool(r.broken)} == set()
    assert "Python" not in plan(got) and "Pandas" not in plan(got)
    assert apply_rules(empty).count() == 0


def test_kept_texts(spark, texts):
    plain = "The reader of the book is in the room and it was not a long way to the door by the window of it all."
    made = [plain, plain.upper(), plain + " #$%&" * 9, plain.replace("the ", "the!! "), (plain[:60] + "\n") * 3 + plain, plain.replace(" the", " xyz").replace(" of", " q").replace(" is", "").replace(" it", ""), " ".join("of a" for _ in range(20)), "verylongwordindeed " * 30 + plain]
    rows = [(i, t) for i, t in enumerate(made + [t for _, t in texts])] + [(None, plain)]
    got = {(r.doc_id, r.kept) for r in apply_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(i, brute.quality_kept(t, STOP_WORDS)) for i, t in rows}
    assert {(i, t) for i, t in got if i in (0, None)} == {(0, True), (None, True)} and {kept for i, kept in got if i is not None and i < 8} == {True, False}


def test_other_rules(docs):
    only = (Rule("some_words", "n_words", 100, "one", at_least=True),)
    assert {r.doc_id for r in apply_rules(docs, only, ()).where("not kept").collect()} == {70, 71, 72}


@pytest.mark.parametrize("sent", [32 << 20, 0])
def test_decontamination(docs, texts, bench, empty, monkeypatch, sent):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", sent)
    monkeypatch.setattr(decontamination, "HOT_WORDS", 1_000 if sent else 9)
    items = [(r.item_id, r.text) for r in bench.collect()]
    found = find_passages(docs, bench)
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in found.collect())
    assert got == sorted((d, *brute.passages(t, items)) for d, t in texts)
    assert {r.doc_id for r in found.where("contaminated").collect()} == {80, 81}
    assert "Python" not in plan(found) and "Pandas" not in plan(found)
    assert find_passages(empty, bench).count() == 0
    assert find_passages(docs, bench.limit(0)).where("contaminated").count() == 0


def test_documents_without_id_are_searched_too(spark, bench):
    rows = spark.createDataFrame([(None, "short phrase here"), (None, "nothing"), (1, "short phrase here")], "doc_id long, text string")
    assert sorted(r.n_hit for r in find_passages(rows, bench).collect()) == [0, 3, 3]


def test_passages_of_long_items_and_frequent_words(spark, monkeypatch):
    rng = random.Random(2)
    items = [(1, " ".join(rng.choices("abcd", k=40))), (2, "a"), (3, " ".join(rng.choices("abcdefgh", k=25))), (4, "b a"), (3, "a b c d e f g h a b c d")]
    rows = [(i % 50, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 120)))) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choices("xyza", k=9)) + " " + items[i % 2 * 2][1] + " z " + items[i % 2 * 2][1][11:31]) for i in range(6)]
    rows += [(3, rows[3][1]), (None, items[2][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    key = lambda d: -1 if d is None else d
    want = sorted((key(d), *brute.passages(t, items)) for d, t in rows)
    for sent in (32 << 20, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", sent)
        monkeypatch.setattr(decontamination, "HOT_WORDS", 5)
        assert sorted((key(r.doc_id), r.n_words, r.n_hit, list(r.item_ids)) for r in find_passages(docs, bench).collect()) == want


def test_proximity(spark, bench):
    rows = spark.createDataFrame([(1, "short and then a phrase here"), (2, "short " + "far " * 30 + "phrase here")], "doc_id long, text string")
    assert {r.doc_id for r in proximity_matches(rows, bench, 4).where(F.col("item_id") == 2).collect()} == {1}
