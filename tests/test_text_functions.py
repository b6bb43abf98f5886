"""Facts, tags, normal forms and ratios on small texts with known answers."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.functions import text as X
from lexispark.functions import values as V
from lexispark.operators import sections as D


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


FACTS = [
    ("Signed 12-05-2024 and 12 mei 2024, also December 2025 and May 12, 2024.", {"dates": ["12-05-2024", "12 mei 2024", "December 2025", "May 12, 2024"], "numbers": ["12", "05", "2024", "12", "2024", "2025", "12", "2024"]}),
    ("Fee is € 1.250,50 or $99 or 40 euro; 12,5% of 2024 staff, 137 seats.", {"dates": ["2024"], "money": ["€ 1.250,50", "$99", "40 euro"], "numbers": ["12,5%", "250,50", "99", "40", "12,5", "137"]}),
    ("Call 020-1234567 or +31 20 1234567 or mail a.b@ex.org, see https://ex.org/x.", {"phones": ["020-1234567"], "emails": ["a.b@ex.org"], "urls": ["https://ex.org/x."]}),
    ("Grace period means thirty days. The Joint Review Board (JRB) meets on the 16e after vier weken.", {"dates": ["16e", "vier weken"], "terms": ["Grace period", "JRB"]}),
]


@pytest.mark.parametrize("text,want", FACTS)
def test_facts(spark, text, want):
    row = D.facts(spark.createDataFrame([(text,)], "text string")).first()
    for name, values in want.items():
        assert row[name] == values


def test_key_nouns(spark):
    assert set(value(spark, X.key_nouns, FACTS[0][0])) == {"December", "Signed"}
    assert set(value(spark, X.key_nouns, FACTS[3][0])) == {"Grace", "The Joint Review Board"}


def test_context_match_counts_chunks_inside_the_document(spark):
    context, document = "alpha beta gamma delta epsilon zeta", "alpha beta gamma delta x gamma delta epsilon zeta"
    row = spark.createDataFrame([(context, document, "", "one two")], "c string, d string, e string, s string")
    got = row.select(X.match_ratio(X.chunks(F.col("c")), F.col("c"), F.col("d")), X.match_ratio(X.chunks(F.col("e")), F.col("e"), F.col("d")), X.match_ratio(X.chunks(F.col("s")), F.col("s"), F.lit("zone two"))).first()
    assert tuple(got) == (1.0, 0.0, 1.0)


def test_grounding(spark):
    row = spark.createDataFrame([("the valve opens", "a valve that opens slowly", "", "of it")], "a string, p string, e string, s string")
    got = row.select(X.grounding_ratio(F.col("a"), F.col("p")), X.grounding_ratio(F.col("e"), F.col("p")), X.grounding_ratio(F.col("s"), F.lit("out of it"))).first()
    assert tuple(got) == (1.0, 0.0, 1.0)


def test_truncation_keeps_whole_sentences_beyond_the_middle(spark):
    cut = lambda t: value(spark, lambda c: X.truncated(c, 10), t)
    assert cut("short") == "short"
    assert cut("1234567. 90123") == "1234567."
    assert cut("12. 4567890123") == "12. 456789"


def test_contents_table(spark):
    assert value(spark, X.is_contents_table, "Intro 1\nScope 4\nTerms 9\nplain") is True
    assert value(spark, X.is_contents_table, "one line 1") is False


def test_boilerplate_needs_two_marks_or_a_short_text(spark):
    test = lambda t: value(spark, lambda c: X.is_boilerplate(c, X.word_count(c)), t)
    assert test("Copyright 2024, all rights reserved " + "word " * 30) is True
    assert test("copyright " + "word " * 30) is False
    assert test("copyright mine") is True


def test_tags(spark):
    rows = spark.createDataFrame([("- one\n- two", ), ("a\tb\tc\nd\te\tf",), ("a|b|c\nplain",), ("This means 50 things",)], "text string")
    got = [(r.has_list, r.has_table, r.has_definition, r.has_numbers) for r in D.tags(rows).collect()]
    assert got == [(True, False, False, False), (False, True, False, False), (False, False, False, False), (False, False, True, True)]


def test_small_helpers(spark):
    row = spark.createDataFrame([("C:\\A\\Doc.PDF", "multi_hop", "x" * 9)], "p string, n string, t string")
    assert tuple(row.select(X.basename(F.col("p")), X.title_of(F.col("n")), X.shortened(F.col("t"), 4)).first()) == ("doc.pdf", "Multi Hop", "xxxx…")


def test_long_runs_of_capitalised_words(spark):
    """A text of nothing but names; and the same phrases as the plain pattern, whose loop recurses, has."""
    plain = r"(?U)\b([A-ZÀ-ɏ][a-zÀ-ɏ]{2,}(?:\s+[A-ZÀ-ɏ][a-zÀ-ɏ]{2,})*)\b"
    rng = random.Random(12)
    parts = ("Abc", "Ab", "abc", "Éclair", "Ab÷", "Abc÷", "Abc÷de", "A×bc", "Abc9", "Abc_", "AbcD", "Ünd", "ÀÉÎ", "1Abc", "Abc-", "÷bc", "\u00a0")
    texts = ["".join(rng.choice(parts) + rng.choice([" ", " ", " ", "\n", "  ", ""]) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.regexp_extract_all("t", F.lit(plain), 1).alias("want"), X.found(F.col("t"), V.KEY_NOUN, 1).alias("got")).collect()
    assert all(r.got == r.want for r in rows) and sum(any(" " in x for x in r.got) for r in rows) > 500
    long = " ".join(["Name", "Other"] * 50_000)
    got = spark.createDataFrame([(f"{long} is 9.",)], "t string").select(X.key_nouns(F.col("t")).alias("x")).first().x
    assert got == [long]
