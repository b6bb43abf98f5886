"""Segmentation of plain, markdown and paged texts."""

import re

from lexispark.operators import sections as D


def test_plain(spark):
    text = "Short.\n\nHeading line here\nbody one two\nbody three\n\nA single line paragraph of text."
    rows = D.plain_sections(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("sec_ord").collect()
    assert [(r.heading, r.content, r.char_start, r.char_end) for r in rows] == [
        ("Heading line here", "body one two\nbody three", 8, 49), ("A single line paragraph of text.", "A single line paragraph of text.", 51, 83),
    ]


def test_markdown(spark):
    docs = spark.createDataFrame([(1, "intro dropped\n# One\nalpha\n## Two\nbeta\n"), (2, "No headings in this one at all.")], "doc_id long, text string")
    rows = D.markdown_sections(docs).orderBy("doc_id", "sec_ord").collect()
    assert [(r.doc_id, r.heading, r.level, r.content, r.char_start) for r in rows[:2]] == [(1, "One", 0, "alpha", 14), (1, "Two", 1, "beta", 26)]
    assert rows[2].heading == rows[2].content == "No headings in this one at all."


def test_paged(spark):
    one = "1. First Chapter\n" + "text of the first chapter goes here\n2.4 Sub Part\nmore text of the sub part here"
    pages = [(1, 1, one), (1, 2, "2. Second Chapter\nand its long enough text"), (2, 1, "A page of its own\nwith enough text to be kept"), (2, 2, "tiny")]
    rows = D.paged_sections(spark.createDataFrame(pages, "doc_id long, page_no int, text string")).orderBy("doc_id", "sec_ord").collect()
    assert [(r.doc_id, r.heading, r.level, r.page_start) for r in rows] == [
        (1, "1. First Chapter", 0, 1), (1, "2.4 Sub Part", 1, 1), (1, "2. Second Chapter", 0, 2), (2, "A page of its own", 0, 1),
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert D.plain_sections(docs).count() == 0 and D.markdown_sections(docs).count() == 0


def test_markdown_headings_cross_line_ends(spark):
    texts = ["# \nTitle\nbody", "lost\n# A\nx\n##\n\nB b \ny\n#no\n##### five\n", "#  ", "plain text that is long enough to stay", None, "", "a\n#\n", "# é\u2028x\r\ny", "### Last"]
    rows = D.markdown_sections(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = []
    for i, t in enumerate(texts):
        found = list(re.finditer(r"^(#{1,4})\s+(.+)$", t or "", re.MULTILINE))
        for k, m in enumerate(found):
            end = found[k + 1].start() if k + 1 < len(found) else len(t)
            want.append((i, k, m[2].strip(), len(m[1]) - 1, t[m.end() : end].strip(), m.start(), end))
    assert sorted((r.doc_id, r.sec_ord, r.heading, r.level, r.content, r.char_start, r.char_end) for r in rows if r.doc_id != 3) == want
    assert [(r.heading, r.content) for r in rows if r.doc_id == 3] == [(texts[3], texts[3])] and want[0][2] == "Title"
