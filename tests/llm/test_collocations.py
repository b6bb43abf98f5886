"""Phrases against a plain count, whatever the size of shards, groups and the bit table."""

import collections
import random
import re

import pytest

from lexispark.llm import collocations as C
from lexispark.llm.shared import ready

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, longest, least, top, percent=50):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, count in f.items():
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = collections.Counter()
        for p, a in good.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered[p[i : i + size]], a)
        rated = []
        for p, a in good.items():
            if 100 * covered[p] >= percent * a:
                continue
            score, _, left, right = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rated.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rated)[:top])]
    return sorted(out)


def corpus(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    some = ["The", "of", "été", "日本", "new", "york", "a", "b", "x-y", "Q R"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n):
        words = rng.choices(some, [9, 7, 2, 2, 4, 1, 5, 5, 2, 1] + [1] * 12, k=rng.randint(0, 120))
        text = "".join(w + (" york" if w == "new" else "") + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "; ", " \r\n", "!?"]) for w in words)
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), text))
    return rows + [("en", None), ("en", ""), (None, " \t\n"), ("de", "a a a a a a a a a a a a"), ("de", ".,;"), ("en", rows[0][1]), ("en", rows[0][1]), ("xx", "one two")]


def frame(spark, rows):
    ready(spark)
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, 3) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, size int, f long, rank long").repartition(3)


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 10, 2000), (2, 3, 5), (4, 4, 50)])
def test_phrases(spark, longest, least, top):
    rows = corpus(longest)
    got = C.collocations(frame(spark, rows), longest, least, top).collect()
    assert sorted(map(tuple, got)) == plain(rows, longest, least, top)
    assert len(got) > 10


@pytest.mark.parametrize(("shard", "group", "table"), [(40, 1 << 16, 27), (1 << 20, 7, 27), (300, 5, 18)])
def test_cuts(spark, monkeypatch, shard, group, table):
    """Texts over a shard's size are cut between words; a phrase over a cut counts once."""
    rows = corpus(9, 25)

    def short(batches):
        C.SHARD, C.GROUP, C.TABLE, C.ROWS = shard, group, table, 3
        yield from C.short_phrases(batches)

    def longer(size, bits):
        def run(batches):
            C.SHARD, C.GROUP, C.TABLE, C.ROWS = shard, group, table, 3
            yield from C.longer_phrases(size, bits)(batches)

        return run

    docs = frame(spark, rows).selectExpr("coalesce(lang, 'und') AS lang", "text").where("text is not null")
    monkeypatch.setattr(C, "TABLE", table)
    found = C.stored(C.summed(docs.mapInArrow(short, C.COUNTS), 3), "phrases")
    bits = spark.sparkContext.broadcast(C.bit_table(found.where("size > 1")))
    tri = C.summed(docs.mapInArrow(longer(3, bits), C.COUNTS), 3)
    monkeypatch.undo()
    want = C.count_phrases(frame(spark, rows), 3, 3).collect()
    assert sorted(map(tuple, found.unionByName(tri).collect())) == sorted(map(tuple, want))


def test_nothing(spark):
    assert C.collocations(frame(spark, [])).collect() == []
    assert C.collocations(frame(spark, [(None, None), ("en", "")])).collect() == []


def test_exact_products(spark):
    """Counts whose products pass 64 bits."""
    big = 10**13
    score = spark.range(1).selectExpr(f"{big + 7} AS a", f"{big + 9} AS l", f"{3 * big + 1} AS r").selectExpr("(cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) AS s").first().s
    assert score == 10**6 * (big + 7) ** 2 // ((big + 9) * (3 * big + 1))
