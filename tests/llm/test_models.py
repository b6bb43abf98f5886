"""The three learned operators: held-out accuracy on made-up classes, and their defined cases."""

import random

import math
import os
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.llm import language_id, quality_classifier, queries, toxicity
from lexispark.llm.arrowtext import blocks
from lexispark.llm.language_id import identify
from lexispark.llm.shared import labelled_sample

from .conftest import frame

TABLES = "/root/testdata/sf0.01"
TEXTS = ["You are a NASTY fool, you!!", "", "Été à l'école; ÊTRE heureux 123", "aaa b4d w*rd you", "日本語 and ßtraße", "one two", "  spaced   out\nlines "]

SOUNDS = {"aa": ["lo", "mi", "sta", "ren"], "bb": ["kx", "zq", "vuw", "py"]}


def made(seed, sounds, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(sounds, k=rng.randint(1, 3))) for _ in range(n))


def test_language(spark, docs, texts, empty):
    rows = [(i, made(i, SOUNDS[k]), k) for i, k in enumerate(["aa", "bb"] * 60)]
    training = spark.createDataFrame([*rows[:80], (None, "lo", "bb"), (500, None, "aa"), (501, "lo", None)], "doc_id long, text string, lang string")
    test = frame(spark, [(i, t) for i, t, _ in rows[80:]] + [(900, None), (901, "123 !!"), (902, ""), (903, "日本語 日本語 日本語 日本語 日本語 日本語 日本語 日本語 日本語"), (904, rows[0][1] * 400)])
    got = {r.doc_id: r for r in identify(test, training).collect()}
    assert [got[i].lang_pred for i, _, _ in rows[80:]] == [k for _, _, k in rows[80:]]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].lang_pred == "und" and got[i].rejected for i in (900, 901, 902))
    assert sum(got[i].rejected for i, _, _ in rows[80:]) == 0
    assert got[903].rejected and not got[904].rejected  # far from all centroids; a length that no training text has
    nothing = identify(docs, training.limit(0)).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == len(texts)
    assert identify(empty, training).count() == 0


def test_quality(spark, docs, texts, empty):
    rng = random.Random(0)
    rows = [(i, made(i, SOUNDS["aa"]) if i % 3 else " ".join(w.upper() + "!!" for w in made(i, SOUNDS["aa"]).split()), int(i % 3 > 0)) for i in range(240)]
    rng.shuffle(rows)
    labels = spark.createDataFrame([(d, y) for d, _, y in rows[:160]] + [(None, 1), (rows[0][0], rows[0][2])], "doc_id long, label int")
    all_docs = frame(spark, [(d, t) for d, t, _ in rows] + [(1000, None), (1001, ""), (1002, "a " * 50_000)])
    got = {r.doc_id: r.score for r in quality_classifier.classify(all_docs, labels).collect()}
    assert sum((got[d] >= 0.5) == bool(y) for d, _, y in rows[160:]) >= 78
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 243
    assert {r.score for r in quality_classifier.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.classify(empty, labels).count() == 0


def test_toxicity(spark, docs, empty):
    rows = []
    for i in range(300):
        w = made(i, SOUNDS["aa"]).split()
        if i % 4 == 0:
            for k in range(3):
                w.insert((i * 7 + k * 13) % len(w), ["you nastyword", "fieldfool", "NASTYWORD!"][k])
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    labels = spark.createDataFrame([(d, y) for d, _, y in rows[:200]], "doc_id long, label int")
    all_docs = frame(spark, [(d, t) for d, t, _ in rows] + [(1000, None), (1001, ""), (1002, "lo " * 50_000)])
    got = {r.doc_id: r.score for r in toxicity.classify(all_docs, labels).collect()}
    assert sum((got[d] >= 0.5) == bool(y) for d, _, y in rows[200:]) >= 97
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 303
    assert got[1000] == got[1001] < 0.5
    assert {r.score for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.classify(empty, labels).count() == 0


def test_toxicity_keeps_the_share_of_toxic_rows_when_the_sample_is_full(spark):
    rows = [(i, made(i, SOUNDS["aa"], 20), int(i % 6 == 0)) for i in range(600)]  # the texts tell nothing of the label
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, label int")
    scores = [r.score for r in toxicity.classify(frame(spark, [(d, t) for d, t, _ in rows]), labels, sample=100).collect()]
    assert abs(sum(scores) / len(scores) - 1 / 6) < 0.1


def block_of(texts):
    return next(blocks([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])]))


def small(text: str) -> str:
    """A-Z and Latin-1 capitals in lower case."""
    return "".join(c.lower() if c < "\x80" or "À" <= c <= "Þ" and c != "×" else c for c in text)


def test_language_vectors_equal_a_plain_version():
    """Byte n-grams counted in a plain loop, hashed to the same buckets."""
    got = language_id.counts(block_of(TEXTS))
    want = np.zeros_like(got)
    for row, text in enumerate(TEXTS):
        data = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 0x20 for c in small(text).encode())
        data = re.sub(rb" +", b" ", data)
        for k in range(3):
            for i in range(len(data) - k):
                gram = int.from_bytes(data[i : i + k + 1], "big")
                if data[i : i + k + 1].strip(b" "):
                    bucket = ((gram * 0x9E3779B97F4A7C15 + k) % 2**64 * 0xD6E8FEB86659FD93 % 2**64) >> 52
                    want[row, bucket] += 1
    assert (got == want).all()


def test_centroids_are_unit_means_of_the_nearest_vectors():
    rng = np.random.default_rng(3)
    x = language_id.unit(np.abs(rng.normal(size=(60, 12))) + np.repeat(np.eye(3, 12) * 9, 20, axis=0))
    centres = language_id.k_means(x, 3)
    near = (x @ centres.T).argmax(axis=1)
    assert len({tuple(near[i : i + 20]) for i in (0, 20, 40)}) == 3 and all(len(set(near[i : i + 20])) == 1 for i in (0, 20, 40))
    for j in range(3):
        assert np.allclose(centres[j], x[near == j].mean(axis=0) / np.linalg.norm(x[near == j].mean(axis=0)))


def test_bounds_of_distances():
    counts = np.zeros(language_id.BINS + 1, np.int64)
    counts[[100, 200, 400]] = 5, 4, 1  # median in bin 100, 90 % in bin 200
    assert math.isclose(language_id.bound_of(counts), 0.101 + 6 * 0.1)
    counts[900] = 4
    assert language_id.bound_of(counts) == language_id.FARTHEST


def test_samples_are_the_smallest_hashes(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 == 0).cast("int").alias("label"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    for label, n in ((0, 300), (1, 100)):
        own = rows.where(F.col("label") == label)
        want = {r.doc_id for r in own.orderBy(place, "doc_id").limit(300).collect()}
        got = [r.doc_id for r in labelled_sample(rows.repartition(7), 300, "label").where(F.col("label") == label).collect()]
        assert set(got) == want and len(got) == n
    assert labelled_sample(rows, 10).count() == 10 and labelled_sample(rows.limit(0), 10, "label").count() == 0


def test_context_vectors_equal_a_plain_version(spark):
    """Index vectors of neighbours at most two words away, added up in a plain loop."""
    texts = ["One two three two", "two", "", "three One one"]
    got = quality_classifier.contexts(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows, places = len(got), quality_classifier.all_places(quality_classifier.WORDS)
    signs = np.array([1, -1, 1, -1])
    total = np.zeros((rows, quality_classifier.DIMS))
    for t in texts:
        word, shape, _ = quality_classifier.tokens(block_of([t]))
        for own in (word, shape):
            for i in range(len(own)):
                for j in range(max(0, i - 2), min(len(own), i + 3)):
                    if i != j:
                        total[own[i], places[own[j]]] += signs
    for part, have in ((total[:-2048], got[:-2048]), (total[-2048:], got[-2048:])):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1)
        part -= part.mean(axis=0)
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
        assert np.allclose(part, have, atol=1e-5)
    word, shape, _ = quality_classifier.tokens(block_of(["ONE two TWO A-9 b-7"]))
    assert len(set(word)) == 5 and shape[0] == shape[2] != shape[1] and shape[3] != shape[4]


def test_index_rows_follow_the_vocabulary(spark):
    rows = lambda n: quality_classifier.vocabulary_rows(spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)),)], "text string"))
    assert (rows(0), rows(500), rows(20_000), rows(200_000)) == (1 << 13, 1 << 13, 1 << 15, quality_classifier.MOST_WORDS)


def test_pooled_texts_equal_a_plain_version():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(quality_classifier.WORDS + quality_classifier.SHAPES, quality_classifier.DIMS)).astype(np.float32)
    got = quality_classifier.pooled(block_of(TEXTS), np.hstack([vectors, vectors * vectors]))
    d = quality_classifier.DIMS
    for row, text in enumerate(TEXTS):
        word, shape, _ = quality_classifier.tokens(block_of([text]))
        for k, own in enumerate((word, shape)):
            part = got[row, k * (2 * d + 2) : (k + 1) * (2 * d + 2)]
            x = vectors[own] if len(own) else np.zeros((1, d))
            agree = sum(float(a @ b) for a, b in zip(x, x[1:], strict=False)) / max(len(own), 1)
            same = sum(a == b for a, b in zip(own, own[1:], strict=False)) / max(len(own), 1)
            assert np.allclose(part, [*x.mean(axis=0), *x.std(axis=0), agree, same], atol=1e-3)


def test_toxic_features_equal_a_plain_version():
    found = [(0, b"fool"), (4, b"nast"), (5, b"heure")]
    known = {k: toxicity.hashes([w for kind, w in found if kind == k]) for k in toxicity.KINDS}
    second = toxicity.hashes([w.encode() for w in toxicity.SECOND_PERSON])
    got = toxicity.features(block_of(TEXTS), known, second)
    at = {c: i for i, c in enumerate(toxicity.FEATURES)}
    for row, text in enumerate(TEXTS):
        w = re.findall(r"[a-z\x80-\U0010ffff]+", small(text))
        size, bytes_of = max(len(w), 1), [x.encode() for x in w]
        hits = [x == b"fool" or any(len(x) > k and x[:k] == e for k, e in found[1:]) for x in bytes_of]
        you = [i for i, x in enumerate(w) if x in toxicity.SECOND_PERSON]
        letters = max(sum(c in b"abcdefghijklmnopqrstuvwxyz" or c >= 128 for c in text.encode().lower()), 1)
        want = {
            "word_density": sum(x == b"fool" for x in bytes_of) / size, "start4_density": sum(len(x) > 4 and x[:4] == b"nast" for x in bytes_of) / size, "any_hits": math.log1p(sum(hits)),
            "near_second": sum(h and any(abs(i - y) <= toxicity.NEAR for y in you) for i, h in enumerate(hits)) / size, "second_density": len(you) / size, "capitals": sum("A" <= c <= "Z" for c in text) / letters,
            "exclaims": text.count("!") / size, "digits_inside": len(re.findall(r"(?<=[a-z])\d(?=[a-z])", text)) / size, "signs_inside": len(re.findall(r"(?<=[a-z])[*@$!#+_](?=[a-z])", text)) / size, "size": math.log1p(len(w)),
        }
        for name, value in want.items():
            assert math.isclose(got[row, at[name]], value, abs_tol=1e-9), (name, text)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the given tables")
def test_held_out_rows_of_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = [r for r in queries.op2_language_id(spark, TABLES).collect() if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in found) >= 0.98 * len(found) > 300
    for query, column, floor in ((queries.op7_quality_classifier, "quality", 0.94), (queries.op10_toxicity, "toxic", 0.94)):
        marked = {r.doc_id: r[column] for r in labels.collect()}
        found = [r for r in query(spark, TABLES).collect() if r.held_out and r.doc_id in marked]
        assert sum(r.predicted == marked[r.doc_id] for r in found) >= floor * len(found) > 50


def test_repeated_rows_ties_and_clashing_columns(spark, docs, texts):
    rows = frame(spark, [(1, "lo mi sta"), (1, "lo mi sta"), (1, "ren ren"), (None, "lo mi sta"), (2, "LO!! MI!!")])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (7, 5), (3, None)], "doc_id long, label int")
    for module in (quality_classifier, toxicity):
        got = module.classify(rows, labels).collect()
        assert len(got) == 5 and len({r.score for r in got if r.doc_id != 2 and r.doc_id is None}) == 1
        assert module.classify(docs, labels.where("doc_id = 1")).count() == len(texts)  # one kind of label only
    training = spark.createDataFrame([(1, "lo mi sta", "aa"), (1, "lo mi sta", "aa"), (2, "kx zq vuw", "bb")], "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang_pred) for r in identify(rows, training).collect()}
    assert (1, "aa") in got and len(identify(rows, training).collect()) == 5
