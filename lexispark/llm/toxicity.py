"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

A bounded sample of labelled rows (``SAMPLE`` of each label, those of the smallest hashes of
doc_id) is cut in fifths by a hash of doc_id, so that nothing is judged by what was learned from
it. Four fifths give the lexicon: words and word beginnings that stand far more often in toxic
than in other texts. Every text then gets dense features: densities of lexicon words and
beginnings, how near second-person pronouns stand, capitals, punctuation, and rates of
obfuscated spelling. The trees learn from the same four fifths, each measured by a lexicon of
the other three; the isotonic curve, from the last fifth. A row weighs as many labels as it
stands for, so that trees and curve learn the share of toxic rows among all labels, whatever the
input's size.

Defined cases: a null or empty text has all features zero and is scored as any other; rows
that repeat get equal scores; with no labelled rows or one label only, the score is the share
of label 1 (0 with none). Where the last fifth lacks a label, the curve takes all rows. doc_id is
a whole number.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import blocks, lowered_latin, prefix_sums, span_hash, words
from lexispark.llm.language_id import LETTER
from lexispark.llm.shared import labelled_sample

SAMPLE, ENTRIES, LEAST_TOXIC, LEAST_ODDS = 5_000, 1_000, 5, 8.0
TREES, DEPTH, NEAR, FOLDS = 20, 3, 6, 5
#: Lengths in bytes of the word beginnings that the lexicon may hold; 0 stands for whole words.
KINDS = (0, 4, 5, 6)

# Second-person pronouns of English, French, German and Spanish.
SECOND_PERSON = "you your yours yourself ya u tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer ti tú usted ustedes vosotros os".split()

FEATURES = (
    "word_density", "word_share", "start4_density", "start5_density", "start6_density", "any_hits", "near_second", "second_density",
    "capitals", "loud_words", "exclaims", "questions", "punctuation", "digits_inside", "signs_inside", "long_runs", "single_letters", "mean_word", "size",
)

NOT_LETTER = ~LETTER
UPPER, DIGIT, SIGN = (np.zeros(256, bool) for _ in range(3))
UPPER[0x41:0x5B], DIGIT[0x30:0x3A], SIGN[list(b"*@$!#+_")] = True, True, True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\")] = True


def entries(text: bytes) -> set[tuple[int, bytes]]:
    """What of a text may enter the lexicon: (kind, bytes)."""
    data = lowered_latin(np.frombuffer(text, np.uint8)).tobytes() if text else b""
    found = set(re.findall(rb"[a-z\x80-\xff]+", data))
    return {(k, w[:k] if k else w) for w in found for k in KINDS if k == 0 or len(w) > k}


def entry_counts(sample: DataFrame) -> DataFrame:
    """(fold, kind, entry, toxic, other): in how many texts of (text, label, fold) each entry stands."""

    def run(batches):
        for b in blocks(batches):
            seen, toxic = Counter(), Counter()
            labels, folds = b.column("label").to_pylist(), b.column("fold").to_pylist()
            for i in range(len(b)):
                own = [(folds[i], *e) for e in entries(b.raw(i))]
                seen.update(own)
                if labels[i]:
                    toxic.update(own)
            keys = list(seen)
            fold, kind, entry = zip(*keys, strict=True) if keys else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(fold, pa.int32()), pa.array(kind, pa.int32()), pa.array(entry, pa.binary()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([seen[k] - toxic[k] for k in keys], pa.int64())], ["fold", "kind", "entry", "toxic", "other"])

    counted = sample.select("text", "label", "fold").mapInArrow(run, "fold int, kind int, entry binary, toxic long, other long")
    return counted.groupBy("fold", "kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def lexicon(counted: DataFrame, texts: dict[int, tuple[int, int]], *without: int) -> list[tuple[int, bytes]]:
    """At most ENTRIES entries of each kind, of the highest odds in the folds but those ``without``; texts: toxic and other ones of each fold."""
    n_toxic, n_other = (sum(n[k] for fold, n in texts.items() if fold not in without) for k in (0, 1))
    summed = counted.where(~F.col("fold").isin(*without)).groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = (F.col("toxic") / max(n_toxic, 1)) / ((F.col("other") + 0.5) / (n_other + 1))
    strong = summed.where(F.col("toxic") >= LEAST_TOXIC).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("odds"), F.desc("toxic"), "entry"))
    return [(r.kind, bytes(r.entry)) for r in strong.withColumn("r", rank).where(F.col("r") <= ENTRIES).orderBy("kind", "r").collect()]


def hashes(found: list[bytes]) -> np.ndarray:
    """The sorted hashes of some words, as ``span_hash`` gives them inside texts."""
    data = np.frombuffer(b"".join(found), np.uint8)
    ends = np.cumsum([len(w) for w in found]) if found else np.zeros(0, np.int64)
    starts = ends - [len(w) for w in found] if found else ends
    return np.sort(span_hash(prefix_sums(data), starts.astype(np.int64), ends.astype(np.int64)))


def member(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def distance(doc: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Words between each word and the nearest marked one of its document; large where none is."""
    at, place, far = np.flatnonzero(marks), np.arange(len(doc)), 1 << 30
    if not len(at):
        return np.full(len(doc), far)
    i = np.searchsorted(at, place)
    left, right = at[np.maximum(i - 1, 0)], at[np.minimum(i, len(at) - 1)]
    gap = lambda other: np.where(doc[other] == doc, np.abs(other - place), far)
    return np.minimum(gap(left), gap(right))


def features(block, known: dict[int, np.ndarray], second: np.ndarray) -> np.ndarray:
    n, data = len(block), block.data
    row = np.repeat(np.arange(n), np.diff(block.offsets))
    low = lowered_latin(data)
    sums = prefix_sums(low)
    start, end, first = words(block, NOT_LETTER)
    doc = np.repeat(np.arange(n), np.diff(first))
    per = lambda mask, of: np.bincount(of[mask], minlength=n).astype(float)
    size = np.maximum(np.diff(first), 1)
    hit = {k: member(span_hash(sums, start, np.minimum(end, start + k) if k else end), known[k]) & ((end - start > k) | (k == 0)) for k in KINDS}
    some = np.logical_or.reduce([hit[k] for k in KINDS])
    whole = span_hash(sums, start, end)
    you = member(whole, second)
    near = some & (distance(doc, you) <= NEAR)
    letter, digit, sign, upper = LETTER[data], DIGIT[data], SIGN[data], UPPER[data]
    inside = lambda mask: np.concatenate([[False], letter[:-2] & mask[1:-1] & letter[2:] & (row[:-2] == row[2:]), [False]]) if len(data) > 2 else np.zeros(len(data), bool)
    runs = np.zeros(len(data), bool)
    if len(data) > 2:
        runs[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & letter[2:] & (row[2:] == row[:-2])
    capitals = np.concatenate([[0], np.cumsum(upper)])
    loud = (capitals[end] - capitals[start] == end - start) & (end - start > 1)
    letters = np.maximum(per(letter, row), 1)
    width = np.bincount(doc, weights=end - start, minlength=n)
    columns = [
        per(hit[0], doc) / size, per(hit[0], doc) > 0, *(per(hit[k], doc) / size for k in KINDS[1:]), np.log1p(per(some, doc)), per(near, doc) / size, per(you, doc) / size,
        per(upper, row) / letters, per(loud, doc) / size, per(data == 0x21, row) / size, per(data == 0x3F, row) / size, per(PUNCTUATION[data], row) / size,
        per(inside(digit), row) / size, per(inside(sign), row) / size, per(runs, row) / size, per(end - start == 1, doc) / size, width / size, np.log1p(np.diff(first)),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


def measured(docs: DataFrame, found: list[tuple[int, bytes]]) -> DataFrame:
    """doc_id and the FEATURES of every whole text."""
    name = docs.schema["doc_id"].dataType.simpleString()
    known = {k: hashes([w for kind, w in found if kind == k]) for k in KINDS}
    second = hashes([w.encode() for w in SECOND_PERSON])

    def run(batches):
        for b in blocks(batches):
            x = features(b, known, second)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c) for c in x.T.copy())], ["doc_id", *FEATURES])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, " + ", ".join(f"{c} double" for c in FEATURES))


def classify(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) of every row of docs; labelled has doc_id and label (0 or 1) of the rows to learn from."""
    labels = labelled.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    total = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    stands_for = F.when(F.col("label") == 1, max(1.0, total.get(1, 0) / sample)).otherwise(max(1.0, total.get(0, 0) / sample))
    fold = F.expr(f"cast(pmod(xxhash64(doc_id, 5), {FOLDS}) as int)")
    ids = labelled_sample(labels, sample, "label").select(F.col("doc_id").alias("__doc"), "label", stands_for.alias("weight"), fold.alias("fold")).checkpoint()
    # At most 2 * sample rows of a few numbers.
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__doc")).dropDuplicates(["__doc"]).select("__doc", "text", "label", "weight", "fold").checkpoint()
    texts = {r.fold: (r.toxic, r.other) for r in chosen.groupBy("fold").agg(F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") == 0).alias("other")).collect()}
    n, n_toxic = sum(map(sum, texts.values())), sum(t for t, _ in texts.values())
    counted = entry_counts(chosen).checkpoint()
    whole = lexicon(counted, texts, 0)
    rows = measured(docs, whole)
    if n_toxic in (0, n):
        return rows.select("doc_id", F.lit(n_toxic / n if n else 0.0).alias("score"))
    parts = {k: measured(chosen.where(F.col("fold") == k).withColumnRenamed("__doc", "doc_id"), lexicon(counted, texts, 0, k) if k else whole) for k in range(FOLDS)}
    all_parts = reduce(DataFrame.unionByName, parts.values())
    known = all_parts.join(F.broadcast(ids), F.col("doc_id") == F.col("__doc")).drop("doc_id").repartition(4, "__doc").coalesce(4).checkpoint()  # a session may deal to more; the trees pass over it many times
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="x")
    both = min(texts.get(0, (0, 0))) > 0
    learned = assemble.transform(known.where("fold > 0") if n_toxic - texts.get(0, (0, 0))[0] > 0 else known)
    held = assemble.transform(known.where("fold = 0") if both else known)
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3).fit(learned)
    raw = lambda df: trees.transform(df).withColumn("raw", vector_to_array("probability")[1])
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight", predictionCol="score").fit(raw(held))
    return curve.transform(raw(assemble.transform(rows)).select("doc_id", "raw")).select("doc_id", "score")
