"""Language identification by nearest centroids of normalised TF-IDF n-gram vectors.

Byte n-grams (1 to 3, letters in lower case, all else one space) are hashed into ``DIMS``
buckets. The document frequencies come from all training documents. The vectors of a bounded
sample (``PER_LANG`` documents of each language, those of the smallest hashes of doc_id) are
clustered by spherical k-means into ``CENTROIDS`` unit centroids for each language. A text
gets the language of its nearest centroid by cosine. It is rejected when its distance from
that centroid is beyond what the training documents of that language and length show:
median + ``SPREADS`` times (90 % quantile - median), taken over all of them, and ``FARTHEST`` at
most: what has hardly an n-gram in common with any centroid is no known language. The quantiles come
from counts in fixed bins of the distance, so they don't depend on how rows are dealt out. A
length that no training document of the language has takes the bound of the nearest one that
some have; a language that none was taken for, the bound of all; ``FARTHEST`` alone bounds
where docs has no training document.

Defined cases: a null text, or one without any letter, is ``und`` with score 0 and rejected;
so is every text where nothing could be learned. Rows without doc_id are never learned from.
doc_id is a whole number. Only doc_id, text and lang are read, lang from training rows alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import blocks, lowered_latin
from lexispark.llm.shared import PIECES, labelled_sample, pieces, sum_arrays

DIMS, PER_LANG, CENTROIDS, ROUNDS = 4096, 600, 4, 12
SPREADS, LEAST_SPREAD, FARTHEST, SHARPNESS = 6.0, 0.03, 0.97, 12.0
UNKNOWN = "und"
#: Bytes and rows of text that are counted at a time; each row's counts take 8 * DIMS bytes.
BLOCK_BYTES, BLOCK_ROWS = 1 << 18, 64
#: Bins of a distance from 0 to 1 (a cosine of counts is never negative); length classes of texts, powers of two.
BINS, LENGTHS = 1_000, 15

#: Bytes of letters: ASCII letters and everything beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def counts(block) -> np.ndarray:
    """n-gram counts of the rows of a block, rows x DIMS."""
    n = len(block)
    data = np.where(LETTER[block.data], lowered_latin(block.data), np.uint8(0x20))
    row = np.repeat(np.arange(n), np.diff(block.offsets))
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20) | (row[1:] != row[:-1])
    data, row = data[keep].astype(np.uint64), row[keep]
    total = np.zeros(n * DIMS, np.int64)
    gram = np.zeros(len(data), np.uint64)
    for k in range(3):
        if k and len(data) <= k:
            break
        gram = data if not k else (gram[:-1] << np.uint64(8)) | data[k:]
        same = row[: len(row) - k] == row[k:]
        plain = gram != 0x20 if not k else gram != 0x2020 if k == 1 else gram != 0x202020
        use = same & plain
        bucket = ((gram[use] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(52)).astype(np.int64)
        total += np.bincount(row[: len(row) - k][use] * DIMS + bucket, minlength=n * DIMS)
    return total.reshape(n, DIMS)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vectors(block, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts(block)).astype(np.float32) * idf)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; always the same for the same rows."""
    centres = unit(x.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(axis=1))]])
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(axis=1)
        centres = unit(np.vstack([x[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))]))
    return centres


@dataclass
class LanguageModel:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray  # languages x CENTROIDS x DIMS; a missing one repeats its language's first

    def similarities(self, block) -> np.ndarray:
        flat = self.centroids.reshape(-1, DIMS)
        return (vectors(block, self.idf) @ flat.T).reshape(len(block), len(self.languages), -1).max(axis=2)


def learn(training: DataFrame) -> LanguageModel:
    """From (doc_id, text, lang) of the training documents."""
    training = training.where("doc_id is not null and text is not null and lang is not null").select("doc_id", "text", "lang")

    def frequencies(batches):
        total, n = np.zeros(DIMS + 1, np.int64), 0
        for b in blocks(batches, BLOCK_BYTES, max_rows=BLOCK_ROWS):
            total[:DIMS] += (counts(b) > 0).sum(axis=0)
            n += len(b)
        total[DIMS] = n
        yield from pieces(total)

    found = sum_arrays(training.select("text").mapInArrow(frequencies, PIECES), DIMS + 1)
    idf = (np.log((1 + found[DIMS]) / (1 + found[:DIMS])) + 0.1).astype(np.float32)
    # At most PER_LANG ids of each language.
    ids = labelled_sample(training.select("doc_id", "lang"), PER_LANG, "lang").select("doc_id")
    sample = training.join(F.broadcast(ids), "doc_id", "left_semi")

    def vectorise(batches):
        for b in blocks(batches, BLOCK_BYTES, max_rows=BLOCK_ROWS):
            rows = [x.tobytes() for x in vectors(b, idf)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("lang"), pa.array(rows, pa.binary())], ["doc_id", "lang", "vector"])

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("doc_id").sort_values("doc_id")
        x = np.frombuffer(b"".join(rows["vector"]), np.float32).reshape(-1, DIMS)
        centres = k_means(x, CENTROIDS)
        centres = np.vstack([centres, np.repeat(centres[:1], CENTROIDS - len(centres), axis=0)])
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "centres": [centres.astype(np.float32).tobytes()]})

    made = sample.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(vectorise, "doc_id long, lang string, vector binary")
    rows = sorted(made.groupBy("lang").applyInPandas(cluster, "lang string, centres binary").collect())
    centroids = np.frombuffer(b"".join(r.centres for r in rows), np.float32).reshape(len(rows), CENTROIDS, DIMS)
    return LanguageModel(idf, [r.lang for r in rows], centroids)


def score(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, distance, size_bin) of every whole text; size_bin grows with the length."""
    name = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some hundred KB: languages x CENTROIDS x DIMS
    known = bool(model.languages)

    def run(batches):
        own = sent.value
        languages = np.array([*own.languages, UNKNOWN], object)
        for b in blocks(batches, BLOCK_BYTES, max_rows=BLOCK_ROWS):
            n = len(b)
            best, share, near = np.full(n, len(languages) - 1), np.zeros(n), np.zeros(n)
            if known:
                alike = own.similarities(b)
                letters = b.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                weights = np.exp(SHARPNESS * (alike - alike.max(axis=1, keepdims=True)))
                best = np.where(letters, alike.argmax(axis=1), best)
                share = np.where(letters, 1 / weights.sum(axis=1), 0.0)
                near = np.where(letters, alike.max(axis=1), 0.0)
            size = np.minimum(np.log2(np.diff(b.offsets) + 1).astype(np.int32), LENGTHS - 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(languages[best], pa.string()), pa.array(share.astype(np.float64)), pa.array(1.0 - near.astype(np.float64)), pa.array(size)], ["doc_id", "lang_pred", "score", "distance", "size_bin"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select("doc_id", "text", lettered).mapInArrow(run, f"doc_id {name}, lang_pred string, score double, distance double, size_bin int")


def bound_of(counts: np.ndarray) -> float:
    """The largest distance that is no outlier, from counts of distances by bin; a quantile is its bin's upper end."""
    upto = np.cumsum(counts)
    half, most = (float(np.searchsorted(upto, q * upto[-1]) + 1) / BINS for q in (0.5, 0.9))
    return min(half + SPREADS * max(most - half, LEAST_SPREAD), FARTHEST)


def bounds(seen: DataFrame, languages: list[str]) -> DataFrame:
    """(lang_pred, size_bin, bound) for every language and length."""
    spark = seen.sparkSession
    binned = seen.groupBy("lang_pred", "size_bin", F.least(F.floor(F.col("distance") * BINS), F.lit(BINS)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    counts = np.zeros((len(languages), LENGTHS, BINS + 1), np.int64)
    for r in binned.collect():  # at most languages x LENGTHS x (BINS + 1) counts
        counts[languages.index(r.lang_pred), r.size_bin, max(r.bin, 0)] = r.n
    every, rows = counts.sum(axis=(0, 1)), []
    for language, own in zip(languages, counts, strict=True):
        filled = np.flatnonzero(own.sum(axis=1))
        for length in range(LENGTHS):
            chosen = own[filled[np.argmin(np.abs(filled - length))]] if len(filled) else every
            rows.append((language, length, bound_of(chosen) if chosen.any() else FARTHEST))
    return spark.createDataFrame(rows, "lang_pred string, size_bin int, bound double")


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """(doc_id, lang_pred, score, distance, rejected) of every row of docs; training has doc_id, text and lang."""
    model = learn(training)
    scored = score(docs, model).checkpoint()
    ids = training.where("lang is not null").select(F.col("doc_id").alias("__doc")).distinct()
    seen = scored.join(ids, scored["doc_id"] == ids["__doc"], "left_semi").where(F.col("lang_pred") != UNKNOWN)
    judged = scored.join(F.broadcast(bounds(seen, model.languages)), ["lang_pred", "size_bin"], "left")
    beyond = (F.col("lang_pred") == UNKNOWN) | F.coalesce(F.col("distance") > F.col("bound"), F.lit(False))
    return judged.select("doc_id", "lang_pred", "score", "distance", beyond.alias("rejected"))
