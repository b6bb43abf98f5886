"""A quality classifier: random-indexing word vectors, pooled, and a two-layer network in numpy.

Every word has a sparse random index vector, given by its hash. Its context vector is the sum
of the index vectors of the words at most two places away, over all documents (without any
label). Two kinds of word are indexed: the word itself, in hashed rows, and its shape (runs of
capitals, small letters and digits, and the signs as they are), in ``SHAPES`` rows. There are as
many hashed rows as the corpus has different words, counted first, between ``WORDS`` and
``MOST_WORDS``; beyond that several rare words share a row.
A document is the mean and the spread of its words' unit context vectors, and how well
neighbours agree. A network with one hidden layer learns from a bounded sample of labelled
rows (``SAMPLE``, those of the smallest hashes of doc_id); a tenth of the sample sets the
temperature of its probabilities.

Defined cases: a null or empty text is pooled to zeros and gets a score as any other; rows that
repeat get equal scores; with no labelled rows, or rows of one kind only, the score is the
share of label 1 (0.5 with none). doc_id is a whole number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import blocks, prefix_sums, span_hash, words
from lexispark.llm.shared import PIECES, labelled_sample, pieces, sum_arrays

WORDS, MOST_WORDS, SHAPES, DIMS, NONZERO, REACH = 1 << 13, 1 << 15, 2048, 32, 4, 2
#: Bits of the bitmap that counts different words; places of context vectors gathered before they are added up.
BITMAP_BITS, GATHERED = 20, 1 << 22
SAMPLE, HIDDEN, EPOCHS, BATCH, RATE, DECAY = 10_000, 32, 30, 128, 2e-3, 1e-4
FEATURES = 4 * DIMS + 6
#: Bytes of text handled at a time, so that the words' vectors stay in a core's cache.
BLOCK_BYTES = 1 << 17

#: Classes of bytes in a shape: capitals, small letters (and all beyond ASCII), digits; signs stand for themselves.
CLASS = np.arange(256, dtype=np.uint8)
CLASS[0x41:0x5B] = ord("X")
CLASS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = ord("x")
CLASS[0x30:0x3A] = ord("9")


def index_places(rows: int, seed: int) -> np.ndarray:
    """Sparse random index vectors by their NONZERO places: +1 at the even ones, -1 at the odd ones."""
    return np.random.default_rng(seed).random((rows, DIMS)).argsort(axis=1)[:, :NONZERO]


def all_places(n_words: int) -> np.ndarray:
    return np.vstack([index_places(n_words, 11), index_places(SHAPES, 13)])


def vocabulary_rows(docs: DataFrame) -> int:
    """A power of two that the number of different words does not pass, within WORDS and MOST_WORDS; counted by a bitmap."""
    size = 1 << BITMAP_BITS

    def run(batches):
        seen = np.zeros(size, bool)
        for b in blocks(batches):
            start, end, _ = words(b)
            seen[(span_hash(prefix_sums(b.data), start, end) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)] = True
        yield from pieces(seen.astype(np.int8))

    free = size - int((sum_arrays(docs.select("text").mapInArrow(run, PIECES), size, np.int8) > 0).sum())
    estimate = size * np.log(size / max(free, 1))
    return int(min(max(WORDS, 1 << int(np.ceil(np.log2(max(estimate, 1))))), MOST_WORDS))


def tokens(block, n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of each word and of its shape among the index vectors, and the document of each word."""
    start, end, first = words(block)
    word = (span_hash(prefix_sums(block.data), start, end) % np.uint64(n_words)).astype(np.int64)
    classes = CLASS[block.data]
    fresh = np.ones(len(classes), bool)
    fresh[1:] = classes[1:] != classes[:-1]
    fresh[start] = True
    place = np.concatenate([[0], np.cumsum(fresh)])
    shape = (span_hash(prefix_sums(classes[fresh]), place[start], place[end]) % np.uint64(SHAPES)).astype(np.int64) + n_words
    return word, shape, np.repeat(np.arange(len(block)), np.diff(first))


def contexts(docs: DataFrame, n_words: int = WORDS) -> np.ndarray:
    """Unit context vectors of all words and shapes, from all documents."""
    rows = n_words + SHAPES

    def run(batches):
        places, total = all_places(n_words), np.zeros(rows * DIMS, np.int64)
        signs: tuple[list, list] = [], []

        def add() -> None:
            for sign, found in zip((1, -1), signs, strict=True):
                if found:
                    np.add(total, sign * np.bincount(np.concatenate(found), minlength=rows * DIMS), out=total)
                found.clear()

        for b in blocks(batches, BLOCK_BYTES):
            word, shape, doc = tokens(b, n_words)
            for k in range(1, REACH + 1):
                same = doc[k:] == doc[:-k]
                for own in (word, shape):
                    left, right = own[:-k][same], own[k:][same]
                    for z in range(NONZERO):
                        signs[z % 2].extend((left * DIMS + places[right, z], right * DIMS + places[left, z]))
            if sum(map(len, signs[0])) > GATHERED:
                add()
        add()
        # A task's own sums fit 32 bits.
        yield from pieces(total.astype(np.int32))

    total = sum_arrays(docs.select("text").mapInArrow(run, PIECES), rows * DIMS, np.int32).reshape(rows, DIMS).astype(np.float64)
    for part in (total[:n_words], total[n_words:]):
        size = np.linalg.norm(part, axis=1, keepdims=True)
        part /= np.maximum(size, 1.0)
        part -= part.mean(axis=0)  # what all contexts share says nothing
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return total.astype(np.float32)


def pooled(block, both: np.ndarray) -> np.ndarray:
    """rows x FEATURES; both: the context vectors and, beside them, their squares."""
    word, shape, doc = tokens(block, len(both) - SHAPES)
    n = len(block)
    size = np.bincount(doc, minlength=n).astype(np.float64)
    least = np.maximum(size, 1)[:, None]

    def by_row(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Sums over the words of each row; of: the rows' numbers, ordered."""
        sums = np.zeros((n, x.shape[1]), np.float32)
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        if len(begin):
            sums[of[begin]] = np.add.reduceat(x, begin, axis=0)
        return sums

    out = []
    same = doc[1:] == doc[:-1]
    for own in (word, shape):
        x = both[own]
        sums = by_row(x, doc) / least
        mean = sums[:, :DIMS]
        spread = np.sqrt(np.maximum(sums[:, DIMS:] - mean * mean, 0))
        agree = np.stack([np.einsum("ij,ij->i", x[1:, :DIMS], x[:-1, :DIMS]), own[1:] == own[:-1]], axis=1)[same]
        out += [mean, spread, by_row(agree.astype(np.float32), doc[1:][same]) / least]
    length = np.stack([np.log1p(size), np.log1p(np.diff(block.offsets)) - np.log1p(size)], axis=1)
    return np.hstack([*out, length]).astype(np.float32)


@dataclass
class Network:
    """score = sigmoid(logit / temperature); without weights, the constant share."""

    share: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return (np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2)[:, 0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the logistic loss; every tenth row is kept for the temperature."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 20 or share in (0.0, 1.0):
        return Network(share)
    random, held = np.random.default_rng(7), np.arange(len(y)) % 10 == 0
    mean, scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-3
    a, b = (x[~held] - mean) / scale, y[~held].astype(np.float32)
    w = [random.normal(0, np.sqrt(2 / a.shape[1]), (a.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), random.normal(0, 0.1, (HIDDEN, 1)).astype(np.float32), np.zeros(1, np.float32)]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(EPOCHS):
        order = random.permutation(len(b))
        for i in range(0, len(b), BATCH):
            rows = order[i : i + BATCH]
            h = np.maximum(a[rows] @ w[0] + w[1], 0)
            error = (1 / (1 + np.exp(-np.clip((h @ w[2] + w[3])[:, 0], -40, 40))) - b[rows])[:, None] / len(rows)
            back = error @ w[2].T * (h > 0)
            step += 1
            for k, g in enumerate((a[rows].T @ back, back.sum(axis=0), h.T @ error, error.sum(axis=0))):
                g = g + DECAY * w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= RATE * m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(share, mean, scale, tuple(w))
    z, t = net.logits(x[held]), y[held]
    loss = lambda temperature: np.mean(np.logaddexp(0, np.where(t == 1, -z, z) / temperature))
    net.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
    return net


def classify(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, score) of every row of docs; labelled has doc_id and label (0 or 1) of the rows to learn from."""
    spark = docs.sparkSession
    name = docs.schema["doc_id"].dataType.simpleString()
    found = contexts(docs, vocabulary_rows(docs))
    both = spark.sparkContext.broadcast(np.hstack([found, found * found]))  # (MOST_WORDS + SHAPES) x 2 DIMS numbers at most
    known = labelled.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    ids = labelled_sample(known, sample)  # at most ``sample`` rows of two numbers

    def features(batches):
        for b in blocks(batches, BLOCK_BYTES):
            rows = [r.tobytes() for r in pooled(b, both.value)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("label").cast(pa.int32()), pa.array(rows, pa.binary())], ["doc_id", "label", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(features, "doc_id long, label int, x binary")
    labelled_rows = rows.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    x = np.frombuffer(b"".join(labelled_rows["x"].to_pylist()), np.float32).reshape(-1, FEATURES)
    net = spark.sparkContext.broadcast(fit(x, labelled_rows["label"].to_numpy()))

    def run(batches):
        for b in blocks(batches, BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(net.value.score(pooled(b, both.value)).astype(np.float64))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, score double")
