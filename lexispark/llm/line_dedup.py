"""Drop lines that many documents share: a sharded minimal perfect hash instead of a join on lines.

Every distinct line key gets a 128-bit hash, and all of them are dealt to shards. A task builds
for its shard a minimal perfect hash (levels of bit arrays; a key sits where it alone fell),
which indexes two compact arrays: 32-bit fingerprints, and document counts that stop at
``min_docs`` (a byte each for up to 255). Counts of ``min_docs`` point on to the largest doc_id
that holds the line. Documents send 16-byte hashes, never lines, to the arrays of the hash's
shard, and the count that they find there decides. A shard that holds a very common line is
copied to several salted groups, as many as its share of all lines needs, so that no task meets
all documents of such a line.

Defined cases: a null or empty text is one empty line; rows that repeat a doc_id count as one
document each and share their drops; a row without doc_id counts as a document and keeps all
its lines; an empty table gives an empty result. doc_id is a whole number. Two keys would be
taken for one only with equal 128 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.llm.arrowtext import blocks, mix
from lexispark.llm.shared import stored, unused

MIN_DOCS, MIN_CHARS = 3, 20
#: Keys of a shard, about; line hashes that meet them in one group; most shards that are copied.
SHARD_KEYS, PROBE_ROWS, COPIED = 50_000, 200_000, 1_000
#: Bits for each key left at a level of the perfect hash.
GAMMA = 2.0
STRIP = b" \t\n\x0b\x0c\r"


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte hash of a line's key, or None where the key is too short to count."""
    key = line.strip(STRIP).lower()  # of bytes: A-Z only
    n = len(key)
    if n < min_chars or n < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id): the distinct keys of each document."""

    def run(batches):
        for b in blocks(batches):
            ids = b.column("doc_id").to_pylist()
            keys, owners = [], []
            for i in range(len(b)):
                own = {k for line in b.raw(i).split(b"\n") if (k := key_of(line, min_chars))}
                keys += own
                owners += [ids[i]] * len(own)
            h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(owners, pa.int64())], ["h1", "h2", "doc_id"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "h1 long, h2 long, doc_id long")


def slots(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & ((1 << 64) - 1))
    return (mix(h1.view(np.uint64) ^ mix(h2.view(np.uint64) + seed)) % np.uint64(size)).astype(np.int64)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays by level, and the index of each of the given distinct keys."""
    levels, at, left, base = [], np.empty(len(h1), np.int64), np.arange(len(h1)), 0
    while len(left):
        size = max(64, int(GAMMA * len(left)))
        s = slots(h1[left], h2[left], len(levels), size)
        alone = np.bincount(s, minlength=size) == 1
        levels.append(alone)
        placed = alone[s]
        at[left[placed]] = base + np.cumsum(alone)[s[placed]] - 1
        base += int(alone.sum())
        left = left[~placed]
    return levels, at


def find(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The index of each key, -1 where no level has it; keys that were not built in get any index."""
    at, left, base = np.full(len(h1), -1), np.arange(len(h1)), 0
    for level, bits in enumerate(levels):
        s = slots(h1[left], h2[left], level, len(bits))
        hit = bits[s]
        rank = np.cumsum(bits)
        at[left[hit]] = base + rank[s[hit]] - 1
        base += int(rank[-1])
        left = left[~hit]
    return at


def index_shards(counted: DataFrame, n_shards: int, min_docs: int) -> DataFrame:
    """One row a shard: levels and arrays as bytes, and how many line hashes its keys stand for."""
    small = np.min_scalar_type(min_docs)

    def run(key, rows):
        h1, h2 = rows["h1"].to_numpy(np.int64), rows["h2"].to_numpy(np.int64)
        levels, at = build(h1, h2)
        prints, counts, last = np.empty(len(at), np.uint32), np.empty(len(at), small), np.empty(len(at), np.int64)
        prints[at], counts[at] = h2.astype(np.uint32), np.minimum(rows["n_docs"].to_numpy(), min_docs)
        last[at] = rows["last_doc"].fillna(-(1 << 62))
        packed = [np.packbits(x).tobytes() for x in levels]
        return pd.DataFrame({"shard": [key[0]], "sizes": [[len(x) for x in levels]], "bits": [packed], "prints": [prints.tobytes()], "counts": [counts.tobytes()], "lasts": [last[counts == min_docs].tobytes()], "load": [int(rows["n_docs"].sum())]})

    schema = "shard long, sizes array<long>, bits array<binary>, prints binary, counts binary, lasts binary, load long"
    return counted.withColumn("shard", F.expr(f"pmod(h1, {n_shards})")).groupBy("shard").applyInPandas(run, schema)


def unpack(row: dict, min_docs: int) -> tuple:
    """The levels, fingerprints, counts and, in order of their keys' places, the last documents of a shard."""
    levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=int(n)).astype(bool) for n, b in zip(row["sizes"], row["bits"], strict=True)]
    counts = np.frombuffer(row["counts"], np.min_scalar_type(min_docs))
    return levels, np.frombuffer(row["prints"], np.uint32), counts, np.cumsum(counts == min_docs) - 1, np.frombuffer(row["lasts"], np.int64)


def probe(arrays: tuple, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, min_docs: int) -> np.ndarray:
    """Which lines stand in ``min_docs`` documents or more, of which this one is not the last."""
    levels, prints, counts, nth, last = arrays
    at = find(levels, h1, h2)
    gone = (at >= 0) & (prints[at] == h2.astype(np.uint32)) & (counts[at] == min_docs)
    gone[gone] = last[nth[at[gone]]] != doc[gone]
    return gone


def probed(dealt: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, h1, h2) of the lines to drop; both tables have shard and salt. A group's index row comes first, its lines stream by."""

    def run(batches):
        group, arrays = None, None
        for batch in batches:
            shard, salt, h1, h2, doc = (batch.column(c).fill_null(0).to_numpy() for c in ("shard", "salt", "h1", "h2", "doc_id"))
            is_line, gone = np.asarray(batch.column("is_line")), np.zeros(len(batch), bool)
            begin = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1])])) if len(batch) else []
            for i, j in zip(begin, [*begin[1:], len(batch)], strict=True):
                if (shard[i], salt[i]) != group:
                    group, arrays = (shard[i], salt[i]), None
                if not is_line[i]:
                    arrays = unpack(batch.slice(i, 1).to_pylist()[0], min_docs)
                    i += 1
                if i < j and arrays is not None:
                    gone[i:j] = probe(arrays, h1[i:j], h2[i:j], doc[i:j], min_docs)
            yield batch.filter(pa.array(gone)).select(["doc_id", "h1", "h2"])

    rows = dealt.withColumn("is_line", F.lit(True)).unionByName(index.drop("load").withColumn("is_line", F.lit(False)), allowMissingColumns=True)
    return rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "is_line").mapInArrow(run, "doc_id long, h1 long, h2 long")


def dropped_keys(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, drop): for each document that loses lines, the hashes of their keys."""
    lines = line_hashes(docs, min_chars)
    counted = stored(lines.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")), "lines")
    n_keys, n_lines = counted.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    n_shards = max(1, -(-n_keys // SHARD_KEYS))
    index = index_shards(counted, n_shards, min_docs).checkpoint()
    # Loads add up to n_lines, so at most COPIED shards have more than this.
    share = max(PROBE_ROWS, -(-n_lines // COPIED))
    salts = index.where(F.col("load") > share).select("shard", F.floor(F.col("load") / PROBE_ROWS).cast("int").alias("n_salts"))
    salted = lambda df, salt: df.join(F.broadcast(salts), "shard", "left").withColumn("salt", F.expr(salt)).drop("n_salts")
    dealt = salted(lines.where("doc_id is not null").withColumn("shard", F.expr(f"pmod(h1, {n_shards})")), "pmod(xxhash64(doc_id), coalesce(n_salts, 1))")
    spread = salted(index, "explode(sequence(0L, coalesce(n_salts, 1) - 1L))")
    hits = probed(dealt, spread, min_docs)
    return hits.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("drop"))


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of docs with the kept lines as text, and n_lines and n_dropped.

    Columns of docs that have the names of the two new ones are replaced.
    """
    base = docs.drop("n_lines", "n_dropped")
    owner, gone_keys = unused(base.columns, "owner"), unused(base.columns, "drop")
    drops = dropped_keys(docs, min_docs, min_chars).withColumnsRenamed({"doc_id": owner, "drop": gone_keys})
    joined = base.join(drops, base["doc_id"].cast("long") == drops[owner], "left").drop(owner)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in base.schema] + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = base.columns

    def run(batches):
        for b in blocks(batches):
            drop, texts, n_lines, n_dropped = b.column(gone_keys), [], [], []
            for i in range(len(b)):
                lines, kept = b.raw(i).split(b"\n"), None
                if drop[i].is_valid:
                    gone = {np.array([x["h1"], x["h2"]], np.int64).tobytes() for x in drop[i].as_py()}
                    kept = [x for x in lines if key_of(x, min_chars) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(0 if kept is None else len(lines) - len(kept))
                texts.append(None if b.null[i] else b.raw(i) if kept is None else b"\n".join(kept))
            part = b.batch.slice(b.first, len(b))
            columns = [pa.array(texts, pa.binary()).cast(pa.string()) if c == "text" else part.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(run, schema)
