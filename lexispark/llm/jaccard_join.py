"""Exact Jaccard join of the documents' shingle sets, with set relations to skip work.

Documents with the same set are one class, which its smallest doc_id stands for. Classes
meet in inverted lists of their prefix: the shingles that come first in one global order,
rare before frequent (a count sketch of fixed size over all documents gives the order; it only
matters for speed). A list is ordered by set size and, within a size, by the shingle's position:
the entries of one size are a block. For an entry, blocks of sizes that cannot link are skipped
as a whole, and of the others all that lies beyond the last position from which enough can still
overlap, found by one search in the block; what is skipped is never looked at.

* A list of up to ``HOT`` classes gives candidate pairs in this way, which are checked on the
  whole sets. Linked sets meet in ``MEET`` lists, of which those of the long lists that either is
  in may be missing here.
* A longer list gives no pairs, and only sets in ``MEET`` of such lists can meet there alone. Their lists that share sets are gathered under the smallest label of
  their sets and of these sets' lists (``HOPS`` steps, not to the end, so that common shingles
  don't chain a corpus together). The sets of a label are cut into chunks by size; a task takes
  two chunks whose sizes allow links. There a set's answers (its overlaps with all others) are
  derived from those of the most similar set seen before: subtract the lists of the shingles it
  lacks, add those of the shingles it has more, each read only where sizes fit. Sets that are
  already connected are skipped; only links that join two parts are returned.

So a group of many near copies costs no rows for its pairs, and no link between different
texts is lost for the components.

Defined cases: a null text, or one without words, has an empty set, links with nothing and is
its own component; so is a row without doc_id (its component is null). Rows that repeat a
doc_id share one component: of their sets the one with the largest signature counts. doc_id is a
whole number. Sets are compared by 64-bit hashes of their shingles, classes by 128 bits.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import blocks, lowered, mix, prefix_sums, span_hash, words
from lexispark.llm.components import components
from lexispark.llm.shared import PIECES, pieces, stored, sum_arrays

SHINGLE, PERCENT = 5, 80
#: Longest list that gives pairs; shingles in a chunk; buckets of the count sketch.
HOT, CHUNK, SKETCH_BITS = 16, 400_000, 22
#: Bits for each id in the filter of ids, at least, and the most bits that it may have (32 MB).
FILTER_LOAD, FILTER_MOST = 16, 1 << 28
#: Steps of labels from list to list.
HOPS = 2
#: Shingles that the prefixes of a candidate pair must share (fewer for tiny sets); prefixes are longer by as many.
MEET = 3
#: Sets whose overlaps are kept to derive others from.
LEADERS = 8


def need(n, percent: int):
    """Smallest whole number that is ``percent`` per cent of n or more."""
    return -(-percent * n // 100)


def shingle_sets(block, k: int):
    """For each row, the sorted distinct hashes of its k-word shingles."""
    start, end, first = words(block)
    w = span_hash(prefix_sums(lowered(block)), start, end)
    factor = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    h = np.zeros(max(0, len(w) - k + 1), np.uint64)
    for j in range(k):
        h += w[j : len(w) - k + 1 + j] * factor[j] if len(h) else h
    h = mix(h)
    for i in range(len(block)):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            yield np.unique(h[a : b - k + 1])
        elif b > a:
            yield mix(np.array([(w[a:b] * factor[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
        else:
            yield h[:0]


def sketch(docs: DataFrame, k: int) -> np.ndarray:
    """How often the shingles of each bucket occur in all documents, as a byte that grows by 12 when the number doubles."""

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int32)
        for b in blocks(batches):
            found = np.concatenate(list(shingle_sets(b, k)))
            np.add.at(total, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield from pieces(np.minimum(total, 255).astype(np.uint8))  # a task's share of a very frequent one is as good as more

    found = sum_arrays(docs.select("text").mapInArrow(run, PIECES), 1 << SKETCH_BITS, np.uint8, np.int32)
    return np.minimum(12 * np.log2(1 + found.astype(np.float32)), 255).astype(np.uint8)


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n, s1, s2, prefix): size and signature of each set, and its prefix in the global order."""
    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs, k))  # a byte for each of 2**SKETCH_BITS buckets

    def run(batches):
        for b in blocks(batches):
            n, sign, prefix = [], [], []
            for s in shingle_sets(b, k):
                n.append(len(s))
                sign.append(xxhash.xxh3_128_digest(s.tobytes()))
                order = np.argsort(counts.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                prefix.append(s[order[: len(s) - need(len(s), percent) + MEET]].tobytes())
            sign = np.frombuffer(b"".join(sign), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int32()), pa.array(sign[:, 0]), pa.array(sign[:, 1]), pa.array(prefix, pa.binary())], ["doc_id", "n", "s1", "s2", "prefix"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n int, s1 long, s2 long, prefix binary")


def postings(classes: DataFrame) -> DataFrame:
    """(shingle, rep, n, pos) of every class's prefix."""

    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                tokens = [np.frombuffer(x.as_py(), np.int64) for x in part.column("prefix")]
                size = [len(t) for t in tokens]
                if not sum(size):
                    continue
                rep, n = (np.repeat(part.column(c).to_numpy(), size) for c in ("rep", "n"))
                pos = np.concatenate([np.arange(x, dtype=np.int32) for x in size])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(rep), pa.array(n), pa.array(pos)], ["shingle", "rep", "n", "pos"])

    return classes.select("rep", "n", "prefix").mapInArrow(run, "shingle long, rep long, n int, pos int")


def meetings(posted: DataFrame, percent: int) -> DataFrame:
    """(shingle, a, b, least): pairs a, b of short lists, and how many lists they must meet in; a member a of a long list has b null."""

    def pairs(x: np.ndarray):
        """x: rows shingle, rep, n, pos of whole short lists, ordered by shingle, n and pos."""
        shingle, rep, n, pos = x
        if not len(shingle):
            return
        new = np.concatenate([[True], (shingle[1:] != shingle[:-1]) | (n[1:] != n[:-1])])
        begin, block, width = np.flatnonzero(new), np.cumsum(new) - 1, int(pos.max()) + 2
        end, size, owner = np.append(begin[1:], len(shingle)), n[begin], shingle[begin]
        place = block * width + pos  # ordered as the entries are
        # The smaller set meets with a shorter prefix, as the larger one comes after it.
        i = np.flatnonzero(pos < n - (-(-2 * percent * n // (100 + percent))) + MEET)
        for k in range(HOT):
            i = i[block[i] + k < len(begin)]
            c = block[i] + k
            fits = (owner[c] == shingle[i]) & (100 * n[i] >= percent * size[c])  # later blocks have larger sets still
            i, c = i[fits], c[fits]
            if not len(i):
                return
            least = -(-percent * (n[i] + size[c]) // (100 + percent))
            # This may be the MEET-th common shingle, so MEET - 1 may stand before it.
            last = np.clip(size[c] + MEET - 1 - least, -1, width - 2)
            stop = np.minimum(np.searchsorted(place, c * width + last, "right"), end[c])
            start = begin[c] if k else i + 1
            many = np.where(n[i] - pos[i] + MEET - 1 >= least, np.maximum(stop - start, 0), 0)
            if many.any():
                one = np.repeat(i, many)
                other = np.repeat(start - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                a, b = rep[one], rep[other]
                yield shingle[one], np.minimum(a, b), np.maximum(a, b), np.minimum(np.repeat(least, many), MEET), np.zeros(len(a), bool)

    def rows(shingle, a, b, least, single):
        return pa.RecordBatch.from_arrays([pa.array(shingle), pa.array(a), pa.array(b, mask=single), pa.array(least)], ["shingle", "a", "b", "least"])

    def run(batches):
        carry, going_on = np.zeros((4, 0), np.int64), None  # going_on: the long list that the last batch ended in
        for batch in itertools.chain(batches, [None]):
            x = carry if batch is None else np.hstack([carry, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("shingle", "rep", "n", "pos")])])
            if not x.shape[1]:
                continue
            begin = np.concatenate([[0], np.flatnonzero(np.diff(x[0])) + 1])
            size = np.diff(np.append(begin, x.shape[1]))
            long = size > HOT
            long[0] |= going_on == x[0, 0]
            ready = x.shape[1] if batch is None or long[-1] else begin[-1]  # a short last list may go on
            hot = np.repeat(long, size)
            if hot.any():
                yield rows(x[0, hot], x[1, hot], x[1, hot], x[2, hot], np.ones(int(hot.sum()), bool))
            for found in pairs(x[:, :ready][:, ~hot[:ready]]):
                yield rows(*found)
            going_on, carry = x[0, -1] if long[-1] else None, x[:, ready:]

    ordered = posted.repartition("shingle").sortWithinPartitions("shingle", "n", "pos", "rep")
    return ordered.mapInArrow(run, "shingle long, a long, b long, least long")


def id_filter(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap over the hashes of the ids (one column) and its size in bits: FILTER_LOAD bits or more for each id, up to FILTER_MOST."""
    size = min(FILTER_MOST, max(1 << 15, 1 << (FILTER_LOAD * ids.count()).bit_length()))
    place = id_place(ids.columns[0], size)
    marked = ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    out = np.zeros(size // 8, np.uint8)
    for row in marked.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[(row.bucket - 1) << 12 :][: len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return out, size


def id_place(name: str, size: int) -> Column:
    """The place of an id in a filter, from 1."""
    return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(size)) + 1


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, s1, s2, s): the sets of all documents that pass a filter, as the wanted reps do, and few others, however many reps there are."""
    found, size = id_filter(wanted.select("rep").distinct())
    marks = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches):
        for batch in batches:
            place = batch.column("place").to_numpy() - 1
            use = (marks.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            for b in blocks([batch.filter(pa.array(use.astype(bool)))]):
                sets = [s.tobytes() for s in shingle_sets(b, k)]
                sign = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, sets)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sign[:, 0]), pa.array(sign[:, 1]), pa.array(sets, pa.binary())], ["rep", "s1", "s2", "s"])

    asked = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", id_place("doc_id", size).alias("place"))
    return asked.mapInArrow(run, "rep long, s1 long, s2 long, s binary")


class Parts:
    """The parts that the links of a task have made so far, one label a set; the smaller part takes the other's label."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def join(self, i: int, j: int) -> bool:
        a, b = int(self.label[i]), int(self.label[j])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        moved = self.members.pop(b)
        self.label[moved] = a
        self.members[a] += moved
        return True


def chunk_links(side: np.ndarray, reps: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the sets of one chunk (all of side 0), or of chunk 0 with chunk 1."""
    size = np.array([len(s) for s in sets])
    order = np.lexsort((reps, size, side))
    side, reps, size, sets = side[order], reps[order], size[order], [sets[i] for i in order]
    two = bool(side[-1])
    asks, answers = np.flatnonzero(side == 0), np.flatnonzero(side == int(two))
    if not len(asks) or not len(answers):
        return []
    # Inverted lists of the answering sets, which are ordered by size; a list's entries lie together in ``place``.
    flat, n_answers = np.concatenate([sets[j] for j in answers]), len(answers)
    tokens, of = np.unique(flat, return_inverse=True)
    place = np.sort(of * n_answers + np.repeat(np.arange(n_answers), size[answers]))

    def listed(shingles: np.ndarray, low: int, high: int) -> np.ndarray:
        """How many of the shingles each of the answering sets low..high has; the lists' other blocks are skipped."""
        at = np.minimum(np.searchsorted(tokens, shingles), len(tokens) - 1)
        at = at[tokens[at] == shingles] * n_answers
        begin, end = np.searchsorted(place, at + low), np.searchsorted(place, at + high)
        n = end - begin
        entry = np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(at) else at
        return np.bincount(place[entry] % n_answers, minlength=n_answers)

    parts, out, leaders, sizes = Parts(len(sets)), [], [], size[answers]
    for q in asks:
        low, high = np.searchsorted(sizes, -(-percent * size[q] // 100)), np.searchsorted(sizes, 100 * size[q] // percent, "right")
        if not two:
            low = max(low, np.searchsorted(answers, q, "right"))
        near = np.arange(low, high)
        near = near[parts.label[answers[near]] != parts.label[q]]  # what is connected needs no answer
        if not len(near):
            continue
        low, high = int(near[0]), int(near[-1]) + 1
        best, gap = None, len(sets[q])
        for lead, known, known_low, known_high in leaders:
            if known_low <= low and high <= known_high:
                d = len(np.setxor1d(sets[lead], sets[q], assume_unique=True))
                if d < gap:
                    best, gap = (lead, known), d
        if best is None or gap > len(sets[q]) // 4:
            common = listed(sets[q], low, n_answers)  # for sets to come as well
            leaders = [(q, common, low, n_answers), *leaders][:LEADERS]
        else:
            lead, known = best
            common = known - listed(np.setdiff1d(sets[lead], sets[q], assume_unique=True), low, high) + listed(np.setdiff1d(sets[q], sets[lead], assume_unique=True), low, high)
        for j in near[100 * common[near] >= percent * (sizes[near] + size[q] - common[near])]:
            if parts.join(int(q), int(answers[j])):
                out.append((int(reps[q]), int(reps[answers[j]])))
    return out


def labelled(long: DataFrame) -> DataFrame:
    """(rep, n, g): the sets of long lists (shingle, rep, n), each once under each label of its lists."""
    least = lambda df, of: df.groupBy(of).agg(F.min("g").alias("g"))
    lists = least(long.withColumn("g", F.col("rep")), "shingle")
    for _ in range(HOPS - 1):
        sets = least(long.join(lists, "shingle"), "rep")
        lists = least(long.join(sets, "rep"), "shingle")
    return long.join(lists, "shingle").select("rep", "n", "g").distinct()


def paired(met: DataFrame, hot: DataFrame) -> DataFrame:
    """(a, b): pairs of sets that meet often enough in short lists, if they share all the long lists (rep, h) that both could."""
    pairs = met.where("b is not null").groupBy("a", "b").agg(F.count("*").alias("met"), F.first("least").alias("least"))
    of = lambda side: hot.select(F.col("rep").alias(side), F.col("h").alias(f"h_{side}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where("met + least(coalesce(h_a, 0), coalesce(h_b, 0)) >= least").select("a", "b")


def only_hot(long: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """The rows of long lists (shingle, rep, n) whose sets are in so many of them that they might meet others there alone."""
    partner = f"(n + ceil({percent} * n / 100))"  # with the smallest set that may link
    return long.join(hot, "rep").where(f"h >= least({MEET}, ceil({percent} * {partner} / {100 + percent}))").select("shingle", "rep", "n")


def chunk_requests(hot: DataFrame, percent: int) -> DataFrame:
    """(rep, g, i, j, side): which sets which pair of chunks needs, of the sets (rep, n, g) of long lists.

    Chunks follow the sizes of a label's sets, of which there are few, so that no task orders
    all its sets; sets of one size that fill more than a chunk are dealt by their hash.
    """
    sizes = hot.groupBy("g", "n").agg((F.count("*") * F.col("n")).alias("all"))
    before = Window.partitionBy("g").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    cells = sizes.select("g", "n", F.floor(F.coalesce(F.sum("all").over(before), F.lit(0)) / CHUNK).alias("c"), F.ceil(F.col("all") / CHUNK).alias("ways"))
    placed = hot.join(cells, ["g", "n"]).select("rep", "g", "n", F.expr(f"c * {1 << 24} + pmod(xxhash64(rep), ways)").alias("chunk")).checkpoint()
    bounds = placed.groupBy("g", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = bounds.alias("a"), bounds.alias("b")
    # The chunks are ordered by size: one row for all pairs of sets of two chunks, and only where sizes allow a link.
    met = a.join(b, F.expr(f"a.g = b.g and a.chunk <= b.chunk and 100 * a.high >= {percent} * b.low")).select("a.g", F.col("a.chunk").alias("i"), F.col("b.chunk").alias("j"))
    sides = met.select("g", "i", "j", F.explode(F.expr("if(i = j, array(struct(0 as side, i as chunk)), array(struct(0 as side, i as chunk), struct(1 as side, j as chunk)))")).alias("x")).select("g", "i", "j", "x.*")
    return sides.join(placed, ["g", "chunk"]).select("rep", "g", "i", "j", "side")


def checked(requests: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (u, v) among the requested sets.

    Requests with i = -1 are pairs: the set of side 0 is compared with each of side 1, which
    stream by. The others are pairs of chunks, held together.
    """

    def run(batches):
        key, held, owner = None, [], None

        def links():
            side, reps, own = zip(*held, strict=True)
            return chunk_links(np.array(side), np.array(reps), list(own), percent)

        for batch in itertools.chain(batches, [None]):
            out = []
            columns = zip(*(batch.column(c).to_pylist() for c in ("g", "i", "j", "side", "rep", "s")), strict=True) if batch is not None else [(None, None, None, 0, 0, b"")]
            for g, i, j, side, rep, s in columns:
                if (g, i, j) != key:
                    if held:
                        out += links()
                    key, held, owner = (g, i, j), [], None
                x = np.frombuffer(s, np.uint64)
                if i != -1:
                    held.append((side, rep, x))
                elif side == 0:
                    owner = x
                elif owner is not None:
                    common = len(np.intersect1d(owner, x, assume_unique=True))
                    if 100 * common >= percent * (len(owner) + len(x) - common):
                        out.append((g, rep))
            out = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["u", "v"])

    rows = sets.join(requests, ["rep", "s1", "s2"]).select("g", "i", "j", "side", "rep", "s")
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side", "rep").mapInArrow(run, "u long, v long")


def join_documents(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs, k, percent), "signatures")
    some = signed.where("n > 0 and doc_id is not null")
    n_rows, n_ids = some.agg(F.count("*"), F.count_distinct("doc_id")).first()
    if n_rows > n_ids:
        chosen = some.groupBy("doc_id").agg(F.max(F.struct("s1", "s2")).alias("s")).select("doc_id", "s.*")
        some = some.join(chosen, ["doc_id", "s1", "s2"], "left_semi")
    classes = some.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    met = stored(meetings(postings(classes), percent), "meetings")
    long = met.where("b is null").select("shingle", F.col("a").alias("rep"), F.col("least").cast("int").alias("n"))
    lists = long.groupBy("rep").agg(F.count("*").alias("h")).checkpoint()
    pairs = paired(met, lists).checkpoint()
    hot = labelled(only_hot(long, lists, percent)).checkpoint()
    hot = hot.join(hot.groupBy("g").agg(F.count("*").alias("sets")).where("sets > 1"), "g", "left_semi")
    alone = "-1L as i", "-1L as j"
    owners, others = pairs.select("a").distinct().selectExpr("a as rep", "a as g", *alone, "0 as side"), pairs.selectExpr("b as rep", "a as g", *alone, "1 as side")
    named = some.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")).checkpoint()
    requests = owners.unionByName(others).unionByName(chunk_requests(hot, percent)).join(named, "rep").checkpoint()
    found = components(checked(requests, whole_sets(docs, requests, k), percent))
    component = named.join(found, named["rep"] == found["id"], "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    member = some.select("doc_id", "s1", "s2").distinct().join(component, ["s1", "s2"]).select(F.col("doc_id").alias("__doc"), "component")
    rows = signed.select("doc_id", "n").join(member, F.col("doc_id") == F.col("__doc"), "left")
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def duplicate_ids(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The doc_ids that are not the smallest of their component."""
    return join_documents(docs, k, percent).where("component_id <> doc_id").select("doc_id").distinct()
