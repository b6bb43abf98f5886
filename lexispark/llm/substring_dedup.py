"""Repeated strings of 100 bytes or more, by prefix-free parsing with sharded suffix sorting.

A rolling hash over 24 bytes, zero modulo ``MODULUS``, is a trigger. The first trigger in a
window of 100 bytes is its anchor (in the rare window without one, the smallest hash), so equal
windows have equal anchors at the same place. Consecutive windows with one anchor form a phrase,
which reaches 99 bytes beyond its last window start. Phrases are a parse of the corpus in which
no window is lost and none crosses a document, and every repeated string lies in phrases of the
same anchor.

* Equal phrases are one entry of the dictionary: its first place stays, all windows of the others
  are repeats. Each task combines its phrases before any is sent: the later places of a phrase are
  known for repeats at once, and one row for each phrase of some megabytes of text goes on, so a
  passage that stands everywhere is no burden to one task. These are dealt out by anchor and
  sorted by phrase and place.
* Different phrases of one anchor may still share windows. These dictionary entries get their
  bytes again; their suffixes are sorted byte by byte as far as the rule can tell them apart, 100
  bytes, equal ones by the places of their phrases in the parse: the suffix array of a shard of the
  dictionary, combined with the parse into corpus order. In each run of equal suffixes all but
  the first are repeats. As a phrase reaches 99 bytes beyond its last window, no comparison goes
  on to the next phrase: of the parse's own suffixes only their order in the corpus matters. An
  anchor with very many different phrases has its suffixes, combined in each task in the same
  way, dealt out by their bytes instead, so that no task holds them all.
* The repeats of a document are merged into runs and cut out.

Nothing compares documents in pairs, and texts only move for documents that need their bytes.

Defined cases: null is the empty text; a text under 100 bytes keeps all; rows that repeat
doc_id and text are one document and get equal results (with different texts under one doc_id,
what is found in one is cut from all); a row without doc_id takes no part and keeps all. doc_id
is a whole number.
Phrases are told apart by 64-bit hashes together with their anchors' 64 bits.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import blocks, mix, powers, prefix_sums, span_hash
from lexispark.llm.shared import stored

LENGTH, TRIGGER, MODULUS = 100, 24, 32
SPAN = LENGTH - TRIGGER + 1
#: Bits of a block position inside a sort key; bytes of text handled at a time.
PLACE_BITS, BLOCK_BYTES = 24, 1 << 18
#: Windows sorted at a time; different phrases of an anchor beyond which its suffixes are dealt out.
SORT_WINDOWS, MANY = 60_000, 4_000
FILTER_BITS = 20
#: Phrases that a task combines at a time, and those whose suffixes it does.
COMBINED, SPREAD = 400_000, 2_048


def parse(b, begin: int = 0, stop: int | None = None):
    """Phrases of a block: anchor hash, phrase hash, row, first window start, window starts, anchor's place in the first window."""
    data, n = b.data, len(b.data)
    if n < LENGTH:
        return None
    _, down = powers(n + 1)
    sums = prefix_sums(data)
    h = mix((sums[TRIGGER:] - sums[:-TRIGGER]) * down[: n - TRIGGER + 1])
    place = np.uint64((1 << PLACE_BITS) - 1)
    key = np.where(h % np.uint64(MODULUS) == 0, np.uint64(0), h & ~place) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:  # smallest key of each run of SPAN places: its first trigger, else its smallest hash, the leftmost of equals
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    key = np.minimum(key[: len(key) - (SPAN - width)], key[SPAN - width :])
    row = np.repeat(np.arange(len(b)), np.diff(b.offsets))[: len(key)]
    at = np.flatnonzero(np.arange(len(key)) + LENGTH <= b.offsets[1:][row])
    if not len(at):
        return None
    anchor = (key[at] & place).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[at][1:] != row[at][:-1])
    i = np.flatnonzero(new)
    low, high, anchor = at[i], at[np.append(i[1:], len(at)) - 1], anchor[i]
    phrase = mix(span_hash(sums, low, high + LENGTH) + (anchor - low).astype(np.uint64))
    return h[anchor], phrase, row[low], low - b.offsets[row[low]], high - low + 1, anchor - low


def cut_long(b):
    """A block of one text longer than a sort key can place, in overlapping parts with their offsets."""
    step = (1 << PLACE_BITS) - 2 * LENGTH
    if len(b.data) <= step:
        yield b, 0
        return
    for i in range(0, len(b.data), step):
        data = b.data[i : i + step + LENGTH - 1]
        yield type(b)(b.batch, b.first, data, np.array([0, len(data)]), b.null), i


def combined(keys: list[np.ndarray], doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of keys, doc and place, without repeated ones; and whether each has the keys of the row before."""
    order = np.lexsort((place, doc, *keys[::-1]))
    same = np.zeros(len(order), bool)
    same[1:] = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in keys])
    twice = np.zeros(len(order), bool)
    twice[1:] = same[1:] & (doc[order][1:] == doc[order][:-1]) & (place[order][1:] == place[order][:-1])
    return order[~twice], same[~twice]


def phrases(docs: DataFrame) -> DataFrame:
    """(again, anchor, phrase, doc_id, place): place packs the first window start, the window starts and the anchor's place; again: the task has an earlier place."""

    def rows(held):
        anchor, phrase, doc, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order, again = combined([anchor, phrase], doc, place)
        return pa.RecordBatch.from_arrays([pa.array(again), *(pa.array(x[order]) for x in (anchor, phrase, doc, place))], ["again", "anchor", "phrase", "doc_id", "place"])

    def run(batches):
        held, n = [], 0
        for whole in blocks(batches, BLOCK_BYTES):
            ids = whole.column("doc_id").to_numpy()
            for b, offset in cut_long(whole):
                if (found := parse(b)) is not None:
                    anchor, phrase, row, low, width, inside = found
                    held.append((anchor.view(np.int64), phrase.view(np.int64), ids[row], (low + offset) << 16 | width << 8 | inside))
                    n += len(anchor)
            if n > COMBINED:
                yield rows(held)
                held, n = [], 0
        if held:
            yield rows(held)

    return docs.mapInArrow(run, "again boolean, anchor long, phrase long, doc_id long, place long")


def sort_parse(parsed: DataFrame) -> DataFrame:
    """(again, anchor, doc_id, place): later places of a phrase (again), and first places of phrases that share an anchor."""

    def run(batches):
        last, held = None, None  # the row before; the first row of its anchor, while that has one phrase only
        for batch in batches:
            known = np.asarray(batch.column("again"))
            if known.any():
                yield batch.filter(pa.array(known)).select(["again", "anchor", "doc_id", "place"])
            a, p, d, x = (batch.column(c).to_numpy()[~known] for c in ("anchor", "phrase", "doc_id", "place"))
            if not len(a):
                continue
            before = [np.concatenate([[y[0] if last is None else last[k]], y[:-1]]) for k, y in enumerate((a, p, d, x))]
            same_anchor = before[0] == a
            same_phrase = same_anchor & (before[1] == p)
            same_place = same_phrase & (before[2] == d) & (before[3] == x)
            if last is None:
                same_anchor[0] = same_phrase[0] = same_place[0] = False
            other = same_anchor & ~same_phrase  # a further phrase of the anchor
            group = np.cumsum(~same_anchor)  # 0: the anchor that the last batch ended in
            many = np.zeros(group[-1] + 1, bool)
            many[group[other]] = True
            first = ~same_anchor & many[group]
            extra = [held] if held is not None and many[0] else []
            border, again = np.flatnonzero(other | first), np.flatnonzero(same_phrase & ~same_place)
            rows = [np.concatenate([y[again], [e[k] for e in extra], y[border]]).astype(np.int64) for k, y in ((0, a), (2, d), (3, x))]
            flag = np.concatenate([np.ones(len(again), bool), np.zeros(len(extra) + len(border), bool)])
            yield pa.RecordBatch.from_arrays([pa.array(flag), *(pa.array(r) for r in rows)], ["again", "anchor", "doc_id", "place"])
            last = (a[-1], p[-1], d[-1], x[-1])
            if many[group[-1]]:
                held = None
            elif group[-1] > 0:
                i = int(np.flatnonzero(~same_anchor)[-1])
                held = (a[i], p[i], d[i], x[i])

    dealt = parsed.repartition(F.expr("if(again, xxhash64(doc_id, place), anchor)"))
    ordered = dealt.sortWithinPartitions("again", "anchor", "phrase", "doc_id", "place")
    return ordered.mapInArrow(run, "again boolean, anchor long, doc_id long, place long")


def filter_of(ids: DataFrame):
    """A broadcast bitmap of fixed size that has all the given doc_ids; others may pass too."""
    size = 1 << FILTER_BITS

    def run(batches):
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[slot(batch.column(0).to_numpy())] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    def merge(batches):
        total = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for x in batch.column(0):
                total |= np.frombuffer(x.as_py(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["bits"])

    parts = ids.select("doc_id").mapInArrow(run, "bits binary").repartition(16).mapInArrow(merge, "bits binary").collect()
    bits = np.zeros(size // 8, np.uint8)
    for r in parts:
        bits |= np.frombuffer(r[0], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(np.unpackbits(bits).astype(bool))


def slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def picked(docs: DataFrame, marks) -> DataFrame:
    """The rows of docs whose doc_id passes the filter."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(marks.value[slot(batch.column("doc_id").to_numpy())]))

    return docs.mapInArrow(run, "doc_id long, text string")


def with_bytes(docs: DataFrame, borders: DataFrame) -> DataFrame:
    """(anchor, doc_id, place, context): the bytes of the given phrases, from their documents."""
    wanted = borders.groupBy("doc_id").agg(F.collect_set(F.struct("anchor", "place")).alias("cuts"))
    rows = picked(docs, filter_of(borders)).join(wanted, "doc_id")

    def run(batches):
        for b in blocks(batches, 4 * BLOCK_BYTES):
            cuts = b.column("cuts")
            count = np.diff(np.asarray(cuts.offsets)) if len(cuts) else np.zeros(0, np.int64)
            flat = cuts.flatten()
            anchor, place = (np.asarray(flat.field(k)) for k in (0, 1))
            doc = np.repeat(b.column("doc_id").to_numpy(), count)
            begin = np.repeat(b.offsets[:-1], count) + (place >> 16)
            end = np.minimum(begin + ((place >> 8) & 255) + LENGTH - 1, np.repeat(b.offsets[1:], count))
            size = np.maximum(end - begin, 0)
            take = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else size
            joined, borders_ = b.data[take], np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            context = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(borders_), pa.py_buffer(np.ascontiguousarray(joined))])
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(doc), pa.array(place), context], ["anchor", "doc_id", "place", "context"])

    return rows.mapInArrow(run, "anchor long, doc_id long, place long, context binary")


def windows_of(anchor, doc, place, contexts):
    """All windows of some phrases: owner row, anchor's place in the window, and their 100 bytes as 13 big-endian numbers."""
    data, offsets, _ = _bytes(contexts)
    n = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    step = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    start = offsets[owner] + step
    padded = np.zeros((len(owner), 104), np.uint8)
    if len(owner):
        padded[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[start]
    return owner, (place[owner] & 255) - step, (place[owner] >> 16) + step, padded


def _bytes(column: pa.Array):
    column = column.cast(pa.large_binary())
    _, borders, data = column.buffers()
    offsets = np.frombuffer(borders, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8), offsets - offsets[0], None


def runs(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Window starts, ordered, as byte runs (doc_id, begin, end)."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    i = np.flatnonzero(new)
    last = np.append(i[1:], len(doc)) - 1 if len(doc) else i
    return pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(start[i]), pa.array(start[last] + LENGTH)], ["doc_id", "begin", "end"])


def sort_dictionary(contexts: DataFrame) -> DataFrame:
    """(doc_id, begin, end) of repeated windows, from the sorted suffixes of phrases that share anchors."""

    def repeats(table: pa.Table):
        batch = table.combine_chunks()
        anchor, doc, place = (batch.column(c).to_numpy() for c in ("anchor", "doc_id", "place"))
        owner, inside, start, text = windows_of(anchor, doc, place, batch.column("context").combine_chunks())
        order, again = combined([anchor[owner], inside, *text.view(">u8").astype(np.uint64).T], doc[owner], start)
        found = order[again]
        found = found[np.lexsort((start[found], doc[owner][found]))]
        return runs(doc[owner][found], start[found])

    def run(batches):
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            if not n or (batch is not None and n * SPAN < SORT_WINDOWS):
                continue
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            edges = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
            stop = len(anchor) if batch is None else (edges[-2] if len(edges) > 1 else 0)  # the last anchor may go on
            i = 0
            while i < stop:
                j = int(edges[min(np.searchsorted(edges, i + SORT_WINDOWS // SPAN, "left"), len(edges) - 1)])
                j = min(max(j, int(edges[np.searchsorted(edges, i, "right")])), stop)
                yield repeats(table.slice(i, j - i))
                i = j
            held, n = table.slice(stop).to_batches(), len(anchor) - stop

    ordered = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(run, "doc_id long, begin long, end long")


def deal_suffixes(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many phrases: their suffixes are dealt out by their bytes and sorted."""

    def spread(batches):
        for batch in batches:
            for i in range(0, len(batch), SPREAD):
                part = batch.slice(i, SPREAD)
                anchor, doc, place = (part.column(c).to_numpy() for c in ("anchor", "doc_id", "place"))
                owner, inside, start, text = windows_of(anchor, doc, place, part.column("context"))
                order, again = combined([inside, *text.view(">u8").astype(np.uint64).T], doc[owner], start)
                size = np.where(again, 0, LENGTH)
                flat = np.ascontiguousarray(text[order[~again], :LENGTH])
                suffix = pa.Array.from_buffers(pa.binary(), len(order), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([pa.array(again), suffix, pa.array(doc[owner][order]), pa.array(start[order])], ["again", "suffix", "doc_id", "start"])

    def run(batches):
        last = None
        for batch in batches:
            if len(batch):
                known, suffix = np.asarray(batch.column("again")), np.array(batch.column("suffix").to_pylist(), object)
                same = np.concatenate([[last == suffix[0]], suffix[1:] == suffix[:-1]]).astype(bool)
                doc, start = batch.column("doc_id").to_numpy(), batch.column("start").to_numpy()
                if not known[-1]:
                    last = suffix[-1]
                # A row that repeats the document and place before it is the same window of a row that stands twice.
                twice = np.concatenate([[False], (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])])
                same = known | same & ~twice
                yield pa.RecordBatch.from_arrays([pa.array(doc[same]), pa.array(start[same]), pa.array(start[same] + LENGTH)], ["doc_id", "begin", "end"])

    dealt = contexts.mapInArrow(spread, "again boolean, suffix binary, doc_id long, start long").repartition(F.expr("if(again, xxhash64(doc_id, start), xxhash64(suffix))"))
    return dealt.sortWithinPartitions("again", "suffix", "doc_id", "start").mapInArrow(run, "doc_id long, begin long, end long")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, begin, end): bytes in 100-byte strings that also start earlier; runs may overlap."""
    found = stored(sort_parse(phrases(docs)), "parse")
    again = found.where("again").selectExpr("doc_id", "place >> 16 as begin", f"(place >> 16) + ((place >> 8) & 255) + {LENGTH - 1} as end")
    borders = found.where("not again").select("anchor", "doc_id", "place")
    many = borders.groupBy("anchor").count().where(F.col("count") > MANY).select("anchor")
    contexts = stored(with_bytes(docs, borders), "dictionary")
    few = sort_dictionary(contexts.join(many, "anchor", "left_anti"))
    rest = deal_suffixes(contexts.join(many, "anchor", "left_semi"))
    return stored(again.unionByName(few).unionByName(rest), "repeats")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept holds the remaining bytes."""
    name = docs.schema["doc_id"].dataType.simpleString()
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = base.where("doc_id is not null")
    repeats = repeated_runs(known)
    marks = filter_of(repeats)
    grouped = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def cut(batches):
        for b in blocks(batches):
            lists, removed, spans, kept = b.column("runs"), [], [], []
            for i in range(len(b)):
                text = b.raw(i)
                x = np.array([(r["begin"], r["end"]) for r in lists[i].as_py() or []], np.int64).reshape(-1, 2)
                edge = np.bincount(np.minimum(x[:, 0], len(text)), minlength=len(text) + 1) - np.bincount(np.minimum(x[:, 1], len(text)), minlength=len(text) + 1)
                gone = np.cumsum(edge)[: len(text)] > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0)
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(b.offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names)

    def whole(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            out = np.ones(len(batch), bool)
            sure = np.asarray(ids.is_valid())
            out[sure] = ~marks.value[slot(ids.drop_null().to_numpy())]
            for b in blocks([batch.filter(pa.array(out))]):
                zero = pa.array(np.zeros(len(b), np.int64))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(b.offsets)), zero, zero, pa.array([b.raw(i) for i in range(len(b))], pa.binary())], names)

    near = picked(known, marks).join(grouped, "doc_id", "left").mapInArrow(cut, schema)
    return near.unionByName(base.mapInArrow(whole, schema)).withColumn("doc_id", F.col("doc_id").cast(name))
