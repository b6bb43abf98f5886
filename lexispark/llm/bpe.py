"""Byte-level BPE by monoid tree reduction; decoding concatenates up the same tree.

Each match of the split pattern is a piece. A piece is encoded by halves, recursively, and
the neighbours are joined: a window of tokens about the seam is encoded anew and grown until
its outer borders are stable. The proof of stability is local: a sequence of tokens is the
encoding of its bytes exactly when the merges of every two adjacent tokens' bytes give those
two tokens again (the first merge over a border would also be made when only the two tokens
stand there). So a window whose two outer pairs pass this test leaves all other tokens as
they are. A piece that is itself in the vocabulary is one token, as in the public library.

The leaves of all new pieces of a block of texts are merged in step: each step makes one merge
in every leaf, the one of lowest rank, over arrays with a row for each place of a leaf. So a
piece costs a few array elements and no Python loop of its own.

A task keeps dictionaries of pieces, seams and pairs of bounded size. Long texts are matched
and hashed in runs and leaves are merged in batches, so that neither a long text nor a long
piece needs more than its tokens.

Defined cases: null is the empty text, with no tokens; rows that repeat give equal results.
"""

from __future__ import annotations

import base64
import hashlib
import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.arrowtext import blocks

#: Bytes that are merged directly (30 at most); tokens beside a seam that the first window holds; entries kept in each dictionary.
LEAF, SEAM, KEPT = 12, 2, 100_000
#: Leaves that are merged in step at a time; no key of a merge is as high as NEVER.
BATCH, NEVER = 4096, np.iinfo(np.int64).max
#: Pieces of a text that are handled at a time.
RUN = 200_000


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class TreeCodec:
    """Encoding and decoding of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pieces = ranks, regex.compile(pattern)
        self.tokens = {i: t for t, i in ranks.items()}
        self.none = max(self.tokens, default=0) + 1  # stands for no rank
        self.small: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()
        made = {}  # two neighbours as one number, and the rank of what they merge to
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    made[left * (self.none + 1) + right] = rank
        self.made = np.array([*sorted(made), NEVER], np.int64)
        self.makes = np.array([made[x] for x in self.made[:-1].tolist()] + [self.none], np.int64)
        self.bytes = np.array([ranks.get(bytes([i]), self.none) for i in range(256)], np.int64)
        self.first = self.rank(np.repeat(self.bytes, 256), np.tile(self.bytes, 256))  # of every two bytes
        self.numbers, self.names, self.values = (np.empty(self.none, object) for _ in range(3))
        for i, t in self.tokens.items():
            self.numbers[i], self.names[i], self.values[i] = i, str(i), t

    def forget(self) -> None:
        """Drop what was kept, so that a worker that Spark uses again holds no memory for it."""
        self.small.clear()
        self.pairs.clear()
        self.known: dict[str, int] = {}  # pieces, in the order of the rows of what follows
        self.ids, self.size, self.met = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)  # their tokens, one after the other; how many; when met last
        self.now = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of every two neighbours, the rank of the token that they merge to, or none."""
        pairs = left * (self.none + 1) + right
        at = np.searchsorted(self.made, pairs)
        return np.where(self.made[at] == pairs, self.makes[at], self.none)

    def leaves(self, leaves: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The merges of each leaf of a batch, all leaves in step: their tokens one after the other, and how many each has.

        Places are 1 to width, between two that hold no token. A token stands at its first byte's
        place, with links to the places of the tokens beside it; keys order the merges by rank, then place.
        """
        n, none, size = len(leaves), self.none, np.fromiter(map(len, leaves), np.int64, len(leaves))
        width = int(size.max(initial=0))
        places = np.arange(width + 2, dtype=np.int64)[:, None]
        data = np.frombuffer(b"".join([x.ljust(width, b"\0") for x in leaves]), np.uint8).reshape(n, width).T.astype(np.int64)
        token, key = np.full((width + 2, n), none), np.full((width + 2, n), NEVER)
        alive = (places >= 1) & (places <= size)
        token[1:-1] = np.where(alive[1:-1], self.bytes[data], none)
        first = self.first[data[:-1] * 256 + data[1:]]
        key[1:-2] = np.where(alive[2:-1] & (first < none), first * 32 + places[1:-2], NEVER)
        after, before = np.repeat(places + 1, n, 1), np.repeat(places - 1, n, 1)
        token_, key_, alive_, after_, before_ = (x.reshape(-1) for x in (token, key, alive, after, before))
        while True:
            low = key.min(0, initial=NEVER)
            row = np.flatnonzero(low < NEVER)
            if not len(row):
                break
            low = low[row]
            place, made = low % 32, low // 32
            at = place * n + row
            gone = after_[at] * n + row
            right = after_[gone]
            left = before_[at]
            after_[at], token_[at], key_[gone], alive_[gone] = right, made, NEVER, False
            right, beside = right * n + row, left * n + row
            before_[right] = place
            rank = self.rank(np.concatenate([made, token_[beside]]), np.concatenate([token_[right], made]))
            keys = np.where(rank < none, rank * 32 + np.concatenate([place, left]), NEVER)
            key_[at], key_[beside] = keys[: len(row)], keys[len(row) :]
        alive = alive[1:-1]
        return token[1:-1].T[alive.T], alive.sum(0)

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Merges of lowest rank first, the leftmost of equals; for short windows."""
        if (found := self.small.get(data)) is not None:
            return found
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        none = self.none
        pairs = [ranks.get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]  # only the pairs beside the merged part change
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        found = tuple(ranks[p] for p in parts)
        if len(self.small) >= KEPT:
            self.small.clear()
        self.small[data] = found
        return found

    def stable(self, left: int, right: int) -> bool:
        """Whether two adjacent tokens stay as they are."""
        if (found := self.pairs.get((left, right))) is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            both = self.tokens[left] + self.tokens[right]
            found = self.pairs[left, right] = (self.merge(both) if len(both) <= 4 * LEAF else self.merge_long(both)) == (left, right)
        return found

    def merge_long(self, data: bytes) -> tuple[int, ...]:
        """The merges of a pair of long tokens, by a linked list of parts and a heap."""
        import heapq

        n = len(data)
        end, last, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def push(i: int) -> None:
            j = end[i]
            if j < n and (r := self.ranks.get(data[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, j, end[j]))

        for i in range(n):
            push(i)
        alive = [True] * n
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if not alive[i] or end[i] != j or not alive[j] or end[j] != k:
                continue
            end[i], alive[j] = k, False
            if k < n:
                last[k] = i
            push(i)
            if last[i] >= 0:
                push(last[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return tuple(out)

    def join(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of a and b together."""
        if self.stable(a[-1], b[0]):
            return a + b
        left, right = SEAM, SEAM
        while True:
            left, right = min(left, len(a)), min(right, len(b))
            data = b"".join(self.tokens[t] for t in a[len(a) - left :] + b[:right])
            window = self.merge(data) if len(data) <= 4 * LEAF else self.merge_long(data)
            left_ok = left == len(a) or self.stable(a[-left - 1], window[0])
            right_ok = right == len(b) or self.stable(window[-1], b[right])
            if left_ok and right_ok:
                return a[: len(a) - left] + window + b[right:]
            left, right = left * (1 if left_ok else 2), right * (1 if right_ok else 2)

    def cut(self, data: bytes) -> list[bytes]:
        """The leaves of data."""
        half = len(data) // 2
        return [data] if len(data) <= LEAF else self.cut(data[:half]) + self.cut(data[half:])

    def reduce(self, size: int, leaves) -> tuple[int, ...]:
        """The encoding of size bytes, the tokens of whose leaves come one leaf after the other."""
        if size <= LEAF:
            return next(leaves)
        return self.join(self.reduce(size // 2, leaves), self.reduce(size - size // 2, leaves))

    def tree(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= LEAF:
            return self.merge(data)
        if len(data) > BATCH * LEAF // 2:
            half = len(data) // 2
            return self.join(self.tree(data[:half]), self.tree(data[half:]))
        ids, size = self.leaves(self.cut(data))
        ids = iter(self.numbers[ids].tolist())
        return self.reduce(len(data), (tuple(itertools.islice(ids, n)) for n in size.tolist()))

    def encode(self, text: str) -> list[int]:
        return [i for runs in self.encoded([text]) for ids in runs for i in ids.tolist()]

    def decode(self, ids) -> bytes:
        """Concatenation up a tree over the ids."""
        if len(ids) <= BATCH:
            ids = np.asarray(ids, np.int64)
            if ids.min(initial=0) < 0:
                raise KeyError(int(ids.min()))
            return b"".join(self.values[ids].tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def merged(self, leaves: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``leaves`` in batches."""
        parts = [self.leaves(leaves[i : i + BATCH]) for i in range(0, len(leaves), BATCH)]
        return tuple(np.concatenate([np.zeros(0, np.int64), *(x[k] for x in parts)]) for k in (0, 1))

    def trees(self, data: list[bytes]) -> list[tuple[int, ...]]:
        """The encodings of pieces of several leaves each; those of very many have batches of their own."""
        cuts = [self.cut(x) if len(x) <= BATCH else [] for x in data]
        ids, size = self.merged([x for leaves in cuts for x in leaves])
        ids = iter(self.numbers[ids].tolist())
        leaves = (tuple(itertools.islice(ids, n)) for n in size.tolist())
        return [self.reduce(len(x), leaves) if own else self.tree(x) for x, own in zip(data, cuts, strict=True)]

    def encode_pieces(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pieces in another order, their tokens one after the other, and how many each has."""
        data = [p.encode() for p in pieces]
        whole = list(map(self.ranks.get, data))
        kind = [0 if w is not None else 1 if len(x) <= LEAF else 2 for x, w in zip(data, whole, strict=True)]
        order = [[i for i, k in enumerate(kind) if k == wanted] for wanted in range(3)]
        ids, size = self.merged([data[i] for i in order[1]])
        trees = self.trees([data[i] for i in order[2]])
        ids = np.concatenate([np.array([whole[i] for i in order[0]], np.int32), ids.astype(np.int32), np.fromiter(itertools.chain.from_iterable(trees), np.int32)])
        size = np.concatenate([np.ones(len(order[0]), np.int64), size, np.array([len(x) for x in trees], np.int64)])
        return [pieces[i] for part in order for i in part], ids, size

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, one after the other, and how many each has; what was met lately is kept."""
        place = dict.fromkeys(pieces)
        row = list(map(self.known.get, place))
        place = dict(zip(place, row, strict=True))
        new = [p for p, r in place.items() if r is None]
        met = np.array([r for r in row if r is not None], np.int64)
        self.now += 1
        self.met[met] = self.now
        long = [p for p in new if len(p) >= 64]  # are not kept, so their rows come last
        new = [p for p in new if len(p) < 64]
        lists = [self.encode_pieces(x[i : i + 4 * BATCH]) for x in (new, long) for i in range(0, len(x), 4 * BATCH)]
        ids, size = (np.concatenate([own, *(x[k] for x in lists)]) for k, own in ((1, self.ids), (2, self.size)))
        place.update(zip(itertools.chain.from_iterable(x[0] for x in lists), itertools.count(len(self.known)), strict=False))
        rows = np.fromiter(map(place.__getitem__, pieces), np.int64, len(pieces))
        first, n = np.cumsum(size) - size, size[rows]
        out = ids[np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        self.known.update((p, place[p]) for p in itertools.islice(itertools.chain.from_iterable(x[0] for x in lists), len(new)))
        self.size = size[: len(self.known)]
        self.ids = ids[: self.size.sum()]
        self.met = np.concatenate([self.met, np.full(len(new), self.now)])
        if len(self.known) > 2 * KEPT:
            stay = np.zeros(len(self.known), bool)
            stay[np.argsort(-self.met, kind="stable")[:KEPT]] = True
            self.known = dict(zip(itertools.compress(self.known, stay.tolist()), range(KEPT), strict=True))
            self.ids, self.size, self.met = self.ids[np.repeat(stay, self.size)], self.size[stay], self.met[stay]
        return out, n

    def encoded(self, texts: list[str]):
        """For each text its tokens in runs; the new pieces of all texts but the long ones are encoded together."""
        short = [self.pieces.findall(t) if len(t) <= RUN else [] for t in texts]
        ids, n = self.learn([p for x in short for p in x])
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *map(len, short)])].tolist()
        for text, a, b in zip(texts, ends, ends[1:], strict=False):
            yield [ids[a:b]] if len(text) <= RUN else (self.learn(run)[0] for run in self.runs(text))

    def digests(self, texts: list[str], kept: list[np.ndarray] | None = None):
        """Of each text the number of tokens and the digests of the written ids and of the bytes they decode to; the ids go to kept."""
        for runs in self.encoded(texts):
            written, data, n, own = hashlib.sha256(), hashlib.sha256(), 0, [np.zeros(0, np.int32)]
            for ids in runs:
                line = " ".join(self.names[ids].tolist()).encode()
                written.update(b" " + line if n else line)
                data.update(self.decode(ids))
                n += len(ids)
                if kept is not None:
                    own.append(ids)
            if kept is not None:
                kept.append(np.concatenate(own))
            yield n, written.hexdigest(), data.hexdigest()

    def runs(self, text: str):
        matches = (m.group() for m in self.pieces.finditer(text))
        while run := list(itertools.islice(matches, RUN)):
            yield run


_codecs: dict[str, TreeCodec] = {}


def codec(path: str, pattern: str) -> TreeCodec:
    """A task's codec of the vocabulary at path, or of the copy that Spark has sent."""
    if path not in _codecs:
        try:
            data = open(path, "rb").read()
        except FileNotFoundError:
            data = open(SparkFiles.get(path.rsplit("/", 1)[-1]), "rb").read()
        _codecs[path] = TreeCodec(load_ranks(data), pattern)
    return _codecs[path]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, token_ids): the ids of every whole text."""
    name = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = codec(path, pattern)
        for b in blocks(batches):
            texts = [b.raw(i).decode() for i in range(len(b))]
            ids = [np.concatenate([np.zeros(0, np.int32), *runs]) for runs in own.encoded(texts)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "token_ids"])
        own.forget()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, token_ids array<int>")


def decode_tokens(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text): what the ids stand for; bytes that are no UTF-8 become U+FFFD."""
    name = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            texts = [own.decode(x.as_py() or []).decode("utf-8", "replace") for x in batch.column("token_ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "token_ids").mapInArrow(run, f"doc_id {name}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text; with keep_ids, token_ids too."""
    name = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * keep_ids]

    def run(batches):
        own = codec(path, pattern)
        for b in blocks(batches):
            kept: list[np.ndarray] | None = [] if keep_ids else None
            n, ids, data = zip(*own.digests([b.raw(i).decode() for i in range(len(b))], kept), strict=True)
            columns = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(data, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([pa.array(kept, pa.list_(pa.int32()))] if keep_ids else [])], names)
        own.forget()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids)


def round_trips_exactly(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, exact): whether decoding gives the text's bytes again."""
    text = docs.select(F.col("doc_id").alias("__doc"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("__sha"))
    done = round_trip(docs, path, pattern)
    return done.join(text, done["doc_id"].eqNullSafe(text["__doc"])).select("doc_id", "n_tokens", (F.col("decoded_sha256") == F.col("__sha")).alias("exact"))
