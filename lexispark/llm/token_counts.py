"""Token counts of whole texts, huge ones by overlapping chunks that are spliced again.

Texts up to ``CHUNK`` characters go to the tokenizer as they are. A longer one is encoded in
chunks that overlap, with the characters' offsets. The tokenizer first cuts a text into pieces,
from left to right and without looking back, and tokens never cross pieces. So from a place
where a piece begins, all further pieces depend only on what follows. Where a chunk that was
encoded from such a place and the next chunk both begin a piece at the same place of their
overlap, the tokens of the next chunk are right from there on: this place is a proven stable
border, and the two encodings are spliced there. Pieces near the end of a chunk are no proof, as
the cut may have changed them: ``SURE`` characters more than the longest special string are kept
off. Where an overlap has no common border, it is widened by encoding the chunk before anew up
to a later end, at last up to the end of the text.

Defined cases: null is the empty text, with no bytes and no tokens; repeated rows are counted
each on its own.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from lexispark.llm.arrowtext import blocks

#: Characters of a chunk and of its first overlap with the next; characters before a cut that prove nothing; bytes given to the tokenizer at a time.
CHUNK, OVERLAP, SURE, BATCH_BYTES = 50_000, 400, 4, 1 << 19
LIMIT = 512

_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """A task's tokenizer; its own threads stay off, as Spark deals out the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        _loaded[path] = Tokenizer.from_file(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    return _loaded[path]


def longest_special(own: Tokenizer) -> int:
    return max((len(t.content) for t in own.get_added_tokens_decoder().values()), default=0)


def pieces(own: Tokenizer, text: str, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of text[first:last] begin in the text, and the tokens of each."""
    encoded = own.encode(text[first:last], add_special_tokens=False)
    of = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
    head = np.flatnonzero(np.diff(of, prepend=-2))
    begin = np.array([a for a, _ in encoded.offsets], np.int64)[head] + first
    return begin, np.diff(head, append=len(of))


def count_long(own: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a long text by chunks that overlap by ``overlap`` characters, or more where they have no common border."""
    unsure = SURE + longest_special(own)
    overlap = max(overlap, unsure + 1)
    total, known, wide, stop = 0, 0, overlap, min(len(text), chunk + overlap)  # known: a proven border, counted up to there
    begin, n = pieces(own, text, 0, stop)
    while stop < len(text):
        cut, end = max(stop - wide, 0), min(len(text), stop + chunk)
        next_begin, next_n = pieces(own, text, cut, end)
        common = np.intersect1d(begin[(begin > known) & (begin >= cut) & (begin <= stop - unsure)], next_begin)
        if len(common):
            border = int(common[-1])
            total += int(n[(begin >= known) & (begin < border)].sum())
            known, begin, n, stop, wide = border, next_begin, next_n, end, overlap
        else:
            wide *= 4
            stop = min(len(text), stop + wide)
            begin, n = pieces(own, text, known, stop)
    return total + int(n[begin >= known].sum())


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    name = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = tokenizer(path)
        for b in blocks(batches, BATCH_BYTES):
            texts = [b.raw(i).decode() for i in range(len(b))]
            short = [i for i, t in enumerate(texts) if len(t) <= CHUNK]
            n = [0] * len(texts)
            for i, found in zip(short, own.encode_batch_fast([texts[i] for i in short], add_special_tokens=False), strict=True):
                n[i] = len(found)
            for i, t in enumerate(texts):
                if len(t) > CHUNK:
                    n[i] = count_long(own, t)
            size = (b.offsets[1:] - b.offsets[:-1]).astype("int64")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, n_bytes long, n_tokens long, over_limit boolean")
