"""Tokens against the public libraries."""

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexispark.llm import bpe, token_counts

from . import brute

RANKS = P.path("byte_bpe_50k.tiktoken")
CODEC = bpe.codec(RANKS, P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})
COUNTER = token_counts.tokenizer(P.path("byte_bpe_50k.json"))
PARTS = st.lists(st.sampled_from(["a", "aa", "the", "tion", " ", "  ", "é", "ß", "1", "\n", "日", "🙂", "ing", "ER", "'s", "<|endoftext|>", "$", "ab" * 40]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), PARTS))
def test_tree_equals_library(text):
    ids = CODEC.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


def test_long_pieces():
    for text in ("a" * 5000, "ab" * 4000, "=" * 3000, "tion" * 1500):
        assert CODEC.encode(text) == LIBRARY.encode_ordinary(text)


def test_new_pieces_are_merged_in_step(monkeypatch):
    """A new piece needs no merges of its own in Python: those of all pieces of a text are made together."""
    calls, merge = [], bpe.TreeCodec.merge
    monkeypatch.setattr(bpe.TreeCodec, "merge", lambda self, data: calls.append(data) or merge(self, data))
    parts = ["ti", "ach", "é", "ß", "qu", "er", "z"]
    text = " ".join(parts[i % 7] + parts[i // 7 % 7] + parts[i // 49 % 7] + str(i % 10) for i in range(3430))
    assert bpe.TreeCodec(CODEC.ranks, P.PATTERN).encode(text) == LIBRARY.encode_ordinary(text)
    assert len(calls) < 30


def test_small_stores_runs_and_batches(monkeypatch):
    texts = ["", "one", "ab" * 200, *("".join(f" w{(i * i + k) % 90}{'tion' * (i % 9)} é{i}" for i in range(120)) for k in range(6)), "x " * 90]
    want = [LIBRARY.encode_ordinary(t) for t in texts]
    for name, value in (("KEPT", 30), ("RUN", 600), ("BATCH", 7)):
        monkeypatch.setattr(bpe, name, value)
    own, kept = bpe.TreeCodec(CODEC.ranks, P.PATTERN), []
    for _ in range(2):
        got = list(own.digests(texts, kept))
        assert got == [(len(x), brute.sha(" ".join(map(str, x))), brute.sha(t)) for t, x in zip(texts, want, strict=True)]
    assert [x.tolist() for x in kept] == want + want
    assert len(own.known) <= 60 and len(own.small) <= 60


def test_round_trip(docs, texts, empty):
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.token_ids)) for r in bpe.round_trip(docs, RANKS, P.PATTERN, keep_ids=True).collect())
    want = []
    for d, t in texts:
        ids = LIBRARY.encode_ordinary(t or "")
        want.append((d, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or ""), ids))
    assert got == sorted(want)
    decoded = bpe.decode_tokens(bpe.encode_documents(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert sorted(map(tuple, decoded.collect())) == sorted((d, t or "") for d, t in texts)
    assert bpe.round_trips_exactly(docs, RANKS, P.PATTERN).where(~F.col("exact")).count() == 0
    assert bpe.round_trip(empty, RANKS, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(PARTS, st.sampled_from([4, 15, 60]), st.sampled_from([1, 5]))
def test_spliced_counts_equal_whole_counts(text, chunk, overlap):
    assert token_counts.count_long(COUNTER, text, chunk, overlap) == len(COUNTER.encode(text, add_special_tokens=False).ids)


def test_splices_of_texts_without_word_breaks(monkeypatch):
    seen = []
    whole = token_counts.pieces
    monkeypatch.setattr(token_counts, "pieces", lambda own, text, a, b: seen.append(b - a) or whole(own, text, a, b))
    words = ["日本語の文章です。", "中文没有空格，", "line\n", "x=1;\n", "{}();", "  \n\n", "🙂🙂", "<|endoftext|>"]
    texts = ["".join(words[(i * i + k) % len(words)] for i in range(900)) for k in range(4)] + ["one\nword\na\nline\n" * 800, "日本語" * 3000, " " * 9000, "a" * 4000 + "。" + "b" * 4000]
    for text in texts:
        assert token_counts.count_long(COUNTER, text, 700, 60) == len(COUNTER.encode(text, add_special_tokens=False).ids)
    assert max(seen) > 5000  # an unbroken run widens the overlap up to its end
    seen.clear()
    token_counts.count_long(COUNTER, texts[0], 700, 60)
    assert max(seen) <= 760  # where pieces end, the first overlap is enough


def test_counts(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", 500)
    got = sorted(map(tuple, token_counts.count_tokens(docs, P.path("byte_bpe_50k.json")).collect()))
    want = [(d, len((t or "").encode()), n := len(COUNTER.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in texts]
    assert got == sorted(want)
    assert token_counts.count_tokens(empty, P.path("byte_bpe_50k.json")).count() == 0
