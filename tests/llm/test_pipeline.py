"""The pipeline's stages, each against a plain version on its own input."""

import public_tokenizers as P
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from . import brute  # noqa: E402
from .conftest import BENCH  # noqa: E402
from .test_tokens import LIBRARY  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages(spark, texts, tmp_path):
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(d, t, None if d % 7 == 0 else "en", "s", len(t or "")) for d, t in dict(texts).items()]
    docs = spark.createDataFrame([(d, (t or "").replace("\x00", ""), lang, s, n) for d, t, lang, s, n in rows], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        out = spark.read.parquet(str(tmp_path / f"out{k}"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            kept[name] = {r.doc_id: r.text for r in out.collect()}
        if name == "language_id":
            assert {70, 71, 72, 76} & set(kept[name]) == set() and {0, 1, 20, 80} <= set(kept[name])
        elif name == "line_dedup":
            want = {d: (n, sha) for d, n, _, sha in brute.lines(list(before.items()))}
            assert {d: brute.sha(t or "") for d, t in kept[name].items()} == {d: sha for d, (_, sha) in want.items()}
            assert all(r.n_chars == len(r.text) for r in out.collect())
        elif name == "near_duplicates":
            assert set(kept[name]) == {d for d, (_, c) in brute.components(list(before.items()), 5, 80).items() if c == d}
        elif name == "decontamination":
            assert set(kept[name]) == {d for d, t in before.items() if not brute.passages(t, BENCH)[1]}
        else:
            assert {r.doc_id: list(r.token_ids) for r in out.collect()} == {d: LIBRARY.encode_ordinary(t or "") for d, t in before.items()}
        docs = out
    last = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert last == {r.doc_id: r.ids_sha256 for r in docs.collect()}
    assert P.path("byte_bpe_50k.tiktoken")


def test_empty_table(spark, tmp_path):
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
