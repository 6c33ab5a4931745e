"""The pipeline stage by stage, against the operators and brute force."""

import pytest

pytest.importorskip("curastra.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from curastra.llm import pieces, privacy, quality  # noqa: E402

from .test_text_operators import brute_components  # noqa: E402


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in out.collect()}
        assert out.count() == len(after) and set(after) <= set(before)
        if name != "sentencepiece":
            assert out.columns == columns
        if name == "quality_classifier":
            found = quality.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert set(after) == {r.doc_id for r in found.collect() if r.predicted}
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            clean = [k for k in before if labels.get(k) == 1]
            assert len([k for k in clean if k in after]) >= 0.97 * len(clean)
        elif name == "minhash_near_dedup":
            comps = brute_components({k: r.text for k, r in before.items()}, 5, 80, 100)
            assert set(after) == {k for k, (_, c) in comps.items() if c == k}
        elif name == "pii":
            assert set(after) == set(before)
            spans = {r.doc_id: r.found for r in privacy.find(docs).collect()}
            changed = {k for k in after if after[k].text != before[k].text}
            assert changed == {k for k, s in spans.items() if s}
            assert all(after[k].n_chars == len(after[k].text) for k in changed)
            assert not any(any(x.kind < 4 for x in r.found) for r in privacy.find(out).collect())
        elif name == "mix_sources":
            assert after == before
        else:
            v = pieces.Vocabulary.load(pieces.default_model())
            import numpy as np

            for k, r in after.items():
                back, _ = pieces.decode_ids(v, np.array(r.ids, dtype=np.int64), np.array([0, len(r.ids)]))
                assert back.tobytes().decode() == (before[k].text or "")
        docs, seen[name] = out, after
    run = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert run == {k: r.ids for k, r in seen["sentencepiece"].items()}


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
