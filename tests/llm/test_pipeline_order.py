"""The order of the mixture and the N best paths in the pipeline's result."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from curastra.llm import mixing, pieces  # noqa: E402


def test_result_has_the_order_of_the_mixture(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: (r.slot, r.place) for r in mixing.place(docs).select("row.doc_id", "slot", "place").collect()}
    mixed = docs
    for k, stage in enumerate((corpus_pipeline.mix_sources, corpus_pipeline.encode)):
        stage(spark, mixed, sf_dir).repartition(5).write.parquet(f"{tmp_path}/{k}")
        mixed = spark.read.parquet(f"{tmp_path}/{k}")
    rows = mixed.collect()
    assert len(rows) == len(want) == len({r.place for r in rows})
    assert {r.doc_id: (r.slot, r.place) for r in rows} == want


def test_run_is_ordered_by_place(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).orderBy("place").collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    kept = [(r.doc_id, source[r.doc_id]) for r in rows]
    again = mixing.place(spark.createDataFrame(kept, "doc_id long, source string"))
    assert [k for k, _ in kept] == [r.doc_id for r in again.orderBy("place").select("row.doc_id").collect()]


def test_last_stage_gives_the_paths_of_the_operator(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: (r.ids, r.n_best, r.round_trip) for r in pieces.encode(docs).collect()}
    rows = corpus_pipeline.encode(spark, docs, sf_dir).collect()
    assert {r.doc_id: (r.ids, r.n_best, r.round_trip) for r in rows} == want
    assert all(r.round_trip for r in rows) and max(len(r.n_best) for r in rows) == pieces.N_BEST
