"""Batches of whole texts with all columns, between the pipeline's stages."""

import pyarrow as pa
import pytest

import corpus_pipeline
from scriptorium.llm import bpe_tokens, decontaminate, privacy, toxicity


@pytest.mark.parametrize("module, operator, stage", [(decontaminate, "drop_leaking", "decontaminate"), (privacy, "sanitised_rows", "privacy"), (bpe_tokens, "encode_documents", "bpe_tokens")])
def test_stored_stages_have_batches_of_500_rows(spark, monkeypatch, module, operator, stage):
    rows = spark.createDataFrame([(i, "a text of its own", 0, "") for i in range(3000)], "doc_id long, text string, n_tokens long, ids string").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([b.num_rows] * b.num_rows, pa.int64()), b.column(3)], names=b.schema.names)

    monkeypatch.setattr(module, operator, lambda docs, *more: docs.mapInArrow(sizes, docs.schema))
    out = dict(corpus_pipeline.STAGES)[stage](spark, rows, "/root/testdata/sf0.001")
    assert 0 < max(r.n_tokens for r in out.select("n_tokens").collect()) <= 500


def test_rows_that_are_not_toxic_go_back_in_small_batches():
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(1700)), "text": pa.array([None, "x"] * 850)})
    parts = list(toxicity._parts(batch, pa.array([i % 3 > 0 for i in range(1700)])))
    assert max(b.num_rows for b in parts) <= 500
    assert pa.Table.from_batches(parts).to_pylist() == [r for r in batch.to_pylist() if r["doc_id"] % 3]
    assert not list(toxicity._parts(batch.slice(0, 0), pa.array([], pa.bool_())))
