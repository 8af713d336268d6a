"""What a task keeps is bounded, and batches of the pipeline's stages are, whoever runs them."""

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from scriptorium.llm import bpe_tokens, common, decontaminate, privacy

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_words_are_bounded_within_a_text(monkeypatch):
    monkeypatch.setattr(bpe_tokens, "WORDS", 100)
    own, library = bpe_tokens.Encoder(BPE), Tokenizer.from_file(BPE)
    text = " ".join(f"the w{i % 700} x{i % 30}" for i in range(2000))
    assert own.encode(text) == ",".join(map(str, library.encode(text, add_special_tokens=False).ids))
    assert 0 < len(own.words) <= 100


def test_a_task_leaves_no_encoder():
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": pa.array(["two words"])})
    assert next(bpe_tokens._rows(BPE, True)([batch])).num_rows == 1
    assert sum(b.num_rows for b in bpe_tokens._rows(BPE, True)([batch])) == 1 and not bpe_tokens._ready


@pytest.mark.parametrize("module, operator, stage", [(decontaminate, "drop_leaking", "decontaminate"), (privacy, "sanitised_rows", "privacy"), (bpe_tokens, "encode_documents", "bpe_tokens")])
def test_stages_have_small_batches(spark, monkeypatch, module, operator, stage):
    """In a session of its usual batches of 10,000 rows, written by the caller."""
    seen = spark.createDataFrame([(i, "a text of its own", 0, "") for i in range(3 * common.ARROW_ROWS)], "doc_id long, text string, n_tokens long, ids string").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([b.num_rows] * b.num_rows, pa.int64()), b.column(3)], names=b.schema.names)

    monkeypatch.setattr(module, operator, lambda docs, *more: docs.mapInArrow(sizes, docs.schema))
    out = dict(corpus_pipeline.STAGES)[stage](spark, seen, "/root/testdata/sf0.001")
    assert 0 < max(r.n_tokens for r in out.select("n_tokens").collect()) <= common.ARROW_ROWS
