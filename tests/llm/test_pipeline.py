"""The pipeline, stage by stage, against plain versions of its stages."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from scriptorium.llm import privacy
from test_llm_operators import plain_components

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        seen[name] = before, {r.doc_id: r for r in docs.collect()}
        if name != "bpe_tokens":
            assert docs.columns == columns
    before, after = seen["toxicity"]
    assert 0.7 * len(before) < len(after) < len(before)
    before, after = seen["ngram_join"]
    assert set(after) == {i for i, _, c in plain_components(list(before.items()), 5, 80) if i == c}
    before, after = seen["decontaminate"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert set(after) == {i for i, t in before.items() if not any(x in " ".join(t.lower().split()) for x in items)}
    before, after = seen["privacy"]
    assert set(before) == set(after) and all(not privacy.rule_spans(r.text) and r.n_chars == len(r.text) for r in after.values())
    before, after = seen["bpe_tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {i: r.ids for i, r in after.items()} == {i: ",".join(map(str, library.encode(t, add_special_tokens=False).ids)) for i, t in before.items()}


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids"] and got.count() > 100


MORE = "__id string, __Digest int, __gone int, __terms string, digest long, node string, found int"


def _awkward(spark):
    from test_llm_operators import ROWS

    rows = [(i, t, "en", "src0", None if t is None else len(t), "x", 1, 0, "y", 7, "z", None) for i, t in ROWS]
    rows += [(50, "write to ann@host.org or +1 555 123 4567", "en", None, 5, *rows[0][5:])] * 3
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + MORE).repartition(4)


def test_stages_on_awkward_rows(spark):
    """Nulls, empty and very long texts, repeats, ids used twice, and columns with the names that stages use."""
    rows, docs = _awkward(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
        out = stage(spark, docs, FOLDER).cache()
        if name == "bpe_tokens":
            assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted((i for i, _ in before), key=repr)
            break
        after = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
        assert out.columns == columns and out.schema == docs.schema
        if name == "ngram_join":
            low = {(i, c) for i, _, c in plain_components(before, 5, 80)}
            assert {i for i, _ in after if i is not None} == {i for i, c in low if i is not None and i == c}
            assert {t for i, t in after if i is None} == {t for i, t in before if i is None} and len(after) == len(set(after))
        elif name == "privacy":
            assert len(after) == len(before) and [t for i, t in after if i == 50] == ["write to [email] or [phone]"]
        else:
            assert after == before
        docs = out


def test_stages_on_an_empty_table(spark):
    _, docs = _awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), FOLDER)
        assert out.count() == 0 and (name == "bpe_tokens" or out.columns == docs.columns)
