"""Queries on vectors: nearest neighbours, encoding, tagging."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import functions as F

from scriptorium.operators import ivf
from scriptorium.operators.embed import embed, hashing_encoder
from scriptorium.operators.knn import common_dimension, knn_join, left_out, majority_label
from scriptorium.plans import checking
from scriptorium.operators.writes import keyed_rows
from scriptorium.plans.tagging import concept_vectors, retag_documents, scene_concepts, tag_documents as tag
from scriptorium.operators.documents import segment_rows
from scriptorium.session import store
from scriptorium.sources.tables import load
from scriptorium.suite import fragments as Q

K = 5


def _neighbours(spark, d, **options):
    vectors = load(spark, d, "embeddings", "vec_id", "embedding")
    queries = vectors.select("vec_id", F.col("embedding").alias("vector"))
    return knn_join(queries, queries.withColumnRenamed("vec_id", "item_id"), K, exclude="vec_id", **options)


def knn_topk_large(spark, d):
    """The plan for catalogues beyond the broadcast bound: shards, one after another."""
    found = _neighbours(spark, d, max_broadcast_bytes=0, shard_bytes=400_000)
    return found.select("vec_id", "rank", "neighbour", F.round("distance", 6).alias("distance"))


def knn_cells(spark, d):
    """The inverted file with all cells probed, which is exact; every row must be certified."""
    vectors = load(spark, d, "embeddings", "vec_id", "embedding").select("vec_id", F.col("embedding").alias("vector"))
    index = ivf.build(vectors.withColumnRenamed("vec_id", "item_id"), block_rows=64)
    found = ivf.search(index, vectors, K, probes=index.cells, exclude="vec_id", block_rows=128)
    return found.where("certified").select("vec_id", "rank", "neighbour", F.round("distance", 6).alias("distance"))


def knn_approximate(spark, d):
    """Probes chosen for the recall wanted; measured for ids divisible by 100."""
    vectors = load(spark, d, "embeddings", "vec_id", "embedding").select("vec_id", F.col("embedding").alias("vector"))
    catalogue, checked = vectors.withColumnRenamed("vec_id", "item_id"), F.col("vec_id") % 100 == 0
    index = ivf.build(catalogue)
    probes = ivf.probes_for(index, catalogue, vectors.where(checked), K, target=0.95, exclude="vec_id")
    return ivf.search_with_recall(index, catalogue, vectors, checked, K, probes=probes, exclude="vec_id")


def knn_bad_rows(spark, d):
    """Every tenth vector is spoiled in one of four ways; a search skips it on both sides."""
    kind = F.col("vec_id") % 40
    bad = (F.when(kind == 0, F.lit(None).cast("array<double>")).when(kind == 10, F.slice("e", 1, 3))
           .when(kind == 20, F.concat(F.slice("e", 1, 63), F.array(F.lit(float("inf"))))).when(kind == 30, F.concat("e", "e")).otherwise(F.col("e")))
    vectors = load(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e")).select("vec_id", bad.alias("vector"))
    found = knn_join(vectors, vectors.withColumnRenamed("vec_id", "item_id"), K, exclude="vec_id", max_broadcast_bytes=0, shard_bytes=400_000)
    skipped = left_out(vectors, common_dimension(vectors)).select("vec_id", F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("neighbour"), "reason")
    return found.select("vec_id", "rank", F.col("neighbour").cast("bigint").alias("neighbour"), F.lit("found").alias("reason")).unionByName(skipped)


def embed_failures(spark, d):
    """An encoder that can't read texts with a digit in front: how many rows failed, and how many did not."""
    def make():
        encode = hashing_encoder()()

        def careful(texts):
            if any(t[:1].isdigit() for t in texts.to_pylist()):
                raise ValueError("digit")
            return encode(texts)
        return careful

    front = F.when(F.col("doc_id") % 2 == 1, F.lit("1")).otherwise(F.lit("x"))
    docs = load(spark, d, "documents").select("doc_id", F.concat(front, "text").alias("text"))
    return embed(docs, "text", make, error="error").groupBy(F.coalesce("error", F.lit("none")).alias("error")).agg(F.count("*").alias("n"))


def verify_scenes(spark, d):
    """A model that names the words it was given which are longer than three letters, and fails on Spanish texts."""
    def make():
        def answer(prompts):
            if any("qqq-es" in p for p in prompts):
                raise ValueError("language")
            return [json.dumps({"tropes": [w for w in re.search("Candidates: (.*)", p)[1].split(", ") if len(w) > 3 and w != "None"], "examples": []}) for p in prompts]
        return answer

    words = F.slice(F.filter(F.split("text", " "), lambda w: w.rlike("^[a-z]+$")), 1, 5)
    docs = load(spark, d, "documents").select("doc_id", F.concat(F.lit("qqq-"), "lang", F.lit(" "), "text").alias("text"), words.alias("names"))
    return checking.verify_scenes(docs, "text", "names", make).select("doc_id", F.array_join("confirmed", ",").alias("confirmed"), "score", "error")


def knn_topk(spark, d):
    return _neighbours(spark, d).select("vec_id", "rank", "neighbour", F.round("distance", 6).alias("distance"))


def knn_topk_label(spark, d):
    labels = load(spark, d, "embeddings").select(F.col("vec_id").alias("neighbour"), "label")
    return majority_label(_neighbours(spark, d).join(labels, "neighbour"), ["vec_id"], "label")


def _concepts(spark, d):
    named = load(spark, d, "benchmark").select(
        F.concat(F.lit("concept-"), F.lpad(F.col("item_id").cast("string"), 8, "0")).alias("name"), F.col("text").alias("definition"))
    return store(concept_vectors(named, "name", "definition"), "concepts")


def hash_embed(spark, d):
    vectors = embed(load(spark, d, "documents", "doc_id", "text"), "text")
    cells = vectors.select("doc_id", F.posexplode("vector").alias("bucket", "weight"))
    return cells.where(F.col("weight") != 0).select("doc_id", "bucket", F.col("weight").cast("int").alias("weight"))


def scene_topk(spark, d):
    scenes = segment_rows(load(spark, d, "documents", "doc_id", "text"), "doc_id", "text", Q.HEADERS)
    return scene_concepts(scenes, _concepts(spark, d), "segment", K).select(
        "doc_id", "ordinal", "rank", "neighbour", F.col("distance").cast("bigint").alias("distance"))


def document_topk(spark, d):
    docs = load(spark, d, "documents", "doc_id", "text")
    return scene_concepts(docs, _concepts(spark, d), "text", K).select(
        "doc_id", "rank", "neighbour", F.col("distance").cast("bigint").alias("distance"))


def tag_documents(spark, d):
    docs = load(spark, d, "documents", "doc_id", "text")
    tagged = tag(docs, _concepts(spark, d), "doc_id", "text", k=K, headers=Q.HEADERS)
    return tagged.select("doc_id", F.array_join("tropes", ",").alias("tropes"))


def retagged(spark, d):
    """Tagged, then tagged again with every tenth text changed: what each run looked at and encoded, and the tags that changed."""
    docs = load(spark, d, "documents", "doc_id", "text")
    later = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("\nThe end "), F.col("doc_id").cast("string"))).otherwise(F.col("text")))
    concepts, name = _concepts(spark, d), uuid.uuid4().hex
    out = []
    for run, now in enumerate((docs, later, later), 1):
        did = retag_documents(spark, now, concepts, "doc_id", "text", vectors=f"vectors_{name}", tags=f"tags_{name}", k=K, headers=Q.HEADERS)
        out.append((run, did["documents"], did["encoded"]))
    tagged = store(keyed_rows(spark, f"tags_{name}").select(F.lit(0).alias("run"), "doc_id", F.size("tropes").cast("bigint").alias("n")), "tags")
    for table in ("vectors", "tags"):
        spark.sql(f"DROP TABLE {table}_{name}")
    return tagged.unionByName(spark.createDataFrame(out, "run int, doc_id long, n long"))


QUERIES = {f.__name__: f for f in (retagged, knn_topk_large, knn_cells, knn_approximate, knn_bad_rows, embed_failures, verify_scenes, knn_topk, knn_topk_label, hash_embed, scene_topk, document_topk, tag_documents)}

_KNN = f"""
  v AS (SELECT vec_id, label, embedding::double[] AS e FROM embeddings),
  d AS (SELECT a.vec_id, b.vec_id AS neighbour, b.label, list_distance(a.e, b.e) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id),
  knn AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbour)::int AS rank FROM d QUALIFY rank <= {K})"""


def _nearest(queries: str, keys: str, text: str) -> str:
    pairs = " AND ".join(f"p.{k.strip()} = dot.{k.strip()}" for k in keys.split(","))
    return f"""
  concepts AS (SELECT 'concept-' || lpad(item_id::varchar, 8, '0') AS name, text FROM benchmark),
  {Q.hashed('concepts', 'name', 'text', 'cv')}, {Q.hashed(queries, keys, text, 'qv')},
  cn AS (SELECT c.name, coalesce(sum(weight * weight), 0) AS n FROM concepts c LEFT JOIN cv ON c.name = cv.name GROUP BY 1),
  qs AS (SELECT {keys}, coalesce(sum(weight * weight), 0) AS n FROM {queries} LEFT JOIN qv USING ({keys}) GROUP BY ALL),
  dot AS (SELECT {keys}, name, sum(qv.weight * cv.weight) AS x FROM qv JOIN cv ON qv.bucket = cv.bucket GROUP BY ALL),
  p AS (SELECT {keys}, name, qs.n + cn.n AS n FROM qs, cn),
  dist AS (SELECT {', '.join('p.' + k.strip() for k in keys.split(','))}, p.name AS neighbour, (n - 2 * coalesce(x, 0))::bigint AS distance
           FROM p LEFT JOIN dot ON {pairs} AND p.name = dot.name),
  best AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY distance, neighbour)::int AS rank FROM dist QUALIFY rank <= {K})"""


_SCENES = f"""
  cut AS (SELECT doc_id, {Q.segments('text')} AS s FROM documents),
  scenes AS (SELECT doc_id, (generate_subscripts(s, 1) - 1)::int AS ordinal, unnest(s) AS segment FROM cut),
  {_nearest('scenes', 'doc_id, ordinal', 'segment')}"""

#: ``knn_approximate`` has none: what an index misses is no matter of SQL. Its recall is tested.
_LATER = "CASE WHEN doc_id % 10 = 0 THEN text || chr(10) || 'The end ' || doc_id ELSE text END"

SQL = {
    "retagged": f"""
WITH later AS (SELECT doc_id, {_LATER} AS text FROM documents),
  a AS (SELECT DISTINCT unnest({Q.segments('text')}) AS s FROM documents),
  b AS (SELECT DISTINCT unnest({Q.segments('text')}) AS s FROM later),
  cut AS (SELECT doc_id, {Q.segments('text')} AS s FROM later),
  scenes AS (SELECT doc_id, (generate_subscripts(s, 1) - 1)::int AS ordinal, unnest(s) AS segment FROM cut),
  {_nearest('scenes', 'doc_id, ordinal', 'segment')},
  sets AS (SELECT doc_id, count(DISTINCT neighbour) AS n FROM best GROUP BY doc_id)
SELECT 0::int AS run, d.doc_id, coalesce(n, 0) AS n FROM documents d LEFT JOIN sets s ON d.doc_id = s.doc_id
UNION ALL SELECT 1, (SELECT count(*) FROM documents), (SELECT count(*) FROM a)
UNION ALL SELECT 2, (SELECT count(*) FROM documents WHERE doc_id % 10 = 0), (SELECT count(*) FROM b WHERE s NOT IN (SELECT s FROM a))
UNION ALL SELECT 3, 0, 0""",
    "knn_cells": f"WITH {_KNN} SELECT vec_id, rank, neighbour, round(dist * dist, 6) AS distance FROM knn",
    "knn_topk_large": f"WITH {_KNN} SELECT vec_id, rank, neighbour, round(dist * dist, 6) AS distance FROM knn",
    "knn_bad_rows": f"""
WITH g AS (SELECT vec_id, embedding::double[] AS e FROM embeddings WHERE vec_id % 10 <> 0),
  d AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.e, b.e) AS dist FROM g a JOIN g b ON a.vec_id <> b.vec_id),
  n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbour)::int AS rank FROM d QUALIFY rank <= {K})
SELECT vec_id, rank, neighbour::bigint AS neighbour, 'found' AS reason FROM n
UNION ALL SELECT vec_id, 0, NULL, CASE vec_id % 40 WHEN 0 THEN 'missing' WHEN 20 THEN 'values' ELSE 'length' END FROM embeddings WHERE vec_id % 10 = 0""",
    "embed_failures": "SELECT CASE WHEN doc_id % 2 = 1 THEN 'ValueError: digit' ELSE 'none' END AS error, count(*) AS n FROM documents GROUP BY 1",
    "verify_scenes": """
WITH w AS (SELECT doc_id, lang, list_filter(string_split(text, ' '), lambda w: regexp_full_match(w, '[a-z]+'))[1:5] AS names FROM documents),
  c AS (SELECT doc_id, lang, CASE WHEN lang = 'es' THEN [] ELSE list_filter(names, lambda w: length(w) > 3) END AS c FROM w)
SELECT doc_id, array_to_string(c, ',') AS confirmed, len(c)::double AS score,
       CASE WHEN lang = 'es' THEN 'ValueError: language' END AS error FROM c""",
    "knn_topk": f"WITH {_KNN} SELECT vec_id, rank, neighbour, round(dist * dist, 6) AS distance FROM knn",
    "knn_topk_label": f"""
WITH {_KNN}, votes AS (SELECT vec_id, label, count(*) AS votes FROM knn GROUP BY ALL)
SELECT vec_id, label, votes FROM votes QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, label) = 1""",
    "hash_embed": f"WITH {Q.hashed('documents', 'doc_id', 'text', 'v')} SELECT doc_id, bucket, weight FROM v WHERE weight <> 0",
    "scene_topk": f"WITH {_SCENES} SELECT doc_id, ordinal, rank, neighbour, distance FROM best",
    "document_topk": f"WITH {_nearest('documents', 'doc_id', 'text')} SELECT doc_id, rank, neighbour, distance FROM best",
    "tag_documents": f"""
WITH {_SCENES}, sets AS (SELECT doc_id, string_agg(DISTINCT neighbour, ',' ORDER BY neighbour) AS tropes FROM best GROUP BY doc_id)
SELECT d.doc_id, coalesce(tropes, '') AS tropes FROM documents d LEFT JOIN sets s ON d.doc_id = s.doc_id""",
}
