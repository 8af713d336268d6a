"""Concepts per document: scenes, vectors, nearest concepts, one set per document."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.text import SCENE_HEADERS
from scriptorium.operators.dedupe import keep_last
from scriptorium.operators.documents import segment_rows
from scriptorium.operators.embed import embed
from scriptorium.operators.knn import knn_join
from scriptorium.operators.merge import keyed_update
from scriptorium.operators.stats import set_union
from scriptorium.operators.writes import append_keyed, create_keyed, keyed_rows, update_keyed
from scriptorium.session import store


def concept_vectors(concepts: DataFrame, name: str, definition: str, order: str | None = None,
                    make_encoder: Callable | None = None) -> DataFrame:
    """``(item_id, vector)`` by concept name, for concepts that have a definition.

    With ``order`` the last definition of a name is taken. Store the result before searching in
    it, so that the encoder runs once.
    """
    defined = concepts.where(F.col(definition).isNotNull())
    if order:
        defined = keep_last(defined, [name], [order])
    return embed(defined.select(F.col(name).alias("item_id"), F.col(definition).alias("text")), "text", make_encoder)


def scene_concepts(scenes: DataFrame, concepts: DataFrame, text: str, k: int = 5,
                   make_encoder: Callable | None = None) -> DataFrame:
    """The ``k`` nearest concepts of every scene; ``concepts`` from ``concept_vectors``."""
    return knn_join(embed(scenes, text, make_encoder), concepts, k)


def document_concepts(docs: DataFrame, concepts: DataFrame, key: str, text: str, *, k: int = 5,
                      headers: Sequence[str] = SCENE_HEADERS, make_encoder: Callable | None = None,
                      field: str = "tropes") -> DataFrame:
    """``(key, field)``: the sorted set of concepts near any scene of the document.

    Only concept names are shuffled. Kept as a table of its own, this spares rewriting the texts.
    """
    scenes = segment_rows(docs, key, text, headers)
    return set_union(scene_concepts(scenes, concepts, "segment", k, make_encoder), key, "neighbour", field)


def tag_documents(docs: DataFrame, concepts: DataFrame, key: str, text: str, *, field: str = "tropes", **options) -> DataFrame:
    """Documents with ``field`` set to their concepts; ``options`` as for ``document_concepts``."""
    sets = document_concepts(docs, concepts, key, text, field=field, **options)
    if field not in docs.columns:
        docs = docs.withColumn(field, F.array().cast("array<string>"))
    return keyed_update(docs, sets, key, field, unique=True)


def remember_vectors(spark: SparkSession, table: str, texts: DataFrame, text: str, make_encoder: Callable | None = None) -> int:
    """Encode the texts that ``table`` has no vector of yet, each distinct one once, and say how many those were.

    The table is keyed by the text's SHA-256 and holds ``(digest, vector)``.
    """
    digests = texts.select(F.sha2(text, 256).alias("digest"), F.col(text).alias("text")).where("text is not null")
    if spark.catalog.tableExists(table):
        digests = digests.join(keyed_rows(spark, table).select("digest"), "digest", "left_anti")
    fresh = store(digests.dropDuplicates(["digest"]), "texts")
    return append_keyed(spark, table, embed(fresh, "text", make_encoder), "digest")


def retag_documents(spark: SparkSession, docs: DataFrame, concepts: DataFrame, key: str, text: str, *, vectors: str, tags: str, k: int = 5,
                    headers: Sequence[str] = SCENE_HEADERS, make_encoder: Callable | None = None, field: str = "tropes") -> dict[str, int]:
    """Bring the table ``tags`` (keyed by ``key``, with ``field``) up to date: ``{"documents": looked at anew, "encoded": distinct scenes encoded}``.

    A document is looked at if it is new or its text changed, and of its scenes only those that ``vectors`` does not know are encoded, whichever
    document had them first. The text's digest is written last, so a broken run is taken up again. Another catalogue of concepts needs another table of tags.
    """
    now = docs.where(F.col(key).isNotNull()).select(key, text, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("digest"))
    blank = now.select(key, F.lit(None).cast("string").alias("digest"), F.array().cast("array<string>").alias(field))
    create_keyed(spark, tags, blank, key)
    known = keyed_rows(spark, tags)
    changed = store(now.join(known.select(key, "digest"), [key, "digest"], "left_anti"), "changed")
    scenes = store(segment_rows(changed, key, text, headers).withColumn("digest", F.sha2("segment", 256)), "scenes")
    encoded = remember_vectors(spark, vectors, scenes, "segment", make_encoder)
    found = knn_join(scenes.select(key, "ordinal", "digest").join(keyed_rows(spark, vectors), "digest").drop("digest"), concepts, k)
    sets = changed.select(key).join(set_union(found, key, "neighbour", field), key, "left").select(key, F.coalesce(field, F.array().cast("array<string>")).alias(field))
    sets = store(sets, "sets")
    append_keyed(spark, tags, blank.join(changed.select(key), key, "left_semi"), key)
    update_keyed(spark, tags, sets, key, field)
    update_keyed(spark, tags, changed.select(key, "digest"), key, "digest")
    return {"documents": changed.count(), "encoded": encoded}
