"""Labelled rows for training: a bounded sample, never the held-out quarter."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from scriptorium.llm.common import two_columns

#: Most labelled documents a model is fitted on.
MOST = 6_000


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether an id belongs to the quarter that labels are never learned from. A null id does not."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int = MOST) -> DataFrame:
    """``doc_id``, ``text``, ``y`` of at most ``most`` labelled documents, taken by hash. The broadcast is the sample's ids.

    Of equal texts with equal labels one row is used, lest copies pass for evidence. Repeated labels of one id count as one (the larger); null labels and ids don't count.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where("doc_id is not null and y is not null").where(~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = two_columns(docs).join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")
    first = rows.select("y", F.md5("text").alias("same"), "doc_id").groupBy("y", "same").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return rows.join(F.broadcast(first), "doc_id", "left_semi")


def scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` from ``score(batches)``, which yields ids and scores."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for ids, values in score(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.float64())], schema=schema)

    return two_columns(docs).mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
