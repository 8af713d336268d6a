"""One row per key, by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key, nulls being smallest.

    A row number that only 1 is wanted of: each task keeps one row per key before the shuffle, so a key
    with very many rows costs no more than any other. ``order`` should be unique within a key.
    """
    return _pick(df, keys, [F.asc_nulls_first(c) for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` per key."""
    return _pick(df, keys, [F.desc_nulls_last(c) for c in order])


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_number", number).where(F.col("_number") == 1).drop("_number")


def by_priority(df: DataFrame, keys: Sequence[str], kind: str, priority: Sequence[str],
                order: Sequence[str]) -> DataFrame:
    """One row per key by the rank of its ``kind`` (unlisted kinds last), then by ``order``."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(kind)), F.lit(0))
    rank = F.when(rank == 0, F.lit(len(priority) + 1)).otherwise(rank)
    ranked = df.withColumn("_rank", rank)
    return keep_first(ranked, keys, ["_rank", *order]).drop("_rank")
