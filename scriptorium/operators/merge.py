"""Joins of catalogues and keyed writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.dedupe import keep_first

BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left_only", "right_only"


def _same(left: DataFrame, right: DataFrame, on: dict[str, str]) -> Column:
    cond = F.lit(True)
    for a, b in on.items():
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def outer_merge(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                indicator: str = "indicator") -> DataFrame:
    """Full outer join on one key with a provenance column; many-to-many, nulls equal nulls.

    Written as a left outer join plus the unmatched right rows. This shuffles the right side and
    the left keys once more than a full outer join would, but AQE can split a key that holds a
    large part of the rows in both of these joins, and cannot in a full outer join. So the right
    side should be the smaller one. The column names of the two sides must differ.
    """
    on = {left_key: right_key}
    marked = right.withColumn("_in_right", F.lit(True))
    matched = left.join(marked, _same(left, marked, on), "left")
    matched = matched.withColumn(
        indicator, F.when(F.col("_in_right"), F.lit(BOTH)).otherwise(F.lit(LEFT_ONLY))
    ).drop("_in_right")
    rest = right.join(left, _same(right, left, {right_key: left_key}), "left_anti")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    rest = rest.select(*missing, *right.columns, F.lit(RIGHT_ONLY).alias(indicator))
    return matched.unionByName(rest)


def prioritized_merge(first: DataFrame, second: DataFrame, key: str, value: str,
                      first_kind: str = "pdf", second_kind: str = "html",
                      kind: str = "kind") -> DataFrame:
    """Merge two catalogues ``(key, value)``: the first one wins, the second one fills in.

    A key found in the first catalogue keeps that catalogue's value even where it is null, and
    the provenance decides the kind.
    """
    a = first.select(F.col(key).alias("_key_1"), F.col(value).alias("_value_1"))
    b = second.select(F.col(key).alias("_key_2"), F.col(value).alias("_value_2"))
    merged = outer_merge(a, b, "_key_1", "_key_2", "_from")
    from_first = F.col("_from") != RIGHT_ONLY
    return merged.select(
        F.when(from_first, F.col("_key_1")).otherwise(F.col("_key_2")).alias(key),
        F.when(from_first, F.col("_value_1")).otherwise(F.col("_value_2")).alias(value),
        F.when(from_first, F.lit(first_kind)).otherwise(F.lit(second_kind)).alias(kind),
    )


def keep_matching(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def keep_unmatched(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def append_new_keys(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The rows of ``incoming`` whose key is not stored yet, one per key.

    Appending these makes a repeated run harmless. Rows sharing a key are ordered by all their
    columns, so that the choice does not depend on the partitioning.
    """
    fresh = incoming.join(existing.select(key), key, "left_anti")
    return keep_first(fresh, [key], [c for c in fresh.columns if c != key] or [key])


def keyed_update(target: DataFrame, updates: DataFrame, key: str, field: str, unique: bool = False) -> DataFrame:
    """Set ``field`` on the rows of ``target`` that have an update; leave all others alone.

    A null update leaves the stored value; of several for a key the largest is taken. With
    ``unique`` the caller vouches for one row per key, which saves an aggregate.
    """
    new = updates.select(F.col(key), F.col(field).alias("_new"))
    if not unique:
        new = new.groupBy(key).agg(F.max("_new").alias("_new"))
    joined = target.join(new, key, "left")
    columns = [F.coalesce(F.col("_new"), F.col(field)).alias(field) if c == field else F.col(c)
               for c in target.columns]
    return joined.select(*columns)


def unmatched_updates(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates without a target row; to be reported, not written."""
    return updates.join(target.select(key), key, "left_anti")


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, value: str,
           default: str | None = None, out: str | None = None) -> DataFrame:
    """Add ``value`` from a table keyed by ``table_key``; ``default`` where there is no row."""
    found = table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v"))
    shown = F.col("_v") if default is None else F.coalesce(F.col("_v"), F.lit(default))
    return df.join(found, F.col(key) == F.col("_k"), "left").select(*df.columns, shown.alias(out or value))


def rename_columns(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace ``old`` by ``new`` in every column name; names without it stay."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])
