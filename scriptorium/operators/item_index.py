"""Which sets hold an item, without reading the sets: an index kept in step with a keyed table.

The index has a row for every item of a set, ``(item, key, version, live)``, sorted by item, so that a look-up is an equality on a sorted column, which Parquet's
statistics narrow down to the row groups with that item. An item that a third of all sets hold is spread over many files. An update appends what it changes;
the last version of a pair counts. ``compact`` drops what is out of date.

What is new goes into the index before the table, what is gone leaves it after, and ``rows_with_item`` looks at the sets it found. So a broken run never hides a row, and
repeating it sets the rest right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.writes import keyed_rows, rows_of_keys, update_keyed
from scriptorium.session import store


def _append(spark: SparkSession, index: str, pairs: DataFrame, key: str, version: int, live: bool) -> None:
    rows = pairs.select("item", key, F.lit(version).cast("bigint").alias("version"), F.lit(live).alias("live"))
    rows.repartitionByRange("item", key).sortWithinPartitions("item", key).write.mode("append").saveAsTable(index)


def build_index(spark: SparkSession, table: str, index: str, key: str, items: str) -> None:
    """Index the sets in column ``items`` of a keyed table."""
    pairs = keyed_rows(spark, table).select(key, F.explode(F.array_distinct(items)).alias("item")).where("item is not null")
    _append(spark, index, pairs, key, 0, True)


def update_sets(spark: SparkSession, table: str, index: str, updates: DataFrame, key: str, items: str) -> DataFrame:
    """``update_keyed`` for the sets, and the index with it. Only pairs that change are written; returns the updates without a row."""
    new = updates.select(key, items).groupBy(key).agg(F.max(items).alias("_new")).where("_new is not null")  # the same choice that the update makes
    new = store(new, "new")
    old = rows_of_keys(spark, table, new, key).select(key, F.coalesce(items, F.array().cast(new.schema["_new"].dataType)).alias("_old"))
    both = store(old.join(new, key).where("not _old <=> _new"), "changes")
    version = 1 + (spark.table(index).agg(F.max("version")).first()[0] or 0)
    fresh, gone = (both.select(key, F.explode(F.array_except(a, b)).alias("item")).where("item is not null") for a, b in (("_new", "_old"), ("_old", "_new")))
    _append(spark, index, fresh, key, version, True)
    missing = update_keyed(spark, table, updates, key, items)
    _append(spark, index, gone, key, version, False)
    return missing


def keys_with_item(spark: SparkSession, index: str, key: str, wanted) -> DataFrame:
    """The keys of the sets that hold ``wanted``, from the index alone."""
    rows = spark.table(index).where(F.col("item") == F.lit(wanted))
    return rows.groupBy(key).agg(F.max_by("live", F.struct("version", F.col("live"))).alias("live")).where("live").select(key)


def rows_with_item(spark: SparkSession, table: str, index: str, key: str, items: str, wanted) -> DataFrame:
    """The table's rows whose set holds ``wanted``; other shares of the table are not read."""
    keys = store(keys_with_item(spark, index, key, wanted), "keys")
    return rows_of_keys(spark, table, keys, key).join(keys, key, "left_semi").where(F.array_contains(items, F.lit(wanted)))


def compact(spark: SparkSession, index: str, key: str) -> None:
    """Keep the last version of each pair, and no pair that is gone."""
    rows = spark.table(index).groupBy("item", key).agg(F.max("version").alias("version"), F.max_by("live", F.struct("version", F.col("live"))).alias("live")).where("live")
    kept = store(rows.select("item", key, "version", "live"), "compacted")
    kept.repartitionByRange("item", key).sortWithinPartitions("item", key).write.insertInto(index, overwrite=True)
