"""Corpus statistics and item counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.text import word_count


def corpus_stats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row: number of texts, words in all, mean (cut to an integer), longest text.

    Texts without a name are skipped. The longest text is null when no text has a word; among equals the smallest key wins.
    """
    named = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    counted = docs.where(named).select(F.col(key).alias("k"), word_count(F.col(text)).alias("wc"))
    longest = F.min(F.struct((-F.col("wc")).alias("neg"), F.col("k")))
    total = F.coalesce(F.sum("wc"), F.lit(0))
    return counted.agg(
        F.count("*").alias("scripts"),
        total.alias("total_words"),
        F.when(F.count("*") > 0, F.floor(total / F.count("*"))).otherwise(F.lit(0)).cast("bigint").alias("avg_words"),
        F.coalesce(F.max("wc"), F.lit(0)).alias("max_words"),
        longest.alias("_longest"),
    ).select(
        "scripts", "total_words", "avg_words", "max_words",
        F.when(F.col("max_words") > 0, F.col("_longest")["k"]).alias("longest"),
    )


def explode_items(df: DataFrame, key: str, items: str, out: str = "item") -> DataFrame:
    return df.select(key, F.explode(items).alias(out))


def item_frequency(items: DataFrame, item: str) -> DataFrame:
    return items.groupBy(item).agg(F.count("*").alias("n"))


def top_items(items: DataFrame, item: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent items with their rank; equal counts in item order.

    The rank is numbered after the limit, so the unpartitioned window sees ``k`` rows.
    """
    order = [F.desc("n"), F.asc(item)]
    best = item_frequency(items, item).orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def distinct_items(df: DataFrame, column: str, nested: bool = False) -> DataFrame:
    """Sorted distinct non-empty values, of an array's entries if ``nested``."""
    value = F.explode_outer(column) if nested else F.col(column)
    values = df.select(value.alias("item")).distinct()
    return values.where(F.col("item").isNotNull() & (F.col("item") != "")).orderBy("item")


def set_union(df: DataFrame, key: str, item: str, out: str = "items") -> DataFrame:
    """Sorted set of all items per key.

    Each task sends a key's distinct items on, so a key with very many rows costs the shuffle no
    more than its set.
    """
    return df.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias(out))


def find_by_item(sets: DataFrame, items: str, wanted: str) -> DataFrame:
    """Rows whose set holds ``wanted``."""
    return sets.where(F.array_contains(F.col(items), F.lit(wanted)))


def sort_ci(df: DataFrame, column: str, *then: str) -> DataFrame:
    """Sort by lower case, then by the value itself, then by ``then``.

    A value that very many rows have can only be spread over several sort partitions if ``then``
    tells those rows apart.
    """
    return df.orderBy(F.lower(F.col(column)), F.col(column), *then)


def assemble_text(pages: DataFrame, key: str, position: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Join the page texts of each document in page order; a failed (null) page counts as empty."""
    page = F.struct(F.col(position).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    ordered = F.array_sort(F.collect_list(page))
    joined = F.array_join(F.transform(ordered, lambda x: x["t"]), separator)
    return pages.groupBy(key).agg(joined.alias(text), F.count("*").alias("n_pages"))
