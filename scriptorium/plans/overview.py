"""What the corpus holds: figures, frequent concepts, one document, documents by concept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import clean_items, preview, sort_items_ci, word_count
from scriptorium.operators.similarity import most_similar_to
from scriptorium.operators.stats import corpus_stats, explode_items, find_by_item, top_items


def figures(movies: DataFrame) -> DataFrame:
    return corpus_stats(movies, "name", "full_script")


def frequent_tropes(movies: DataFrame, k: int = 10) -> DataFrame:
    cleaned = movies.select("name", clean_items(F.col("tropes")).alias("tropes"))
    return top_items(explode_items(cleaned, "name", "tropes"), "item", k)


def movie_card(movies: DataFrame, name: str) -> DataFrame:
    """One movie: words, script preview, sorted concepts; raises if ``name`` is not there."""
    found = movies.where(F.col("name") == F.lit(name)).limit(1)
    if found.isEmpty():
        raise ValueError(f"no movie named {name!r}")
    return found.select("name", word_count(F.col("full_script")).alias("words"),
                        preview(F.col("full_script")).alias("preview"),
                        sort_items_ci(clean_items(F.col("tropes"))).alias("tropes"))


def similar_movie(movies: DataFrame, name: str) -> DataFrame:
    """Most similar other movie; raises if ``name`` is not there."""
    return most_similar_to(explode_items(movies, "name", "tropes"), "name", "item", name, movies.select("name"))


def movies_with_trope(movies: DataFrame, trope: str) -> DataFrame:
    return find_by_item(movies, "tropes", trope).select("name")
