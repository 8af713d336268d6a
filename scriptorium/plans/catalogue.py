"""From two scraped catalogues to the lists of scripts and wiki pages to take in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import file_name, normalize_title, wiki_key, wiki_url
from scriptorium.operators.documents import page_existence
from scriptorium.operators.merge import prioritized_merge


def merged_catalogue(first: DataFrame, second: DataFrame, wiki_base: str, *, name: str = "name",
                     url: str = "url", first_kind: str = "pdf", second_kind: str = "html") -> DataFrame:
    """Normalise, merge by title with the first source ahead, add file name and wiki address.

    Rows without a title are set aside (``untitled``): they would all match each other.
    """
    sides = [df.where(F.col(name).isNotNull()).select(normalize_title(F.col(name)).alias("title"), F.col(url).alias("url")) for df in (first, second)]
    merged = prioritized_merge(*sides, "title", "url", first_kind, second_kind, "url_extension")
    return merged.select(
        "title", "url", "url_extension",
        file_name(F.col("title"), F.col("url_extension")).alias("filename"),
        wiki_key(F.col("title")).alias("wiki_name"),
        wiki_url(F.col("title"), wiki_base).alias("url_wiki"),
    )


def untitled(name: str = "name", **sources: DataFrame) -> DataFrame:
    """The rows that ``merged_catalogue`` leaves out, with the source's name as ``source``."""
    parts = [df.where(F.col(name).isNull()).withColumn("source", F.lit(source)) for source, df in sources.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def checked_catalogue(catalogue: DataFrame, snapshot: DataFrame, missing_phrase: str, html: str = "html") -> DataFrame:
    """Add ``page_exists`` (true, false, or null where no page was stored) by ``url_wiki``."""
    return page_existence(catalogue, snapshot, "url_wiki", html, missing_phrase)


def ingest_lists(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with a page, as the script list and as the wiki list.

    Both read ``checked``, so it should be a stored table.
    """
    kept = checked.where(F.col("page_exists"))
    return (kept.select("title", "url", "url_extension", "filename"),
            kept.select("title", "filename", "url_wiki", "page_exists"))
