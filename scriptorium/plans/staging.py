"""From stored pages and page texts to documents with scenes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import SCENE_HEADERS, segments
from scriptorium.operators.documents import html_to_text, stage_by_kind
from scriptorium.operators.stats import assemble_text


def staged_scripts(html_pages: DataFrame, pdf_pages: DataFrame | None = None, *, marker: str = "ALL SCRIPTS") -> DataFrame:
    """``(name, text, kind)``, one row per name; a PDF's text is taken ahead of a page's.

    ``html_pages`` is ``(name, html)``; ``pdf_pages`` is ``(name, page, text)``, text already
    extracted per page.
    """
    sources = {}
    if pdf_pages is not None:
        sources["pdf"] = assemble_text(pdf_pages, "name", "page", "text").select("name", "text")
    sources["html"] = html_to_text(html_pages, "html", marker).select("name", "text")
    return stage_by_kind(sources, "name", "text")


def movies(scripts: DataFrame, headers: Sequence[str] = SCENE_HEADERS) -> DataFrame:
    """Movie rows with scenes cut and tropes not filled in yet."""
    return scripts.select(
        "name", F.col("text").alias("full_script"), segments(F.col("text"), headers).alias("scenes"),
        F.lit(None).cast("array<string>").alias("tropes"), F.lit(None).cast("string").alias("global_analysis"))
