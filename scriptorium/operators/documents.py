"""Documents and pages: segments, links, existence, rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import html as H
from scriptorium.functions.text import SCENE_HEADERS, after_marker, segments, strip
from scriptorium.operators.dedupe import keep_first
from scriptorium.session import work_dir


def segment_rows(docs: DataFrame, key: str, text: str, headers: Sequence[str] = SCENE_HEADERS) -> DataFrame:
    """One row per segment: ``(key, ordinal, segment)``; ordinal 0 is the introduction."""
    return _numbered(docs.select(key, segments(F.col(text), headers).alias("parts")), "parts", "ordinal", "segment")


def _numbered(df: DataFrame, array: str, position: str, value: str) -> DataFrame:
    """One row per array entry.

    For an inner explode the optimizer adds a filter that works the array out a second time; the
    outer form followed by a filter on the position does not.
    """
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.posexplode_outer(array).alias(position, value)).where(F.col(position).isNotNull())


def segment_counts(docs: DataFrame, key: str, text: str, headers: Sequence[str] = SCENE_HEADERS) -> DataFrame:
    return docs.select(key, F.size(segments(F.col(text), headers)).cast("bigint").alias("n_segments"))


def html_to_text(pages: DataFrame, html: str, marker: str | None = "ALL SCRIPTS", out: str = "text") -> DataFrame:
    """Readable text of each page; everything up to ``marker`` is page furniture and goes."""
    text = H.strip_markup(F.col(html))
    if marker:
        text = after_marker(text, marker)
    return pages.select(*[c for c in pages.columns if c != html], strip(text).alias(out))


def link_rows(pages: DataFrame, key: str, html: str, base: str, within: str | None = None) -> DataFrame:
    """One row per link of a page's first list: ``(key, position, name, url)``."""
    read = pages.select(key, H.list_links(F.col(html), base, within).alias("links"))
    return _numbered(read, "links", "position", "link").select(
        key, "position", F.col("link")["name"].alias("name"), F.col("link")["url"].alias("url")
    )


def link_catalog(pages: DataFrame, snapshot: DataFrame, key: str, html: str, url: str, base: str, longer_than: int = 30,
                 within: str | None = None) -> DataFrame:
    """Per link name its first address, and the first long paragraph of the page stored for that address.

    ``first`` is by page key and position. ``snapshot`` has ``url`` and ``html``; a name whose address is not
    stored, or whose page has no long paragraph, gets null. Of several pages stored for an address the smallest paragraph counts.
    """
    named = keep_first(link_rows(pages, key, html, base, within), ["name"], [key, "position"]).select("name", F.col("url").alias("url"))
    paragraph = H.first_long_paragraph(F.col(html), longer_than, within)
    defined = snapshot.select(F.col(url).alias("url"), paragraph.alias("definition")).groupBy("url").agg(F.min("definition").alias("definition"))
    return named.join(defined, "url", "left").select("name", "url", "definition")


def page_existence(candidates: DataFrame, snapshot: DataFrame, key: str, html: str, missing_phrase: str,
                   out: str = "page_exists", within: str | None = None) -> DataFrame:
    """Three-valued check of ``key`` against stored pages.

    False when the page's first paragraph has the phrase, true for any other page, null when
    there is no page to judge by. Of several pages stored for a key one that exists is enough.
    """
    says_missing = F.coalesce(F.contains(H.first_paragraph(F.col(html), within), F.lit(missing_phrase)), F.lit(False))
    checked = snapshot.select(F.col(key), (~says_missing).alias(out)).groupBy(key).agg(F.max(out).alias(out))
    return candidates.join(checked, key, "left")


def route(df: DataFrame, kind: str, columns: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One projected output per kind. Each is its own filtered scan, with the filter pushed down."""
    return {value: df.where(F.col(kind) == value).select(*names) for value, names in columns.items()}


def route_stored(df: DataFrame, kind: str, columns: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The same outputs from one pass over ``df``, for rows that are costly to work out: they are written once, by kind, and each output reads its own part.

    Rows of other kinds are not written.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, "routed")
    wanted = list(dict.fromkeys([kind, *(c for names in columns.values() for c in names)]))
    rows = df.where(F.col(kind).isin(list(columns))).select(F.col(kind).cast("string").alias("_kind"), *wanted)
    rows.write.partitionBy("_kind").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)  # the kind stays a text, whatever it looks like
    return {value: stored.where(F.col("_kind") == F.lit(value).cast("string")).select(*names) for value, names in columns.items()}


def stage_by_kind(sources: dict[str, DataFrame], key: str, text: str) -> DataFrame:
    """One text per key out of several extractions; earlier kinds win.

    Each kind gives the keys that no earlier one has, so texts are not sorted. Within a kind a repeated key keeps the
    smallest text; null keys count as one key.
    """
    staged, seen = None, None
    for kind, df in sources.items():
        own = df.groupBy(key).agg(F.min(text).alias(text)).select(key, text, F.lit(kind).alias("kind"))
        if seen is not None:
            known = seen.select(F.col(key).alias("_seen"))
            own = own.join(known, own[key].eqNullSafe(known["_seen"]), "left_anti")
        staged = own if staged is None else staged.unionByName(own)
        keys = df.select(key).distinct()
        seen = keys if seen is None else seen.unionByName(keys)
    return staged


def with_reason(df: DataFrame, rules: dict[str, Column], ok: str = "ok") -> DataFrame:
    """Label each row with the first rule it breaks."""
    reason = F.lit(ok)
    for name, broken in reversed(rules.items()):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def reason_report(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("reason").agg(F.count("*").alias("n"))
