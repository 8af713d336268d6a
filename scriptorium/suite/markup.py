"""Queries on stored web pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import html as H
from scriptorium.operators import documents as D
from scriptorium.sources.tables import load
from scriptorium.suite import fragments as Q


def html_to_text(spark, d):
    return D.html_to_text(load(spark, d, "pages", "page_id", "html"), "html")


def extract_links(spark, d):
    return D.link_rows(load(spark, d, "pages"), "page_id", "html", Q.LINK_BASE)


def links_per_page(spark, d):
    links = H.list_links(F.col("html"), Q.LINK_BASE)
    return load(spark, d, "pages").select("page_id", F.size(links).cast("bigint").alias("n_links"))


def first_long_paragraph(spark, d):
    return load(spark, d, "pages").select("page_id", H.first_long_paragraph(F.col("html")).alias("paragraph"))


def link_catalog(spark, d):
    """Links point to pages of this site; a page is stored under the first word of its title, so some addresses have a page, others none."""
    pages = load(spark, d, "pages", "page_id", "html")
    word = F.regexp_extract("html", r"(?s)<title>([^\s<]+)", 1)
    snapshot = pages.select(F.concat(F.lit(f"{Q.LINK_BASE}/"), word).alias("url"), "html")
    return D.link_catalog(pages, snapshot, "page_id", "html", "url", Q.LINK_BASE)


def extract_links_within(spark, d):
    """Only a list standing directly in the content element counts, not one in a box inside it."""
    wrapped = F.concat(F.lit('<div id="other"><ul><li><a href="/no">no</a></li></ul></div><div id="content"><div class="toc"><ul><li><a href="#x">x</a></li></ul></div>'),
                       F.regexp_replace("html", "(?is)</?(nav|div|article|main|section|footer|header|aside)\\b[^>]*>", ""), F.lit("</div><ul><li><a href='/late'>late</a></li></ul>"))
    return D.link_rows(load(spark, d, "pages").select("page_id", wrapped.alias("html")), "page_id", "html", Q.LINK_BASE, "content")


def _bare(html):
    """The same page as careless hands write it: bare values, end signs and apostrophes in attributes, references and elements left open."""
    html = F.regexp_replace(html, """href="([^"\\s>]*)\"""", "title='x > y' data-href=/no href=$1")
    html = F.regexp_replace(html, "<p>", "<p title=don't lang = \"a > b\">")
    return F.concat(html, F.lit("<p>tail &copy &nbspend</p><script>var open = '<ul><li><a href=/no>no</a>"))


def html_to_text_bare(spark, d):
    return D.html_to_text(load(spark, d, "pages", "page_id", "html").withColumn("html", _bare(F.col("html"))), "html")


def extract_links_bare(spark, d):
    return D.link_rows(load(spark, d, "pages", "page_id", "html").withColumn("html", _bare(F.col("html"))), "page_id", "html", Q.LINK_BASE)


def paragraphs_bare(spark, d):
    """All paragraphs of a page, joined."""
    return load(spark, d, "pages").select("page_id", F.array_join(H.paragraphs(_bare(F.col("html"))), "|").alias("paragraphs"))


QUERIES = {f.__name__: f for f in (html_to_text, extract_links, links_per_page, first_long_paragraph, link_catalog, extract_links_within, html_to_text_bare, extract_links_bare,
                                   paragraphs_bare)}

SQL = {
    "html_to_text": f"SELECT page_id, {Q.strip(Q.strip_markup('html'))} AS text FROM pages",
    "extract_links": f"WITH {Q.LINKS} SELECT page_id, position, name, url FROM links",
    "links_per_page": f"""
WITH {Q.LINKS} SELECT p.page_id, count(l.page_id) AS n_links FROM pages p LEFT JOIN links l ON p.page_id = l.page_id GROUP BY 1""",
    "first_long_paragraph": f"SELECT page_id, {Q.first_long_paragraph('html')} AS paragraph FROM pages",
    "link_catalog": rf"""
WITH {Q.LINKS},
  firsts AS (SELECT * FROM links QUALIFY row_number() OVER (PARTITION BY name ORDER BY page_id, position) = 1),
  snapshot AS (SELECT '{Q.LINK_BASE}/' || regexp_extract(html, '(?s)<title>([^\s<]+)', 1) AS url, min({Q.first_long_paragraph('html')}) AS definition
               FROM pages GROUP BY 1)
SELECT name, f.url AS url, definition FROM firsts f LEFT JOIN snapshot s ON f.url = s.url""",
    "html_to_text_bare": f"SELECT page_id, {Q.strip(Q.strip_markup('html') + " || 'tail © ' || chr(160) || 'end'")} AS text FROM pages",
    "extract_links_bare": f"WITH {Q.LINKS} SELECT page_id, position, name, url FROM links",
    "paragraphs_bare": f"SELECT page_id, array_to_string(list_append({Q.paragraphs('html')}, 'tail © ' || chr(160) || 'end'), '|') AS paragraphs FROM pages",
    "extract_links_within": f"WITH {Q.LINKS} SELECT page_id, position, name, url FROM links",
}
