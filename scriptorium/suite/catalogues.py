"""Queries on catalogues: merging, matching, deduplicating, updating."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from scriptorium.operators import dedupe as P
from scriptorium.operators import documents as D
from scriptorium.operators import merge as M
from scriptorium.plans import catalogue as C
from scriptorium.plans import staging as G
from scriptorium.session import store
from scriptorium.sources.tables import MOVIES, create_if_absent, load
from scriptorium.suite import fragments as Q

PRIORITY = ("en", "fr", "de", "es")
WIKI = "https://wiki.example.org/"
PHRASE = "the"


def outer_merge_indicator(spark, d):
    return M.outer_merge(load(spark, d, "labels", "doc_id"), load(spark, d, "pages", "page_id"), "doc_id", "page_id")


def outer_merge_orders(spark, d):
    return M.outer_merge(load(spark, d, "orders", "o_custkey", "o_orderkey"), load(spark, d, "customer", "c_custkey", "c_name"),
                         "o_custkey", "c_custkey")


def prioritized_merge(spark, d):
    first = load(spark, d, "pages").select(F.col("page_id").alias("key"), F.col("url").alias("value"))
    second = load(spark, d, "labels").select(F.col("doc_id").alias("key"), F.concat(F.lit("label"), "quality").alias("value"))
    return M.prioritized_merge(first, second, "key", "value")


def _catalogue(spark, d):
    first = load(spark, d, "supplier").select(
        F.regexp_replace("s_name", "Supplier#", "entry-").alias("name"), F.concat(F.lit("/s/"), "s_suppkey").alias("url"))
    second = load(spark, d, "customer").select(
        F.regexp_replace("c_name", "Customer#", "Entry: ").alias("name"), F.concat(F.lit("/c/"), "c_custkey").alias("url"))
    return C.merged_catalogue(first, second, WIKI)


def merged_catalogue(spark, d):
    return _catalogue(spark, d)


def ingest_lists(spark, d):
    key = F.concat(F.lit(f"{WIKI}Entry_"), F.lpad(F.col("page_id").cast("string"), 9, "0"))
    snapshot = load(spark, d, "pages").select(key.alias("url_wiki"), "html")
    checked = store(C.checked_catalogue(_catalogue(spark, d), snapshot, PHRASE), "checked")
    scripts, wiki = C.ingest_lists(checked)
    return scripts.select("title", F.lit("scripts").alias("list"), F.col("url").alias("target")).unionByName(
        wiki.select("title", F.lit("wiki").alias("list"), F.col("url_wiki").alias("target")))


def page_existence(spark, d):
    docs = load(spark, d, "documents").select(F.col("doc_id").alias("page_id"))
    return D.page_existence(docs, load(spark, d, "pages", "page_id", "html"), "page_id", "html", PHRASE)


def page_existence_within(spark, d):
    """Paragraphs before, behind and in a box of the content element say nothing about the page."""
    docs = load(spark, d, "documents").select(F.col("doc_id").alias("page_id"))
    own = F.regexp_replace("html", r"(?i)</?(nav|div|article|main|section|aside)\b[^>]*>", "")
    wrapped = F.concat(F.lit(f'<p>{PHRASE}</p><div id="content"><div><p>{PHRASE} box</p></div>'), own, F.lit(f"</div><p>{PHRASE} footer</p>"))
    pages = load(spark, d, "pages").select("page_id", wrapped.alias("html"))
    return D.page_existence(docs, pages, "page_id", "html", PHRASE, within="content")


def untitled_rows(spark, d):
    """Every tenth name is missing; the merge leaves those rows out and the report has them."""
    spoiled = lambda table, key, name: load(spark, d, table).select(
        F.when(F.col(key) % 10 != 0, F.col(name)).alias("name"), F.concat(F.lit("/"), F.col(key).cast("string")).alias("url"))
    first, second = spoiled("supplier", "s_suppkey", "s_name"), spoiled("customer", "c_custkey", "c_name")
    merged = C.merged_catalogue(first, second, WIKI).select("url", F.lit("merged").alias("source"))
    return merged.unionByName(C.untitled(first=first, second=second).select("url", "source"))


def stored_movies(spark, d):
    """Movie rows in a table that is created once however often it is asked for."""
    table = f"movies_{uuid.uuid4().hex}"
    made = [create_if_absent(spark, table, MOVIES) for _ in range(2)]
    scripts = load(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), "text")
    G.movies(scripts, Q.HEADERS).write.insertInto(table)
    rows = store(spark.table(table).select("name", F.char_length("full_script").cast("bigint").alias("n_chars"), F.size("scenes").cast("bigint").alias("n_scenes"),
                                           F.lit(made == [True, False]).alias("created_once")), "read")
    spark.sql(f"DROP TABLE {table}")
    return rows


def semi_labeled_docs(spark, d):
    return M.keep_matching(load(spark, d, "documents", "doc_id", "lang"), load(spark, d, "labels", "doc_id"), "doc_id")


def anti_unlabeled_docs(spark, d):
    return M.keep_unmatched(load(spark, d, "documents", "doc_id", "lang"), load(spark, d, "labels", "doc_id"), "doc_id")


def keyed_upsert(spark, d):
    target = load(spark, d, "documents").select("doc_id", "lang", F.lit(None).cast("int").alias("quality"))
    return M.keyed_update(target, load(spark, d, "labels", "doc_id", "quality"), "doc_id", "quality")


def upsert_unmatched(spark, d):
    pages = load(spark, d, "pages").select(F.col("page_id").alias("doc_id"))
    return M.unmatched_updates(pages, load(spark, d, "labels", "doc_id", "quality"), "doc_id")


def append_new_keys(spark, d):
    stored = load(spark, d, "labels").select("doc_id", F.lit("stored").alias("origin"))
    incoming = load(spark, d, "documents").select("doc_id", F.col("source").alias("origin"))
    return stored.unionByName(M.append_new_keys(stored, incoming, "doc_id"))


def dropna_subset(spark, d):
    return outer_merge_orders(spark, d).dropna(subset=["c_custkey", "o_orderkey"])


def _copies(spark, d):
    return load(spark, d, "documents").select(F.sha2(F.lower("text"), 256).alias("fingerprint"), "doc_id", "source")


def dedupe_first(spark, d):
    return P.keep_first(_copies(spark, d), ["fingerprint"], ["doc_id"])


def dedupe_last(spark, d):
    return P.keep_last(_copies(spark, d), ["fingerprint"], ["doc_id"])


def priority_dedupe(spark, d):
    docs = load(spark, d, "documents").select(F.sha2(F.lower("text"), 256).alias("fingerprint"), "doc_id", "source", "lang")
    return P.by_priority(docs, ["fingerprint"], "source", [f"src{i}" for i in (3, 1, 2)], ["doc_id"])


def staged_scripts(spark, d):
    html = load(spark, d, "pages").select(F.col("page_id").alias("name"), "html")
    pdf = load(spark, d, "conversations").select(F.col("conv_id").alias("name"), F.col("turn").alias("page"), "text")
    return G.staged_scripts(html, pdf, marker="the")


def movie_rows(spark, d):
    scripts = load(spark, d, "documents").select(F.col("doc_id").alias("name"), "text")
    rows = G.movies(scripts, Q.HEADERS)
    return rows.select("name", F.char_length("full_script").cast("bigint").alias("n_chars"),
                       F.size("scenes").cast("bigint").alias("n_scenes"), F.array_join("scenes", "|").alias("scenes"),
                       F.array_join("tropes", ",").alias("tropes"))


def route_by_kind(spark, d):
    docs = load(spark, d, "documents")
    routes = D.route(docs, "lang", {lang: ["doc_id", "source"] for lang in PRIORITY})
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn("route", F.lit(r)) for r, df in routes.items()])


def route_by_kind_once(spark, d):
    """The same from one pass over the table."""
    docs = load(spark, d, "documents")
    routes = D.route_stored(docs, "lang", {lang: ["doc_id", "source"] for lang in PRIORITY})
    return reduce(lambda a, b: a.unionByName(b), [df.withColumn("route", F.lit(r)) for r, df in routes.items()])


def union_all_catalogs(spark, d):
    c = load(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.lit("customer").alias("origin"))
    s = load(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("origin"))
    return c.unionByName(s).groupBy("nation", "origin").agg(F.count("*").alias("n"))


def rename_pattern(spark, d):
    return M.rename_columns(load(spark, d, "nation"), "n_", "nation_")


def lookup_default(spark, d):
    events = load(spark, d, "events", "event_id", "user_id")
    return M.lookup(events, load(spark, d, "customer", "c_custkey", "c_name"), "user_id", "c_custkey", "c_name",
                    "No definition available.", "name")


def _judged(spark, d):
    labels = load(spark, d, "labels").select("doc_id", F.lit(True).alias("known"))
    docs = load(spark, d, "documents", "doc_id", "n_chars").join(labels, "doc_id", "left")
    return D.with_reason(docs, {"too_short": F.col("n_chars") < 50, "unlabelled": F.col("known").isNull()})


def quarantine_rows(spark, d):
    return _judged(spark, d).select("doc_id", "reason")


def quarantine_report(spark, d):
    return D.reason_report(_judged(spark, d))


QUERIES = {f.__name__: f for f in (
    outer_merge_indicator, outer_merge_orders, prioritized_merge, merged_catalogue, ingest_lists, page_existence,
    page_existence_within, untitled_rows, stored_movies, semi_labeled_docs, anti_unlabeled_docs, keyed_upsert, upsert_unmatched, append_new_keys, dropna_subset,
    dedupe_first, dedupe_last, priority_dedupe, staged_scripts, movie_rows, route_by_kind, route_by_kind_once, union_all_catalogs,
    rename_pattern, lookup_default, quarantine_rows, quarantine_report)}

_CATALOGUE = f"""
  a AS (SELECT {Q.normalize("replace(s_name, 'Supplier#', 'entry-')")} AS t1, '/s/' || s_suppkey AS u1 FROM supplier),
  b AS (SELECT {Q.normalize("replace(c_name, 'Customer#', 'Entry: ')")} AS t2, '/c/' || c_custkey AS u2 FROM customer),
  m AS (SELECT coalesce(t1, t2) AS title, CASE WHEN t1 IS NOT NULL THEN u1 ELSE u2 END AS url,
               CASE WHEN t1 IS NOT NULL THEN 'pdf' ELSE 'html' END AS url_extension FROM a FULL JOIN b ON t1 = t2),
  catalogue AS (SELECT *, replace(lower(title), ' ', '_') || '.' || url_extension AS filename,
                       replace(replace(trim(title), ' ', '_'), ':', '') AS wiki_name,
                       '{WIKI}' || replace(replace(trim(title), ' ', '_'), ':', '') AS url_wiki FROM m)"""
_EXISTS = f"NOT coalesce(contains({Q.paragraphs('html')}[1], '{PHRASE}'), false)"
_COPIES = "SELECT sha256(lower(text)) AS fingerprint, doc_id, source FROM documents"

SQL = {
    "outer_merge_indicator": """
SELECT doc_id, page_id, CASE WHEN page_id IS NULL THEN 'left_only' WHEN doc_id IS NULL THEN 'right_only' ELSE 'both' END AS indicator
FROM labels FULL JOIN pages ON doc_id = page_id""",
    "outer_merge_orders": """
SELECT c_custkey, c_name, o_custkey, o_orderkey,
       CASE WHEN c_custkey IS NULL THEN 'left_only' WHEN o_custkey IS NULL THEN 'right_only' ELSE 'both' END AS indicator
FROM customer FULL JOIN orders ON c_custkey = o_custkey""",
    "prioritized_merge": """
SELECT coalesce(page_id, doc_id) AS key, CASE WHEN page_id IS NOT NULL THEN url ELSE 'label' || quality END AS value,
       CASE WHEN page_id IS NOT NULL THEN 'pdf' ELSE 'html' END AS kind
FROM pages FULL JOIN labels ON page_id = doc_id""",
    "merged_catalogue": f"WITH {_CATALOGUE} SELECT * FROM catalogue",
    "ingest_lists": f"""
WITH {_CATALOGUE},
  snapshot AS (SELECT '{WIKI}Entry_' || lpad(page_id::varchar, 9, '0') AS url_wiki, {_EXISTS} AS page_exists FROM pages),
  kept AS (SELECT * FROM catalogue JOIN snapshot USING (url_wiki) WHERE page_exists)
SELECT title, 'scripts' AS list, url AS target FROM kept UNION ALL SELECT title, 'wiki', url_wiki FROM kept""",
    "page_existence": f"""
SELECT doc_id AS page_id, CASE WHEN html IS NOT NULL THEN {_EXISTS} END AS page_exists FROM documents LEFT JOIN pages ON doc_id = page_id""",
    "page_existence_within": f"""
SELECT doc_id AS page_id, CASE WHEN html IS NOT NULL THEN {_EXISTS} END AS page_exists FROM documents LEFT JOIN pages ON doc_id = page_id""",
    "untitled_rows": """
WITH c AS (SELECT '/' || s_suppkey AS url, s_suppkey % 10 = 0 AS bad, 'first' AS source FROM supplier
           UNION ALL SELECT '/' || c_custkey, c_custkey % 10 = 0, 'second' FROM customer)
SELECT url, CASE WHEN bad THEN source ELSE 'merged' END AS source FROM c""",
    "stored_movies": f"""
SELECT doc_id::varchar AS name, length(text)::bigint AS n_chars, len({Q.segments('text')})::bigint AS n_scenes, true AS created_once FROM documents""",
    "semi_labeled_docs": "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "anti_unlabeled_docs": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "keyed_upsert": "SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "upsert_unmatched": "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)",
    "append_new_keys": """
SELECT doc_id, 'stored' AS origin FROM labels
UNION ALL SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "dropna_subset": """
SELECT c_custkey, c_name, o_custkey, o_orderkey, 'both' AS indicator FROM customer JOIN orders ON c_custkey = o_custkey""",
    "dedupe_first": f"SELECT fingerprint, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM ({_COPIES}) GROUP BY 1",
    "dedupe_last": f"SELECT fingerprint, max(doc_id) AS doc_id, arg_max(source, doc_id) AS source FROM ({_COPIES}) GROUP BY 1",
    "priority_dedupe": """
SELECT fingerprint, doc_id, source, lang FROM (
  SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY CASE source WHEN 'src3' THEN 1 WHEN 'src1' THEN 2 WHEN 'src2' THEN 3 ELSE 4 END, doc_id) AS r
  FROM (SELECT sha256(lower(text)) AS fingerprint, doc_id, source, lang FROM documents)) WHERE r = 1""",
    "staged_scripts": f"""
WITH pdf AS (SELECT conv_id AS name, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text, 'pdf' AS kind FROM conversations GROUP BY 1),
  raw AS (SELECT page_id AS name, {Q.strip_markup('html')} AS t FROM pages),
  html AS (SELECT name, CASE WHEN position('the' IN t) > 0 THEN substring(t, position('the' IN t) + 3) ELSE t END AS t FROM raw)
SELECT * FROM pdf UNION ALL SELECT name, {Q.strip('t')}, 'html' FROM html WHERE name NOT IN (SELECT name FROM pdf)""",
    "movie_rows": f"""
SELECT doc_id AS name, length(text)::bigint AS n_chars, len(s)::bigint AS n_scenes, array_to_string(s, '|') AS scenes, NULL::varchar AS tropes
FROM (SELECT doc_id, text, {Q.segments('text')} AS s FROM documents)""",
    "route_by_kind": "SELECT doc_id, source, lang AS route FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')",
    "route_by_kind_once": "SELECT doc_id, source, lang AS route FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')",
    "union_all_catalogs": """
SELECT nation, origin, count(*) AS n FROM (SELECT c_nationkey AS nation, 'customer' AS origin FROM customer
  UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) GROUP BY ALL""",
    "rename_pattern": "SELECT n_nationkey AS nation_nationkey, n_name AS nation_name, n_regionkey AS nation_regionkey FROM nation",
    "lookup_default": """
SELECT event_id, user_id, coalesce(c_name, 'No definition available.') AS name FROM events LEFT JOIN customer ON user_id = c_custkey""",
    "quarantine_rows": """
SELECT d.doc_id, CASE WHEN n_chars < 50 THEN 'too_short' WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'ok' END AS reason
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "quarantine_report": """
SELECT CASE WHEN n_chars < 50 THEN 'too_short' WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'ok' END AS reason, count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
}
