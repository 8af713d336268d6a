"""Text queries: counts, names, lists, segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as X
from scriptorium.functions.html import list_links, strip_markup
from scriptorium.functions.prompts import build_prompt, parse_response
from scriptorium.operators import documents as D
from scriptorium.operators import stats as S
from scriptorium.plans import overview
from scriptorium.sources.tables import load
from scriptorium.suite import fragments as Q

MENTIONS = ("the", "and", "inth", "quevi", "ción", "aufge")


def corpus_stats(spark, d):
    return S.corpus_stats(load(spark, d, "documents", "doc_id", "text"), "doc_id", "text")


def word_count(spark, d):
    return load(spark, d, "documents").select("doc_id", X.word_count(F.col("text")).alias("words"))


def normalize_names(spark, d):
    names = (load(spark, d, "documents").select(F.explode_outer(F.split("text", "\n")).alias("name"))
             .unionByName(load(spark, d, "part").select(F.col("p_name").alias("name")))
             .unionByName(load(spark, d, "customer").select(F.col("c_mktsegment").alias("name"))))
    return names.distinct().select("name", X.normalize_title(F.col("name")).alias("title"))


def make_filename(spark, d):
    title = X.normalize_title(F.col("p_name"))
    return load(spark, d, "part").select("p_partkey", X.file_name(title, F.lower("p_type")).alias("filename"))


def make_url_key(spark, d):
    title = F.concat(F.col("p_type"), F.lit(": 100% "), F.col("p_name"))
    return load(spark, d, "part").select(
        "p_partkey", X.wiki_key(title).alias("wiki_name"), X.wiki_url(title, "https://wiki.example.org/").alias("url_wiki"),
        X.script_url(title, "https://scripts.example.org/").alias("url_script"))


def url_basename(spark, d):
    path = F.regexp_replace("url", "[?#].*$", "")
    return load(spark, d, "pages").select("page_id", X.base_name(path).alias("name"))


def doc_preview(spark, d):
    return load(spark, d, "documents").select("doc_id", X.preview(F.col("text")).alias("preview"))


def parse_items(spark, d):
    items = X.parse_items(F.col("text"))
    return load(spark, d, "documents").select("doc_id", F.size(items).cast("bigint").alias("n_items"),
                                              F.array_join(items, "|").alias("items"))


def items_joined(spark, d):
    return load(spark, d, "documents").select("doc_id", F.array_join(X.words(F.col("text")), "-").alias("joined"))


def marker_cut(spark, d):
    return load(spark, d, "documents").select("doc_id", X.after_marker(F.col("text"), " the ").alias("rest"))


def mention_score(spark, d):
    wanted = F.array(*[F.lit(w) for w in MENTIONS])
    return load(spark, d, "documents").select("doc_id", X.mention_count(F.col("text"), wanted).alias("score"))


def segment_scenes(spark, d):
    return D.segment_rows(load(spark, d, "documents"), "doc_id", "text", Q.HEADERS)


def segment_count(spark, d):
    return D.segment_counts(load(spark, d, "documents"), "doc_id", "text", Q.HEADERS)


def assemble_pages(spark, d):
    return S.assemble_text(load(spark, d, "conversations"), "conv_id", "turn", "text")


def sort_ci(spark, d):
    return S.sort_ci(load(spark, d, "documents").select("doc_id", "source"), "source", "doc_id")


def sort_items_ci(spark, d):
    items = X.sort_items_ci(F.array_distinct(X.words(F.col("text"))))
    return load(spark, d, "documents").select("doc_id", F.array_join(items, " ").alias("sorted_items"))


def build_prompts(spark, d):
    names = F.transform(list_links(F.col("html"), Q.LINK_BASE), lambda x: x["name"])
    read = load(spark, d, "pages").select("page_id", X.strip(strip_markup(F.col("html"))).alias("text"), names.alias("names"))
    prompt = build_prompt(F.col("text"), F.col("names"), task="Check the tags.", rules="Answer as JSON.")
    return read.select("page_id", prompt.alias("prompt"))


def movie_card(spark, d):
    """The card of one document, by name."""
    docs = load(spark, d, "documents").select(F.concat(F.lit("doc "), "doc_id").alias("name"), F.col("text").alias("full_script"), F.array("lang", "source", F.lit(" ")).alias("tropes"))
    return overview.movie_card(docs, "doc 3").select("name", "words", "preview", F.array_join("tropes", ",").alias("tropes"))


def similar_movie(spark, d):
    """The document with the most similar set of words."""
    docs = load(spark, d, "documents").select(F.col("doc_id").alias("name"), F.array_distinct(X.words(F.col("text"))).alias("tropes"))
    return overview.similar_movie(docs, 3).select("name", F.round("score", 9).alias("score"))


def parse_responses(spark, d):
    """Answers as a checking model gives them, written from the documents' own words."""
    words = F.array_distinct(X.words(F.col("text")))
    answer = F.to_json(F.struct(words.alias("tropes"), F.array(F.col("source")).alias("examples")))
    docs = load(spark, d, "documents").select("doc_id", F.when(F.col("lang") == "en", answer).otherwise("").alias("answer"))
    parsed = docs.withColumn("p", parse_response(F.col("answer")))
    return parsed.select("doc_id", F.size("p.tropes").cast("bigint").alias("n_tropes"), F.array_join("p.examples", ",").alias("examples"))


QUERIES = {f.__name__: f for f in (
    corpus_stats, word_count, normalize_names, make_filename, make_url_key, url_basename, doc_preview, parse_items,
    items_joined, marker_cut, mention_score, segment_scenes, segment_count, assemble_pages, sort_ci, sort_items_ci,
    build_prompts, parse_responses, movie_card, similar_movie)}

_TITLE = "p_type || ': 100% ' || p_name"
_KEY = f"replace(replace({Q.strip(_TITLE)}, ' ', '_'), ':', '')"

SQL = {
    "movie_card": f"""
SELECT 'doc ' || doc_id AS name, len({Q.words('text')})::bigint AS words, text[1:2000] AS preview, array_to_string(list_sort([lang, source]), ',') AS tropes
FROM documents WHERE doc_id = 3""",
    "similar_movie": f"""
WITH m AS (SELECT DISTINCT doc_id AS k, unnest({Q.words('text')}) AS i FROM documents), r AS (SELECT i FROM m WHERE k = 3), c AS (SELECT count(*) AS n FROM r),
  s AS (SELECT k, count(r.i) / (count(*) + any_value(c.n) - count(r.i)) AS score FROM m LEFT JOIN r ON m.i = r.i, c WHERE k <> 3 GROUP BY k)
SELECT k AS name, round(score, 9) AS score FROM s ORDER BY s.score DESC, k LIMIT 1""",
    "corpus_stats": f"""
WITH w AS (SELECT doc_id, len({Q.words('text')})::bigint AS wc FROM documents)
SELECT count(*) AS scripts, sum(wc)::bigint AS total_words, floor(sum(wc) / count(*))::bigint AS avg_words,
       max(wc) AS max_words, (SELECT doc_id FROM w ORDER BY wc DESC, doc_id LIMIT 1) AS longest FROM w""",
    "word_count": f"SELECT doc_id, len({Q.words('text')})::bigint AS words FROM documents",
    "normalize_names": f"""
WITH n AS (SELECT unnest(string_split(text, chr(10))) AS name FROM documents UNION SELECT p_name FROM part UNION SELECT c_mktsegment FROM customer)
SELECT name, {Q.normalize('name')} AS title FROM n""",
    "make_filename": f"SELECT p_partkey, replace(lower({Q.normalize('p_name')}), ' ', '_') || '.' || lower(p_type) AS filename FROM part",
    "make_url_key": f"""
SELECT p_partkey, {_KEY} AS wiki_name, 'https://wiki.example.org/' || {_KEY} AS url_wiki,
       'https://scripts.example.org/' || replace(replace(replace({_TITLE}, ': ', '-'), '%', '%2526'), ' ', '-') || '.html' AS url_script
FROM part""",
    "url_basename": r"""
WITH n AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '^.*/', '') AS name FROM pages)
SELECT page_id, regexp_replace(name, '^(.*[^.])\.[^.]*$', '\1') AS name FROM n""",
    "doc_preview": "SELECT doc_id, substring(text, 1, 2000) AS preview FROM documents",
    "parse_items": f"""
WITH i AS (SELECT doc_id, list_filter(list_transform(string_split(text, ','), lambda x: {Q.strip('x')}), lambda x: x <> '') AS items FROM documents)
SELECT doc_id, len(items)::bigint AS n_items, array_to_string(items, '|') AS items FROM i""",
    "items_joined": f"SELECT doc_id, array_to_string({Q.words('text')}, '-') AS joined FROM documents",
    "marker_cut": """
SELECT doc_id, CASE WHEN position(' the ' IN text) > 0 THEN substring(text, position(' the ' IN text) + 5) ELSE text END AS rest FROM documents""",
    "mention_score": f"""
SELECT doc_id, len(list_filter([{', '.join(f"'{w}'" for w in MENTIONS)}], lambda w: contains(text, w)))::double AS score FROM documents""",
    "segment_scenes": f"""
SELECT doc_id, (generate_subscripts(s, 1) - 1)::int AS ordinal, unnest(s) AS segment
FROM (SELECT doc_id, {Q.segments('text')} AS s FROM documents)""",
    "segment_count": f"SELECT doc_id, len({Q.segments('text')})::bigint AS n_segments FROM documents",
    "assemble_pages": """
SELECT conv_id, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text, count(*) AS n_pages FROM conversations GROUP BY conv_id""",
    "sort_ci": "SELECT doc_id, source FROM documents ORDER BY lower(source), source, doc_id",
    "sort_items_ci": f"""
WITH w AS (SELECT doc_id, list_distinct({Q.words('text')}) AS ws FROM documents)
SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(ws, lambda x: lower(x) || chr(1) || x)), lambda y: string_split(y, chr(1))[2]), ' ') AS sorted_items FROM w""",
    "build_prompts": f"""
WITH {Q.LINKS},
  names AS (SELECT page_id, string_agg(name, ', ' ORDER BY position) AS listed FROM links GROUP BY page_id)
SELECT page_id, 'Check the tags.' || chr(10) || chr(10) || 'Passage:' || chr(10) || coalesce({Q.strip(Q.strip_markup('html'))}, '')
       || chr(10) || chr(10) || 'Candidates: ' || coalesce(listed, 'None') || chr(10) || chr(10) || 'Answer as JSON.' || chr(10) AS prompt
FROM pages LEFT JOIN names USING (page_id)""",
    "parse_responses": f"""
SELECT doc_id, CASE WHEN lang = 'en' THEN len(list_distinct({Q.words('text')}))::bigint END AS n_tropes,
       CASE WHEN lang = 'en' THEN source END AS examples FROM documents""",
}
