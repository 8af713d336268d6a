"""Queries on item sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scriptorium.functions.sets import jaccard
from scriptorium.functions.text import strip, words
from scriptorium.operators import item_index as X
from scriptorium.operators import similarity as J
from scriptorium.operators import stats as S
from scriptorium.operators import writes as W
from scriptorium.operators.frequent import heavy_items
from scriptorium.session import store
from scriptorium.sources.tables import load

WANTED = '{"k": 7}'


def _lines(spark, d):
    lines = load(spark, d, "documents").select("doc_id", F.explode_outer(F.split("text", "\n")).alias("line"))
    return lines.select("doc_id", strip(F.col("line")).alias("line")).where(F.col("line") != "")


def _user_sets(spark, d):
    return S.set_union(load(spark, d, "events", "user_id", "props"), "user_id", "props", "items")


def group_set_union(spark, d):
    items = load(spark, d, "lineitem", "l_partkey", "l_suppkey").join(
        load(spark, d, "part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    sets = S.set_union(items, "l_suppkey", "p_type")
    return sets.select("l_suppkey", F.array_join("items", ",").alias("items"))


def top_items(spark, d):
    return S.top_items(load(spark, d, "events", "user_id", "props").distinct(), "props")


def top_lines(spark, d):
    """A document's lines count once; no line is shuffled that is not frequent in some task."""
    lines = F.array_distinct(F.transform(F.split("text", "\n"), strip))
    docs = load(spark, d, "documents", "text").select(F.explode(F.filter(lines, lambda x: x != "")).alias("line"))
    return heavy_items(docs, "line")


def distinct_items(spark, d):
    return S.distinct_items(load(spark, d, "events"), "props")


def distinct_words(spark, d):
    docs = load(spark, d, "documents").select(words(F.col("text")).alias("words"))
    return S.distinct_items(docs, "words", nested=True)


def find_by_item(spark, d):
    found = S.find_by_item(_user_sets(spark, d), "items", WANTED)
    return found.select("user_id", F.size("items").cast("bigint").alias("n_items"))


def find_by_item_indexed(spark, d):
    """Through the index, after every tenth set lost the item and every tenth other one got it."""
    name = uuid.uuid4().hex
    table, index, wanted = f"sets_{name}", f"index_{name}", F.array(F.lit(WANTED))
    W.append_keyed(spark, table, _user_sets(spark, d), "user_id", 4)
    X.build_index(spark, table, index, "user_id", "items")
    changed = F.when(F.col("user_id") % 10 == 0, F.array_except("items", wanted)).otherwise(F.array_union("items", wanted))
    X.update_sets(spark, table, index, _user_sets(spark, d).where("user_id % 10 < 2").select("user_id", changed.alias("items")), "user_id", "items")
    found = X.rows_with_item(spark, table, index, "user_id", "items", WANTED).select("user_id", F.size("items").cast("bigint").alias("n_items"))
    out = store(found, "found")
    for t in (table, index):
        spark.sql(f"DROP TABLE {t}")
    return out


def jaccard_pair(spark, d):
    """Each user with the next one."""
    sets = _user_sets(spark, d)
    after = sets.select((F.col("user_id") - 1).alias("user_id"), F.col("items").alias("next_items"))
    return sets.join(after, "user_id").select("user_id", jaccard(F.col("items"), F.col("next_items")).alias("score"))


def jaccard_scores(spark, d):
    return J.similarity_to_one(load(spark, d, "events"), "user_id", "props", 0)


def jaccard_one_vs_all(spark, d):
    return J.most_similar_to(load(spark, d, "events"), "user_id", "props", 0)


def jaccard_best_match(spark, d):
    return J.best_matches(load(spark, d, "events"), "user_id", "props")


def jaccard_best_match_docs(spark, d):
    return J.best_matches(_lines(spark, d), "doc_id", "line", load(spark, d, "documents", "doc_id"))


QUERIES = {f.__name__: f for f in (
    group_set_union, top_items, top_lines, distinct_items, distinct_words, find_by_item, find_by_item_indexed, jaccard_pair, jaccard_scores,
    jaccard_one_vs_all, jaccard_best_match, jaccard_best_match_docs)}

_LINES = r"""SELECT DISTINCT doc_id AS k, line AS i FROM (
    SELECT doc_id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE line <> ''"""
_USERS = "SELECT DISTINCT user_id AS k, props AS i FROM events"


def _scores(members: str) -> str:
    return f"""
  m AS ({members}),
  n AS (SELECT k, count(*) AS n FROM m GROUP BY k),
  p AS (SELECT a.k AS k, b.k AS match, count(*) AS shared FROM m a JOIN m b ON a.i = b.i AND a.k <> b.k GROUP BY ALL),
  s AS (SELECT p.k, match, shared / (x.n + y.n - shared) AS score FROM p JOIN n x ON p.k = x.k JOIN n y ON p.match = y.k),
  best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, match) = 1)"""


SQL = {
    "group_set_union": """
SELECT l_suppkey, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    "top_items": """
SELECT props, count(DISTINCT user_id) AS n, row_number() OVER (ORDER BY count(DISTINCT user_id) DESC, props)::int AS rank
FROM events GROUP BY props ORDER BY n DESC, props LIMIT 10""",
    "top_lines": f"""
SELECT i AS line, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, i)::int AS rank FROM ({_LINES}) GROUP BY i ORDER BY n DESC, i LIMIT 10""",
    "distinct_items": "SELECT DISTINCT props AS item FROM events",
    "distinct_words": r"SELECT DISTINCT w AS item FROM (SELECT unnest(string_split_regex(text, '\s+')) AS w FROM documents) WHERE w <> ''",
    "find_by_item": f"""
SELECT user_id, count(DISTINCT props) AS n_items FROM events GROUP BY user_id HAVING bool_or(props = '{WANTED}')""",
    "find_by_item_indexed": f"""
WITH s AS (SELECT user_id, list_distinct(list(props)) AS items FROM events GROUP BY user_id)
SELECT user_id, (len(items) + CASE WHEN list_contains(items, '{WANTED}') THEN 0 ELSE 1 END)::bigint AS n_items FROM s
WHERE user_id % 10 = 1 OR (user_id % 10 > 1 AND list_contains(items, '{WANTED}'))""",
    "jaccard_pair": """
WITH s AS (SELECT user_id, list_distinct(list(props)) AS items FROM events GROUP BY user_id)
SELECT a.user_id, len(list_intersect(a.items, b.items)) / (len(a.items) + len(b.items) - len(list_intersect(a.items, b.items))) AS score
FROM s a JOIN s b ON b.user_id = a.user_id + 1""",
    "jaccard_scores": f"""
WITH m AS ({_USERS}), r AS (SELECT i FROM m WHERE k = 0), c AS (SELECT count(*) AS n FROM r)
SELECT k AS user_id, count(r.i) / (count(*) + any_value(c.n) - count(r.i)) AS score FROM m LEFT JOIN r ON m.i = r.i, c WHERE k <> 0 GROUP BY k""",
    "jaccard_one_vs_all": f"""
WITH m AS ({_USERS}), r AS (SELECT i FROM m WHERE k = 0), c AS (SELECT count(*) AS n FROM r)
SELECT k AS user_id, count(r.i) / (count(*) + any_value(c.n) - count(r.i)) AS score FROM m LEFT JOIN r ON m.i = r.i, c WHERE k <> 0
GROUP BY k ORDER BY score DESC, user_id LIMIT 1""",
    "jaccard_best_match": f"WITH {_scores(_USERS)} SELECT k AS user_id, match, score FROM best",
    "jaccard_best_match_docs": f"""
WITH {_scores(_LINES)},
  f AS (SELECT min(doc_id) AS a FROM documents),
  g AS (SELECT min(doc_id) AS b FROM documents, f WHERE doc_id > a)
SELECT doc_id, coalesce(match, CASE WHEN doc_id = a THEN b ELSE a END) AS match, coalesce(score, 0) AS score
FROM documents LEFT JOIN best ON k = doc_id, f, g""",
}
