"""The registered queries of this package: each applies its operator to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from scriptorium.llm import bpe_tokens, conversation_trie, decontaminate, fingerprints, hard_negatives, licenses, ngram_join, privacy, quality, substring_dedup, suffix_dedup, token_counts, toxicity
from scriptorium.llm.common import documents, store
from scriptorium.sources.tables import load


def op1_ngram_join(spark, d):
    return ngram_join.similar_components(documents(spark, d), k=3, num=90).select("doc_id", "n_shingles", "component_id")


def op2_fingerprints(spark, d):
    return fingerprints.fingerprints(documents(spark, d))


def op3_decontaminate(spark, d):
    return decontaminate.leaks(documents(spark, d), load(spark, d, "benchmark", "item_id", "text"))


def op4_privacy(spark, d):
    return privacy.sanitise(documents(spark, d), texts=False)


def op5_bpe_tokens(spark, d):
    return bpe_tokens.token_digests(documents(spark, d), public_tokenizers.path("byte_bpe_50k.json"))


def op6_suffix_dedup(spark, d):
    return suffix_dedup.remove_strings(documents(spark, d), texts=False)


def op7_substring_dedup(spark, d):
    return substring_dedup.remove_repeats(documents(spark, d), texts=False)


def op8_quality(spark, d):
    return quality.score_quality(documents(spark, d), load(spark, d, "labels", "doc_id", "quality"))


def op9_toxicity(spark, d):
    return toxicity.score_toxicity(documents(spark, d), load(spark, d, "labels", "doc_id", "toxic"))


def op10_token_counts(spark, d):
    return token_counts.count_tokens(documents(spark, d), public_tokenizers.path("piece_bpe_32k.model"))


def op11_licenses(spark, d):
    return licenses.scan(documents(spark, d))


def op12_conversation_trie(spark, d):
    convs = store(conversation_trie.conversations(load(spark, d, "conversations", "conv_id", "turn", "role", "text")), "turns")
    c = F.col("conv_id")
    head = convs.select("conv_id", (c - c % 100).alias("head_id"), (F.crc32(c.cast("string")) % 6).alias("h"))
    return conversation_trie.prefix_trie(conversation_trie.with_heads(convs, head, 5))


def op13_hard_negatives(spark, d):
    x = F.col("embedding")
    rows = load(spark, d, "embeddings", "vec_id", "label", "embedding").where(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform(x, lambda c: F.floor(256 * c.cast("double"))).alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_fingerprints, op3_decontaminate, op4_privacy, op5_bpe_tokens, op6_suffix_dedup, op7_substring_dedup, op8_quality, op9_toxicity, op10_token_counts,
                                   op11_licenses, op12_conversation_trie, op13_hard_negatives)}
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What SQL can express; the others are tested against libraries, plain versions or held-out labels.
SQL: dict[str, str] = {
    "op1_ngram_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS words FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS g
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
  edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
  reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::bigint AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id""",
    "op6_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  g AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
  f AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s),
  hit AS (SELECT g.doc_id, i FROM g JOIN f ON g.s = f.s WHERE low < g.doc_id),
  cut AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
          SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit)),
  runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM cut GROUP BY doc_id, run),
  gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
  kept AS (SELECT doc_id, count(*) AS n, sum(b - a) AS removed, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
           FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (len(h) // 2)::bigint AS n_bytes, coalesce(removed, 0)::bigint AS n_removed, coalesce(n, 0)::bigint AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op7_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
  g AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
  f AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s),
  gone AS (SELECT DISTINCT doc_id, i + o AS p FROM g JOIN f ON g.s = f.s, range(13) r(o) WHERE low < doc_id),
  each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
  kept AS (SELECT e.doc_id, count(gone.p) AS n, string_agg(word, ' ' ORDER BY e.p) FILTER (WHERE gone.p IS NULL) AS t
           FROM each e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.p = e.p GROUP BY e.doc_id)
SELECT w.doc_id, len(words)::bigint AS n_words, coalesce(n, 0)::bigint AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op12_conversation_trie": """
WITH t AS (SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
  b AS (SELECT conv_id, flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint, 0, 0, 0, 0, 0, 0, 0])) AS bits FROM t),
  h AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295::bigint, bits), lambda x, y: xor(xor(x, y) >> 1, CASE WHEN xor(x, y) & 1 = 1 THEN 3988292384::bigint ELSE 0 END)),
                            4294967295::bigint) % 6 AS h FROM b),
  r AS (SELECT t.conv_id, list_concat(coalesce(list_slice(o.turns, 1, h), []), list_slice(t.turns, h + 1, len(t.turns))) AS turns
        FROM t JOIN h USING (conv_id) LEFT JOIN t o ON o.conv_id = t.conv_id - t.conv_id % 100),
  p AS (SELECT conv_id, turns, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth FROM r),
  m AS (SELECT list_slice(turns, 1, depth) AS node, depth, conv_id, size FROM p),
  n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256 FROM m GROUP BY node, depth),
  k AS (SELECT list_slice(node, 1, depth - 1) AS node, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
  a AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.depth > 0 THEN (n_convs - 1) * length(n.node[n.depth].t) ELSE 0 END AS saved FROM n LEFT JOIN k ON n.node = k.node AND n.depth = k.depth),
  s AS (SELECT list_slice(node, 1, d) AS node, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM a) GROUP BY 1, 2)
SELECT a.conv_id, a.depth, u.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves::bigint AS n_leaves, s.saved_tokens::bigint AS saved_tokens, a.ends_sha256
FROM a JOIN s ON a.node = s.node AND a.depth = s.depth LEFT JOIN n u ON u.depth = a.depth - 1 AND u.node = list_slice(a.node, 1, a.depth - 1)""",
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS q
           FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
  p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
  n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)::int AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
