"""Queries that go through files: what is written must be read back the same."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scriptorium.operators import stats as S
from scriptorium.operators import writes as W
from scriptorium.session import store, work_dir
from scriptorium.sources import files as I
from scriptorium.sources.tables import load


def src_csv_roundtrip(spark, d):
    docs = load(spark, d, "documents", "doc_id", "source", "text")
    path = work_dir(spark, "csv")
    I.write_csv(docs, path)
    return I.read_csv(spark, path, docs.schema)


def src_csv_ranges(spark, d):
    """Large files with line breaks in their fields, each read by several tasks; one file up to 256 MB of text, so that no task has to write all."""
    docs = load(spark, d, "documents", "doc_id", "source", "text")
    path = work_dir(spark, "csv")
    I.write_csv(docs, path, file_bytes=256 << 20)
    return I.read_csv_ranges(spark, path, docs.schema)


def src_delimited_roundtrip(spark, d):
    rows = load(spark, d, "part", "p_partkey", "p_name", "p_type", "p_retailprice")
    path = work_dir(spark, "delimited")
    I.write_csv(rows, path, sep=";")
    return I.read_csv(spark, path, rows.schema, sep=";", multi_line=False)


def src_wholetext_key(spark, d):
    """One text file per conversation, named by its folder."""
    talks = S.assemble_text(load(spark, d, "conversations"), "conv_id", "turn", "text")
    path = work_dir(spark, "texts")
    I.write_scripts(talks, "conv_id", "text", path)
    name = F.regexp_extract("_metadata.file_path", r"conv_id=(\d+)/", 1)
    return I.read_whole_text(spark, path, name, nested=True).select(
        F.col("name").cast("bigint").alias("conv_id"), "text")


def _written_pages(spark, d):
    """Pages as files, one folder per page: name and bytes are known from the table."""
    pages = load(spark, d, "pages").select("page_id", F.regexp_replace("html", r"[\r\n]+", " ").alias("value"))
    path = work_dir(spark, "pages")
    I.write_keyed_texts(pages, "page_id", "value", path)
    return path


def src_binary_manifest(spark, d):
    files = I.file_manifest(spark, _written_pages(spark, d), "*.txt")
    return files.groupBy("kind").agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def src_raw_landing(spark, d):
    source, path = _written_pages(spark, d), work_dir(spark, "raw")
    I.land_raw(spark, source, path, "*.txt")
    raw = spark.read.parquet(path)
    return raw.select(F.regexp_extract("path", r"page_id=(\d+)/", 1).cast("bigint").alias("page_id"), "kind",
                      "length", F.md5("content").alias("md5"))


def src_chunked_landing(spark, d):
    """Files in chunks of a thousand bytes, put together again."""
    target = work_dir(spark, "chunks")
    I.land_chunks(spark, _written_pages(spark, d), target, glob="*.txt", chunk_bytes=1000)
    chunks = spark.read.parquet(target)
    page = F.regexp_extract("path", r"page_id=(\d+)/", 1).cast("bigint")
    whole = F.aggregate("c.content", F.lit(b""), lambda a, b: F.concat(a, b))
    landed = chunks.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("chunk", "content"))).alias("c"), F.max(F.octet_length("content")).alias("most"))
    return landed.join(I.file_digests(chunks), "path").select(page.alias("page_id"), "length", "n_chunks", (F.col("complete") & (F.col("most") <= 1000)).alias("complete"), F.md5(whole).alias("md5"))


def src_html_files(spark, d):
    """Pages read back as HTML files."""
    pages = I.read_html_files(spark, _written_pages(spark, d), glob="*.txt", nested=True)
    return pages.groupBy(F.regexp_extract("html", r"<title>([^<]*)", 1).alias("title")).agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("n_chars"))


def json_map_rejects(spark, d):
    """Every third object is cut short, every fifth has values with a fraction."""
    n = F.col("event_id")
    text = F.when(n % 3 == 0, F.expr("substring(props, 1, length(props) - 1)")).when(n % 5 == 0, F.regexp_replace("props", r"(\d)([,}])", "$1.5$2")).otherwise(F.col("props"))
    rows = load(spark, d, "events").select("event_id", text.alias("props"))
    lost = I.map_rejects(rows, "props", "map<string,int>", "event_id").groupBy("event_id", "reason").agg(F.count("*").alias("n"))
    kept = I.map_rows(rows, "props", "map<string,int>", "event_id").groupBy("event_id").agg(F.count("*").alias("n"))
    return lost.unionByName(kept.select("event_id", F.lit("read").alias("reason"), "n"))


def written_tags(spark, d):
    """Created, filled and updated twice over, then read back; updates without a row are counted in a row of their own."""
    table = f"tags_{uuid.uuid4().hex}"
    docs = load(spark, d, "documents").where("lang <> 'de'").select("doc_id", "lang", F.lit(None).cast("int").alias("quality"))
    labels = load(spark, d, "labels", "doc_id", "quality")
    for _ in range(2):
        W.append_keyed(spark, table, docs, "doc_id", 8)
        missing = W.update_keyed(spark, table, labels, "doc_id", "quality", 8)
    rows = store(spark.table(table).select("doc_id", "lang", "quality"), "read")
    spark.sql(f"DROP TABLE {table}")
    count = missing.agg(F.count("*").alias("n")).select(F.lit(-1).cast("bigint").alias("doc_id"), F.lit("unmatched").alias("lang"), F.col("n").cast("int").alias("quality"))
    return rows.unionByName(count)


def grown_table(spark, d):
    """A table that starts with one share and is filled in ten appends, then updated: its shares split on the way. Row counts and updates by language, and
    whether shares kept to their bound."""
    table = f"grown_{uuid.uuid4().hex}"
    docs = load(spark, d, "documents", "doc_id", "text", "lang").withColumn("quality", F.lit(None).cast("int"))
    labels = load(spark, d, "labels", "doc_id", "quality")
    for part in range(10):
        W.append_keyed(spark, table, docs.where(F.pmod("doc_id", F.lit(10)) <= part), "doc_id", share_bytes=100_000)
    W.update_keyed(spark, table, labels, "doc_id", "quality", 3)
    held = [(r.key, r.value) for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r.key == W.SHARES]
    bounded = W.size_of(spark, table) <= 1.5 * 100_000 * int(held[0][1])
    rows = store(W.keyed_rows(spark, table).groupBy("lang").agg(F.count("*").alias("n"), F.count("quality").alias("updated"), F.sum(F.length("text")).alias("n_chars"))
                 .withColumn("bounded", F.lit(bounded)), "read")
    spark.sql(f"DROP TABLE {table}")
    return rows


def json_map_explode(spark, d):
    rows = I.map_rows(load(spark, d, "events", "event_id", "props"), "props", "map<string,int>", "event_id")
    return rows.select("event_id", "map_key", "map_value")


def json_map_roundtrip(spark, d):
    tropes = load(spark, d, "documents").select(
        F.concat(F.lit("doc "), "doc_id").alias("name"), F.when(F.col("lang") != "de", F.col("text")).alias("definition"))
    path = work_dir(spark, "json")
    I.write_trope_lines(tropes, path)
    return I.read_trope_lines(spark, path)


def json_object_roundtrip(spark, d):
    """The whole catalogue as one object in one file, cut into entries again by ranges."""
    tropes = load(spark, d, "documents").select(
        F.concat(F.lit("doc "), "doc_id").alias("name"), F.when(F.col("lang") != "de", F.col("text")).alias("definition"))
    path = work_dir(spark, "object")
    I.write_trope_map(tropes, f"{path}/movie_tropes.json")
    return I.read_large_map(spark, path)


QUERIES = {f.__name__: f for f in (
    src_csv_roundtrip, src_csv_ranges, json_object_roundtrip, src_chunked_landing, src_delimited_roundtrip, src_wholetext_key, src_binary_manifest, src_raw_landing,
    src_html_files, json_map_explode, json_map_rejects, json_map_roundtrip, written_tags, grown_table)}

_PAGES = r"(SELECT page_id, regexp_replace(html, '[\r\n]+', ' ', 'g') || chr(10) AS value FROM pages)"

SQL = {
    "src_csv_roundtrip": "SELECT doc_id, source, text FROM documents",
    "src_csv_ranges": "SELECT doc_id, source, text FROM documents",
    "json_object_roundtrip": "SELECT 'doc ' || doc_id AS name, CASE WHEN lang <> 'de' THEN text END AS definition FROM documents",
    "src_delimited_roundtrip": "SELECT p_partkey, p_name, p_type, p_retailprice FROM part",
    "src_wholetext_key": r"""
SELECT conv_id, regexp_replace(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn), '^\s+|\s+$', '', 'g') || chr(10) AS text
FROM conversations GROUP BY conv_id""",
    "src_binary_manifest": f"SELECT 'txt' AS kind, count(*) AS n_files, sum(strlen(value))::bigint AS n_bytes FROM {_PAGES}",
    "src_raw_landing": f"SELECT page_id, 'txt' AS kind, strlen(value)::bigint AS length, md5(value) AS md5 FROM {_PAGES}",
    "src_chunked_landing": f"SELECT page_id, strlen(value)::bigint AS length, ceil(strlen(value) / 1000)::bigint AS n_chunks, true AS complete, md5(value) AS md5 FROM {_PAGES}",
    "src_html_files": f"SELECT regexp_extract(value, '<title>([^<]*)', 1) AS title, count(*) AS n, sum(length(value))::bigint AS n_chars FROM {_PAGES} GROUP BY 1",
    "json_map_rejects": """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'object' WHEN event_id % 5 = 0 THEN 'value' ELSE 'read' END AS reason,
       CASE WHEN event_id % 3 = 0 THEN 1 ELSE len(json_keys(props)) END AS n FROM events""",
    "written_tags": """
SELECT d.doc_id, d.lang, l.quality::int AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.lang <> 'de'
UNION ALL SELECT -1, 'unmatched', count(*)::int FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'de')""",
    "grown_table": """
SELECT d.lang, count(*) AS n, count(l.quality) AS updated, sum(length(d.text))::bigint AS n_chars, true AS bounded FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    "json_map_explode": """
SELECT event_id, k AS map_key, json_extract(props, '$.' || k)::int AS map_value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
    "json_map_roundtrip": "SELECT 'doc ' || doc_id AS name, CASE WHEN lang <> 'de' THEN text END AS definition FROM documents",
}
