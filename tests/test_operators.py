import pytest
from pyspark.sql import functions as F

from scriptorium.operators import dedupe as P
from scriptorium.operators import documents as D
from scriptorium.operators import merge as M
from scriptorium.operators import stats as S


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_outer_merge(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), ("l", 4)], "k string, u int")
    b = spark.createDataFrame([("x", 10), ("x", 20), (None, 30), ("r", 40)], "k2 string, v int")
    got = rows(M.outer_merge(a, b, "k", "k2"))
    assert got == sorted([
        ("x", 1, "x", 10, "both"), ("x", 1, "x", 20, "both"), ("x", 2, "x", 10, "both"), ("x", 2, "x", 20, "both"),
        (None, 3, None, 30, "both"), ("l", 4, None, None, "left_only"), (None, None, "r", 40, "right_only")], key=repr)


def test_outer_merge_with_hot_key(spark):
    """A key with most of the left rows gives the same as the built-in full outer join."""
    a = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("u"))
    b = spark.range(5, 4000, 2).select(F.col("id").alias("k2"), F.col("id").alias("v"))
    want = rows(a.join(b, F.col("k").eqNullSafe(F.col("k2")), "full_outer"))
    assert rows(M.outer_merge(a, b, "k", "k2").drop("indicator")) == want


def test_prioritized_merge(spark):
    a = spark.createDataFrame([("both", None), ("first", "a")], "name string, url string")
    b = spark.createDataFrame([("both", "b"), ("second", "c"), ("second", "d")], "name string, url string")
    assert rows(M.prioritized_merge(a, b, "name", "url")) == sorted([
        ("both", None, "pdf"), ("first", "a", "pdf"), ("second", "c", "html"), ("second", "d", "html")], key=repr)


def test_keyed_update(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, f int")
    new = spark.createDataFrame([("a", 9), ("a", 10), ("b", None), ("z", 5)], "k string, f int")
    once = M.keyed_update(target, new, "k", "f")
    assert rows(once) == [("a", 10), ("b", 2), ("c", None)]
    assert rows(M.keyed_update(once, new, "k", "f")) == rows(once)
    assert rows(M.unmatched_updates(target, new, "k")) == [("z", 5)]


def test_append_new_keys_twice_is_once(spark):
    stored = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    after = stored.unionByName(M.append_new_keys(stored, incoming, "k"))
    assert rows(after) == [("a", 1), ("b", 2)]
    assert rows(M.append_new_keys(after, incoming, "k")) == []
    assert rows(M.append_new_keys(stored.select("k"), incoming.select("k"), "k")) == [("b",)]


def test_lookup_semi_anti_rename(spark):
    a = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    t = spark.createDataFrame([("a", "A")], "key string, v string")
    assert rows(M.lookup(a, t, "k", "key", "v", "none")) == sorted([("a", "A"), ("b", "none"), (None, "none")], key=repr)
    assert rows(M.keep_matching(a, t.select(F.col("key").alias("k")), "k")) == [("a",)]
    assert rows(M.keep_unmatched(a, t.select(F.col("key").alias("k")), "k")) == sorted([("b",), (None,)], key=repr)
    assert M.rename_columns(t, "key", "name").columns == ["name", "v"]


def test_dedupe(spark):
    df = spark.createDataFrame([("x", 2, "b"), ("x", 1, "a"), ("x", 3, None), ("y", 5, "e")], "k string, o int, v string")
    assert rows(P.keep_first(df, ["k"], ["o"])) == [("x", 1, "a"), ("y", 5, "e")]
    assert rows(P.keep_last(df, ["k"], ["o"])) == sorted([("x", 3, None), ("y", 5, "e")], key=repr)
    kinds = spark.createDataFrame([("m", "html", "h"), ("m", "pdf", "p"), ("n", "html", "h2"), ("n", "odd", "a")], "k string, kind string, t string")
    assert rows(P.by_priority(kinds, ["k"], "kind", ["pdf", "html"], ["t"])) == [("m", "pdf", "p"), ("n", "html", "h2")]


def test_corpus_stats(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "1 2 3"), ("c", None), (None, "lost words")], "name string, t string")
    assert rows(S.corpus_stats(docs, "name", "t")) == [(3, 6, 2, 3, "a")]
    assert rows(S.corpus_stats(docs.where("name = 'c'"), "name", "t")) == [(1, 0, 0, 0, None)]
    assert rows(S.corpus_stats(docs.where("name = 'zz'"), "name", "t")) == [(0, 0, 0, 0, None)]


def test_items(spark):
    df = spark.createDataFrame([("m1", ["a", "b"]), ("m2", ["b", ""]), ("m3", None)], "name string, tropes array<string>")
    assert [tuple(r) for r in S.top_items(S.explode_items(df, "name", "tropes"), "item", 2).orderBy("rank").collect()] == [("b", 2, 1), ("", 1, 2)]
    assert [r[0] for r in S.distinct_items(df, "tropes", nested=True).collect()] == ["a", "b"]
    assert [r[0] for r in S.distinct_items(df, "name").collect()] == ["m1", "m2", "m3"]
    assert rows(S.find_by_item(df, "tropes", "b").select("name")) == [("m1",), ("m2",)]
    names = spark.createDataFrame([("b",), ("A",), ("a",), ("B",)], "n string")
    assert [r[0] for r in S.sort_ci(names, "n").collect()] == ["A", "a", "B", "b"]
    assert rows(S.set_union(spark.createDataFrame([("m", "z"), ("m", "a"), ("m", "z"), ("n", "q")], "k string, i string"), "k", "i")) == [
        ("m", ["a", "z"]), ("n", ["q"])]


def test_assemble_text(spark):
    pages = spark.createDataFrame([("d", 3, "c"), ("d", 1, "a"), ("d", 2, None), ("e", 1, "x")], "k string, p int, t string")
    assert rows(S.assemble_text(pages, "k", "p", "t")) == [("d", "a\n\n\n\nc", 3), ("e", "x", 1)]


def test_page_existence_is_three_valued(spark):
    pages = spark.createDataFrame([("a", "<p>There is currently no text in this page</p>"), ("b", "<p>fine</p><p>no text</p>"), ("b", "<p>no text</p>"), ("c", "<h1>bare</h1>")],
                                  "k string, html string")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    assert dict(rows(D.page_existence(asked, pages, "k", "html", "no text"))) == {"a": False, "b": True, "c": True, "d": None}


def test_link_catalog_takes_the_concepts_own_page(spark):
    own, other = "a paragraph long enough to be a definition", "another paragraph, also long enough for one"
    pages = spark.createDataFrame([(2, f'<p>{other}</p><ul><li><a href="/x2">X</a></li><li><a href="/z">Z</a></li></ul>'),
                                   (1, '<ul><li><a href="/x1">X</a></li><li><a href="/y">Y</a></li></ul>')], "id int, html string")
    stored = spark.createDataFrame([("/x1", f"<p>{own}</p>"), ("/x2", f"<p>{other}</p>"), ("/z", "<p>short</p>")], "address string, html string")
    assert rows(D.link_catalog(pages, stored, "id", "html", "address", "")) == sorted([("X", "/x1", own), ("Y", "/y", None), ("Z", "/z", None)], key=repr)


def test_no_sort_aggregate(spark):
    """Keeping one row per key neither sorts for an aggregate nor sends all rows of a key."""
    df = spark.createDataFrame([("a", 1, "x")], "k string, n int, t string")
    for one in (P.keep_first(df, ["k"], ["n"]), P.by_priority(df, ["k"], "t", ["x"], ["n"]), M.append_new_keys(df, df, "k")):
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_routes_stage_and_reasons(spark):
    df = spark.createDataFrame([("a", "html", 1), ("b", "pdf", 2), ("c", None, 3)], "n string, kind string, v int")
    out = D.route(df, "kind", {"html": ["n"], "pdf": ["n", "v"]})
    assert rows(out["html"]) == [("a",)] and rows(out["pdf"]) == [("b", 2)]
    one = spark.createDataFrame([("m", "from html"), ("o", "only html")], "name string, text string")
    two = spark.createDataFrame([("m", "from pdf")], "name string, text string")
    assert rows(D.stage_by_kind({"pdf": two, "html": one}, "name", "text")) == [("m", "from pdf", "pdf"), ("o", "only html", "html")]
    judged = D.with_reason(df, {"no_kind": F.col("kind").isNull(), "big": F.col("v") > 1})
    assert rows(judged.select("n", "reason")) == [("a", "ok"), ("b", "big"), ("c", "no_kind")]
    assert rows(D.reason_report(judged)) == [("big", 1), ("no_kind", 1), ("ok", 1)]


def test_html_to_text(spark):
    pages = spark.createDataFrame([("a", "<html><body>menu ALL SCRIPTS <pre>\n INT. X &amp; Y\n</pre></body></html>")], "n string, html string")
    assert rows(D.html_to_text(pages, "html")) == [("a", "INT. X & Y")]


SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
}


@pytest.mark.parametrize("how", ["outer_merge", "lookup", "keyed_update"])
def test_hot_key_is_split(spark, how):
    """A third of the rows have one key: the plan that ran splits it (thresholds made small)."""
    before = {c: spark.conf.get(c) for c in SMALL_SKEW}
    for c, v in SMALL_SKEW.items():
        spark.conf.set(c, v)
    try:
        a = spark.range(0, 400_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("u"))
        b = spark.range(5, 800_000, 2, 8).select(F.col("id").alias("k2"), F.col("id").alias("v"))
        df = {"outer_merge": lambda: M.outer_merge(a, b, "k", "k2"), "lookup": lambda: M.lookup(a, b, "k", "k2", "v"),
              "keyed_update": lambda: M.keyed_update(a, b.toDF("k", "u"), "k", "u")}[how]()
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_routes_from_one_pass(spark):
    df = spark.createDataFrame([("01", 1, "a"), ("1", 2, "b"), (None, 3, "c"), ("x", 4, "d")], "kind string, n int, v string")
    out = D.route_stored(df, "kind", {"01": ["n"], "1": ["n", "v"], "none": ["v"]})
    assert [rows(out[k]) for k in ("01", "1", "none")] == [[(1,)], [(2, "b")], []] and out["1"].columns == ["n", "v"]
    assert [rows(D.route_stored(df.withColumn("n", F.col("n") % 2), "n", {1: ["v"]})[1])] == [[("a",), ("c",)]]
