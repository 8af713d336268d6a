"""Keyed tables: shares that grow with the table."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import item_index as X
from scriptorium.operators import writes as W


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def shares(spark, table):
    return W._layout(spark, table)[0]


def files(spark, table):
    at = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location").replace("file:", "")
    return {(d, f) for d, _, names in os.walk(at) for f in names if f.endswith(".parquet")}


def keyed(spark, n, first=0):
    return spark.range(first, first + n).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_linear_hashing(spark, n):
    rows = spark.range(2000).select(W.share_of("id", n).alias("a"), W.share_of("id", n + 1).alias("b"), W.share_of("id", 4 * n + 1).alias("c")).collect()
    assert {r.a for r in rows} == set(range(n))
    assert all(r.b == r.a or (r.b == n and r.a == W.parent(n, n)) for r in rows)
    assert all(W.parent(r.c, n) == r.a for r in rows)


def test_the_count_of_shares_is_the_tables_own(spark, table):
    assert W.append_keyed(spark, table, keyed(spark, 100), "k", 8) == 100
    new = spark.range(100).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    assert W.update_keyed(spark, table, new, "k", "v").count() == 0
    assert W.keyed_rows(spark, table).where("v = 'new'").count() == 100
    assert W.update_keyed(spark, table, new.withColumn("v", F.lit("again")).where("k = 7"), "k", "v", 5).count() == 0
    assert W.append_keyed(spark, table, keyed(spark, 120), "k", 3) == 20 and W.keyed_rows(spark, table).count() == 120
    with pytest.raises(ValueError):
        W.update_keyed(spark, table, new, "v", "k")
    spark.range(3).write.saveAsTable(f"{table}_plain")
    with pytest.raises(ValueError):
        W.keyed_rows(spark, f"{table}_plain")
    spark.sql(f"DROP TABLE {table}_plain")


def test_shares_split_as_the_table_grows(spark, table):
    counts = []
    for part in range(10):
        assert W.append_keyed(spark, table, keyed(spark, 400, 400 * part), "k", share_bytes=30_000) == 400
        counts.append(shares(spark, table))
        assert W.size_of(spark, table) <= 1.5 * 30_000 * counts[-1]
    assert counts == sorted(counts) and counts[-1] >= 8 > counts[0]
    assert sorted(map(tuple, W.keyed_rows(spark, table).collect())) == sorted(map(tuple, keyed(spark, 4000).collect()))
    assert spark.table(table).count() == 4000
    assert W.append_keyed(spark, table, keyed(spark, 4000), "k") == 0 and shares(spark, table) == counts[-1]
    before = files(spark, table)
    assert W.update_keyed(spark, table, spark.createDataFrame([(17, "x"), (-1, "none")], "k long, v string"), "k", "v").collect()[0].k == -1
    changed = {d for d, _ in before ^ files(spark, table)}
    assert len(changed) <= 2 and W.keyed_rows(spark, table).where("k = 17").first().v == "x" and spark.table(table).count() == 4000


def test_a_broken_split_is_not_seen(spark, table):
    W.append_keyed(spark, table, keyed(spark, 300), "k", 2)
    rows = W._placed(spark, table).withColumn(W.SHARE, W.share_of("k", 4))
    W._overwrite(spark, table, W.store(rows.where("key_share >= 2"), "left"))  # stopped before the count changed
    assert spark.table(table).count() > 300 and W.keyed_rows(spark, table).count() == 300
    W._set(spark, table, {W.SHARES: 4})  # stopped behind it
    assert W.keyed_rows(spark, table).count() == 300
    assert W.update_keyed(spark, table, keyed(spark, 300).withColumn("v", F.lit("y")), "k", "v").count() == 0
    assert spark.table(table).where("v = 'y'").count() == 300 == spark.table(table).count()


def test_rows_without_key_and_nothing(spark, table):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "a")], "k long, v string")
    assert [W.append_keyed(spark, table, rows, "k") for _ in range(2)] == [1, 0]
    assert [tuple(r) for r in W.keyed_rows(spark, table).collect()] == [(1, "a")]
    assert W.append_keyed(spark, table, rows.limit(0), "k") == 0
    assert W.update_keyed(spark, table, rows.limit(0), "k", "v").count() == 0
    assert [tuple(r) for r in W.update_keyed(spark, table, rows.where("k is null"), "k", "v").collect()] == [(None, "a")]


def test_item_index(spark, table):
    index = f"{table}_index"
    sets = {k: [f"i{k % 7}", "all", f"i{k}"] for k in range(200)} | {500: [], 501: None}
    W.append_keyed(spark, table, spark.createDataFrame(list(sets.items()), "k long, items array<string>"), "k", 4)
    X.build_index(spark, table, index, "k", "items")

    def check(*wanted):
        for w in wanted:
            want = {k for k, v in sets.items() if v and w in v}
            assert {r.k for r in X.keys_with_item(spark, index, "k", w).collect()} == want
            assert {r.k for r in X.rows_with_item(spark, table, index, "k", "items", w).collect()} == want

    def update(rows):
        sets.update({k: v for k, v in rows.items() if k in sets and v is not None})
        return [r.k for r in X.update_sets(spark, table, index, spark.createDataFrame(list(rows.items()), "k long, items array<string>"), "k", "items").collect()]

    check("all", "i3", "i77", "none")
    assert update({3: ["new", "all"], 10: [], 501: ["new"], 900: ["new"], 11: None}) == [900]
    check("new", "i3", "all", "i10", "i4")
    assert update({3: ["i3"], 10: ["all"]}) == [] and update({3: ["i3"], 10: ["all"]}) == []
    check("new", "i3", "all")
    X.compact(spark, index, "k")
    check("new", "i3", "all", "i5")
    assert spark.table(index).count() == sum(len(set(v or ())) for v in sets.values())
    plan = X.keys_with_item(spark, index, "k", "i3")._jdf.queryExecution().toString()
    assert "EqualTo(item,i3)" in plan
    spark.sql(f"DROP TABLE {index}")


def test_rows_of_a_split_share_come_with_the_split(spark, table):
    """An append that doubles the shares writes one file a share, and a repeat adds nothing."""
    W.append_keyed(spark, table, keyed(spark, 400), "k", share_bytes=15_000)
    before = shares(spark, table)
    assert W.append_keyed(spark, table, keyed(spark, 1600), "k") == 1200
    assert shares(spark, table) >= 2 * before
    assert len(files(spark, table)) == len({d for d, _ in files(spark, table)}) == shares(spark, table)
    assert W.append_keyed(spark, table, keyed(spark, 1600), "k") == 0 and W.keyed_rows(spark, table).count() == 1600
    assert {tuple(r) for r in W.keyed_rows(spark, table).select("k", "v").collect()} == {tuple(r) for r in keyed(spark, 1600).collect()}


def test_runs_of_shares(spark):
    ids = spark.range(200).select(F.col("id").cast("int").alias("id"))
    for some in ([], [0], [3, 4, 5], [0, 1, 7, 9, 10], list(range(0, 200, 2))):
        assert [r.id for r in ids.where(W._among("id", some)).orderBy("id").collect()] == some
