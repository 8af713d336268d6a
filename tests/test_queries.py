"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry
from scriptorium.suite import all_queries, all_sql

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", all_queries())
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, entry.queries()[name], SQL.get(name)) == ""


def test_every_query_has_sql():
    assert set(SQL) == set(all_queries()) - {"knn_approximate"}  # tested with the search operators
    assert set(all_queries()) <= set(entry.queries())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["tag_documents", "knn_topk", "jaccard_best_match", "link_catalog", "ingest_lists", "corpus_stats"])
def test_partition_count_does_not_matter(spark, name):
    def rows(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(tuple, entry.queries()[name](spark, FOLDER).collect()), key=repr)

    try:
        assert rows("1") == rows("13")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
