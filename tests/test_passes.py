"""Searches in passes: queries are neither copied, shuffled nor stored once a shard."""

import numpy as np
import pytest

from scriptorium import session
from scriptorium.operators.kernels import nearest
from scriptorium.operators.knn import knn_join

SCHEMA = "item_id long, vector array<double>"


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], SCHEMA).repartition(3)


def brute(x, k):
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    return [(i, int(j), r + 1) for i, order in enumerate(np.argsort(d, axis=1, kind="stable")[:, :k]) for r, j in enumerate(order)]


@pytest.fixture(scope="module")
def vectors():
    return np.random.default_rng(3).integers(0, 4, (300, 4)).astype(float)  # many equal distances


def stored(spark, name):
    return sum(f"/{name}-" in p for p in session._stored.get(spark.sparkContext.applicationId, []))


def test_shards_of_one_pass_store_no_queries(spark, vectors):
    df, before = table(spark, vectors), stored(spark, "neighbours")
    got = knn_join(df.withColumnRenamed("item_id", "q"), df, 4, exclude="q", max_broadcast_bytes=0, shard_bytes=1000)
    assert [(r.q, r.neighbour, r["rank"]) for r in got.orderBy("q", "rank").collect()] == brute(vectors, 4)
    assert stored(spark, "neighbours") == before


def test_passes_keep_the_best_so_far(spark, vectors):
    df, before = table(spark, vectors), stored(spark, "neighbours")
    got = knn_join(df.withColumnRenamed("item_id", "q"), df, 4, exclude="q", max_broadcast_bytes=0, shard_bytes=1000, pass_bytes=6000)
    assert [(r.q, r.neighbour, r["rank"]) for r in got.orderBy("q", "rank").collect()] == brute(vectors, 4)
    assert stored(spark, "neighbours") - before == 2  # 300 rows of 48 bytes and the digits of their ids are three passes


@pytest.mark.parametrize("block", [1, 7, 64, 8192])
def test_a_running_bound_loses_nothing(vectors, block):
    rows, cols, distance, rank = nearest(vectors, vectors, 4, np.arange(300), block)
    assert list(zip(rows.tolist(), cols.tolist(), rank.tolist())) == brute(vectors, 4)
    rows, cols, *_ = nearest(vectors[:5], vectors, 1000, None, block)
    assert len(rows) == 1500
