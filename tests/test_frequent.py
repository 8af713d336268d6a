"""Frequent items by summaries against plain counts."""

import random
from collections import Counter

import pytest

from scriptorium.operators import frequent as Q
from scriptorium.operators.stats import top_items


def best(rows, k):
    order = sorted(Counter(rows).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]
    return [(i, n, r) for r, (i, n) in enumerate(order, 1)]


def skewed(n, seed=0):
    rng = random.Random(seed)
    return [f"hot{rng.randint(0, 9)}" if rng.random() < 0.4 else f"rare{rng.randint(0, n)}" for _ in range(n)] + [None] * (n // 20)


@pytest.mark.parametrize("capacity", [3, 30, 500, 100_000])
@pytest.mark.parametrize("k", [1, 7, 11])
def test_heavy_items(spark, capacity, k):
    rows = skewed(4000)
    df = spark.createDataFrame([(r, 1) for r in rows], "item string, other int").repartition(5)
    got = [tuple(r) for r in Q.heavy_items(df, "item", k, capacity=capacity).orderBy("rank").collect()]
    assert got == best(rows, k) == [tuple(r) for r in top_items(df, "item", k).orderBy("rank").collect()]


def test_bounds_of_a_summary():
    rows = skewed(5000, 3)
    own, true = Q.Summary(40), Counter(rows)
    for a in range(0, len(rows), 40):
        part = Counter(rows[a:a + 40])
        own.add(list(part), list(part.values()))
        assert len(own.counts) <= 40
    assert own.taken > 0 and all(own.counts.get(i, 0) <= n <= own.counts.get(i, 0) + own.taken for i, n in true.items())
    assert own.taken <= len(rows) / 41


def test_only_summaries_are_shuffled(spark):
    rows = spark.range(50_000).selectExpr("case when id % 3 = 0 then 'hot' else concat('x', id) end as item").repartition(4)
    assert Q.summaries(rows, "item", 100).count() <= 4 * 101
    assert [tuple(r) for r in Q.heavy_items(rows, "item", 1, capacity=100).collect()] == [("hot", 16_667, 1)]


def test_numbers_few_and_none(spark):
    df = spark.createDataFrame([(i % 3,) for i in range(10)], "item long")
    assert [tuple(r) for r in Q.heavy_items(df, "item", 5).orderBy("rank").collect()] == [(0, 4, 1), (1, 3, 2), (2, 3, 3)]
    assert Q.heavy_items(df.limit(0), "item", 5).count() == 0
    assert [tuple(r) for r in Q.heavy_items(df, "item", 1, candidates=0).collect()] == [(0, 4, 1)]
