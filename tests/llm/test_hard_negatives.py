"""Hard negatives against a plain search over all pairs, on awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import hard_negatives

SCHEMA = "vec_id long, label int, vector array<long>, score long, rank int, given long"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    one = {}
    for i, y, x in rows:
        if None not in (i, y, x) and None not in x:
            one[i] = min(one.get(i, (y, x)), (y, x))
    out = []
    for a, (ya, xa) in one.items():
        if a % 100:
            continue
        score = {i: sum(p * q for p, q in zip(xa, x)) for i, (_, x) in one.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if one[i][0] == ya][:positives]:
            band = [i for i in order if one[i][0] != ya and low * score[p] <= 100 * score[i] <= high * score[p]][:negatives]
            out += [(a, p, n, i, score[p], score[i]) for n, i in enumerate(band, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **options).collect()))


def vectors(n, dim, spread, seed=1):
    rng = random.Random(seed)
    centres = [[rng.randint(-spread, spread) for _ in range(dim)] for _ in range(4)]
    return [(i, rng.randint(0, 3), [c + rng.randint(-spread, spread) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("dim, spread", [(2, 3), (8, 20), (8, 1), (5, 10 ** 8), (3, 3 * 10 ** 8)])
def test_against_all_pairs(spark, dim, spread):
    rows = vectors(700, dim, spread)
    assert mined(spark, rows) == plain(rows) != []


def test_awkward_rows(spark):
    rows = vectors(400, 4, 5)
    common = [(1000 + i, 2, [5, 5, 5, 5]) for i in range(300)] + [(2000 + i, 1, [5, 5, 5, 5]) for i in range(300)]
    rows += common + [(None, 1, [1, 2, 3, 4]), (401, None, [1, 2, 3, 4]), (402, 1, None), (403, 1, [1, None, 3, 4]), (404, 1, []), (500, 1, []), (405, 1, [7]),
                      (600, 2, [4, 4, 4, 9, 5, 6]), (601, 3, [0, 0, 0, 0]), (7, 0, [9, 9, 9, 9]), (-100, 3, [1, 5, 5, 2]), rows[100], rows[200]]
    random.Random(3).shuffle(rows)
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=3, low=0, high=100) == plain(rows, 2, 3, 0, 100)


def test_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [1]), (2, 2, [1])]) == [] and mined(spark, [(100, 1, [1, 2])]) == []


def test_shards_and_steps_do_not_matter(spark, monkeypatch):
    rows = vectors(1500, 6, 9)
    expected = plain(rows)
    monkeypatch.setattr(hard_negatives, "SHARD", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "STEP", 2)
    assert mined(spark, rows) == expected


def test_walks_stop_early():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 16)) * 40
    x = np.rint(centres[rng.integers(0, 4, 20_000)] + rng.normal(size=(20_000, 16))).astype(np.int64)
    shard = hard_negatives.Shard(np.arange(200), np.zeros(200), x[:200], [(i, 0, -(1 << 62), 1 << 62) for i in range(200)], True, 5)
    walk = hard_negatives.Walk(shard)
    walk.block(np.arange(20_000), np.zeros(20_000, np.int64), x)
    assert walk.products < 0.5 * 200 * 20_000
