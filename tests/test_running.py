"""The inverted file's running bound: answers of a cell are no work for the next one, and no query is alone with its file."""

import numpy as np
import pytest

from scriptorium.operators import ivf

SCHEMA = "item_id long, vector array<double>"


def table(spark, x, parts=4):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], SCHEMA).repartition(parts)


def brute(x, k):
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    return np.argsort(d, axis=1, kind="stable")[:, :k]


@pytest.mark.parametrize("probes", [1000, 9])
def test_cells_hand_on_the_best_only(spark, monkeypatch, probes):
    merged = ivf._merged

    def bounded(best, rows, distance, items, k):
        if len(rows) > k * len(best):
            raise ValueError(f"{len(rows)} answers of {len(best)} queries")
        return merged(best, rows, distance, items, k)

    monkeypatch.setattr(ivf, "_merged", bounded)
    x = np.random.default_rng(5).integers(0, 5, (400, 4)).astype(float)
    index = ivf.build(table(spark, x), block_rows=20)
    got = ivf.search(index, table(spark, x).withColumnRenamed("item_id", "q"), 4, probes=probes, exclude="q", block_rows=16).orderBy("q", "rank").collect()
    assert len(got) == 1600
    if probes > index.cells:
        assert [r.neighbour for r in got] == brute(x, 4).ravel().tolist()
    else:
        true = brute(x, 4)
        assert all(r.neighbour == true[r.q][r["rank"] - 1] for r in got if r.certified)


def test_one_partition_of_queries_is_dealt_out(spark):
    x = np.random.default_rng(6).normal(size=(10_100, 3))
    df = table(spark, x, 1)
    index = ivf.build(df)
    got = ivf.search(index, df.where("item_id < 50").withColumnRenamed("item_id", "q"), 2, probes=index.cells, exclude="q")
    assert "RoundRobinPartitioning" in got._jdf.queryExecution().executedPlan().toString()
    d = ((x[:50, None] - x[None]) ** 2).sum(2)
    d[np.arange(50), np.arange(50)] = np.inf
    assert [r.neighbour for r in got.orderBy("q", "rank").collect()] == np.argsort(d, axis=1)[:, :2].ravel().tolist()


@pytest.mark.parametrize("scale", [1, 1e-9, 1e-20, 1e18, 1e100])
@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_any_piece_and_size_of_numbers(scale, pieces):
    from scriptorium.operators.kernels import Piece, Running

    rng = np.random.default_rng(7)
    whole = np.concatenate([rng.integers(0, 3, (150, 4)), rng.normal(size=(50, 4)) * 1e-3 + 1, np.ones((20, 4))])
    x, true = whole * scale, brute(whole, 4)
    best = Running(x, 4, np.full(220, np.inf))
    for part in np.array_split(rng.permutation(220), pieces):
        place = np.sort(part)
        for at in range(0, 220, 50):
            own = np.flatnonzero(np.isin(place, np.arange(at, min(at + 50, 220))))
            best.meet(np.arange(at, min(at + 50, 220)), Piece(x[place], place), (place[own] - at, own))
    far = ((x[:, None] - x[best.place]) ** 2).sum(2)
    assert np.array_equal(best.distance, far) or np.allclose(best.distance, far, rtol=1e-12)
    exact = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(exact, np.inf)
    assert np.array_equal(best.place, np.argsort(exact, axis=1, kind="stable")[:, :4]) and (scale != 1 or np.array_equal(best.place[:150], true[:150]))


def test_equal_ids_and_null_ids_are_left_out_once_a_cell(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [0.0, 1.0]), (2, [5.0, 5.0]), (None, [0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    index = ivf.build(df, cells=2)
    got = ivf.search(index, df.distinct().withColumnRenamed("item_id", "q"), 9, probes=2, exclude="q").collect()
    left = {q: sorted(((r.neighbour, r.distance) for r in got if r.q == q), key=str) for q in (1, 2, None)}
    assert left[1] == [(1, 0.0), (2, 50.0), (None, 1.0), (None, 1.0)]
    assert left[2] == [(1, 50.0), (1, 50.0), (None, 41.0), (None, 41.0)]
    assert left[None] == [(1, 1.0), (1, 1.0), (2, 41.0), (None, 0.0)]
