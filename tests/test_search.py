"""Neighbour and similarity search against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.operators import kernels as K
from scriptorium.operators import similarity as J
from scriptorium.operators.embed import embed, failure_report, hashing_encoder, verify
from scriptorium.operators.knn import knn_join, left_out, majority_label
from scriptorium.plans.checking import verify_scenes


def vectors(n, dim, seed, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).round(3)
    v[: copies] = v[0]
    return v


def brute(q, c, k, own=None):
    out = {}
    for i, x in enumerate(q):
        d = [(round(float(((x - y) ** 2).sum()), 9), j) for j, y in enumerate(c) if own is None or own[i] != j]
        out[i] = [j for _, j in sorted(d)[:k]]
    return out


def frame(spark, v, key):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], f"{key} long, vector array<double>")


def found(df, key="q"):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r[key], r["rank"])):
        out.setdefault(r[key], []).append(r["neighbour"])
    return out


@pytest.mark.parametrize("bound", [1 << 27, 0])
@pytest.mark.parametrize("k", [1, 4])
def test_knn(spark, bound, k):
    """A third of the catalogue are copies of one vector."""
    c, q = vectors(300, 6, 1, copies=100), vectors(90, 6, 2)
    q[0], q[1] = c[0], c[200]
    got = found(knn_join(frame(spark, q, "q"), frame(spark, c, "item_id"), k, max_broadcast_bytes=bound, shard_bytes=3000))
    assert got == brute(q, c, k)


@pytest.mark.parametrize("bound", [1 << 27, 0])
def test_knn_of_itself(spark, bound):
    c = vectors(150, 5, 3, copies=40)
    df = frame(spark, c, "q")
    got = found(knn_join(df, df.withColumnRenamed("q", "item_id"), 3, exclude="q", max_broadcast_bytes=bound, shard_bytes=1500))
    assert got == brute(c, c, 3, own=range(150))


@pytest.mark.parametrize("bound", [1 << 27, 0])
def test_knn_edge_rows(spark, bound):
    c = spark.createDataFrame([("b", [0.0, 1.0]), ("a", [0.0, 1.0]), ("bad", [1.0]), ("none", None), ("nan", [float("nan"), 0.0])],
                              "item_id string, vector array<double>")
    q = spark.createDataFrame([(1, "x", [0.0, 0.0]), (2, "y", None), (3, "z", []), (4, "w", [1.0, None])], "id int, s string, vector array<double>")
    got = [tuple(r) for r in knn_join(q, c, 5, max_broadcast_bytes=bound).orderBy("rank").collect()]
    assert got == [(1, "x", "a", 1.0, 1), (1, "x", "b", 1.0, 2)]
    assert knn_join(q, c.where("false"), 5, max_broadcast_bytes=bound).count() == 0


@pytest.mark.parametrize("bound", [1 << 27, 0])
def test_knn_odd_rows_cost_only_themselves(spark, bound):
    """One overlong or infinite row of the catalogue takes nothing from the others."""
    inf = float("inf")
    c = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [1.0, 1.0]), ("long", [0.0, 0.0, 0.0]), ("inf", [inf, 0.0])], "item_id string, vector array<double>")
    q = spark.createDataFrame([(1, [0.0, 0.0]), (2, [-inf, 0.0])], "q int, vector array<double>")
    got = [tuple(r) for r in knn_join(q, c, 5, max_broadcast_bytes=bound, shard_bytes=40).orderBy("rank").collect()]
    assert got == [(1, "a", 1.0, 1), (1, "b", 2.0, 2)]
    assert sorted(map(tuple, left_out(c, 2).collect())) == [("inf", "values"), ("long", "length")]
    wide = knn_join(q.select("q", F.lit(None).cast("array<double>").alias("vector")), c, 2, dim=3, max_broadcast_bytes=bound)
    assert wide.count() == 0


@pytest.mark.parametrize("bound", [1 << 27, 0])
def test_knn_wide_vectors(spark, bound):
    c = vectors(80, 768, 9, copies=10)
    q = vectors(20, 768, 10)
    assert found(knn_join(frame(spark, q, "q"), frame(spark, c, "item_id"), 3, max_broadcast_bytes=bound, shard_bytes=100_000)) == brute(q, c, 3)


def test_nearest_in_small_chunks(monkeypatch):
    monkeypatch.setattr(K, "_Q_CHUNK", 7)
    monkeypatch.setattr(K, "_C_CHUNK", 11)
    q, c = vectors(40, 4, 5), vectors(100, 4, 6, copies=30)
    rows, cols, _, rank = K.nearest(q, c, 3)
    assert {i: list(cols[rows == i]) for i in range(40)} == brute(q, c, 3)
    assert list(rank[:3]) == [1, 2, 3]


def test_majority_label(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (1, 3), (1, 5), (2, 9)], "q int, label int")
    assert sorted(map(tuple, majority_label(df, ["q"], "label").collect())) == [(1, 3, 2), (2, 9, 1)]


def best_by_hand(sets):
    out = {}
    for a in sets:
        scored = [(-(len(sets[a] & sets[b]) / len(sets[a] | sets[b]) if sets[a] | sets[b] else 0.0), b) for b in sets if b != a]
        out[a] = (min(scored)[1], -min(scored)[0]) if scored else (None, 0.0)
    return out


def random_sets(n, seed):
    """Many copies, an item a third of all keys hold, frequent and rare items, empty sets."""
    rng = np.random.default_rng(seed)
    sets = {}
    for i in range(n):
        kind = rng.integers(6)
        if kind == 0:
            sets[i] = set()
        elif kind < 3:
            sets[i] = {"hot", "warm"} | ({f"w{rng.integers(4)}"} if kind == 2 else set())
        else:
            sets[i] = {f"r{x}" for x in rng.integers(0, n, rng.integers(1, 8))} | ({"hot"} if rng.random() < 0.5 else set())
    return sets


@pytest.mark.parametrize("rare", [0, 3, 1000])
@pytest.mark.parametrize("bound, masks, rising", [(1 << 26, 0, False), (0, 0, False), (0, 0, True), (0, 8, True)])
def test_best_matches(spark, rare, bound, masks, rising):
    sets = random_sets(160, rare)
    items = spark.createDataFrame([(k, i) for k, s in sets.items() for i in s] * 2, "k long, i string")
    keys = spark.createDataFrame([(k,) for k in sets], "k long")
    got = J.best_matches(items, "k", "i", keys, rare=rare, max_broadcast_bytes=bound, block_rows=16, masks=masks, rising=rising)
    assert {r["k"]: (r["match"], r["score"]) for r in got.collect()} == best_by_hand(sets)


def test_rising_bound_saves_work(spark):
    """Sets of a shared template and a few of their own: four times the keys take far less than sixteen times the comparisons."""
    def run(n):
        rng = np.random.default_rng(n)
        sets = {k: {f"t{k % (n // 5)}.{x}" for x in rng.choice(12, 9, replace=False)} | {f"all{x}" for x in rng.choice(30, rng.integers(0, 4), replace=False)} for k in range(n)}
        items, work = spark.createDataFrame([(k, i) for k, s in sets.items() for i in s], "k long, i string"), []
        got = {r["k"]: (r["match"], r["score"]) for r in J.best_matches(items, "k", "i", rare=2, max_broadcast_bytes=0, work=work).collect()}
        assert got == best_by_hand(sets)
        return sum(work)

    small, large = run(200), run(800)
    assert 0 < large < 10 * small and large < 0.5 * 800 * 800


def test_best_matches_of_few(spark):
    def run(rows):
        return [tuple(r) for r in J.best_matches(spark.createDataFrame(rows, "k string, i string"), "k", "i").collect()]

    assert run([("a", "x")]) == [("a", None, 0.0)]
    assert sorted(run([("a", "x"), ("b", "y")])) == [("a", "b", 0.0), ("b", "a", 0.0)]


def test_overlap_kernel_both_ways(monkeypatch):
    """The matrix product and the meeting of sparse items count the same."""
    rng = np.random.default_rng(9)
    q = (rng.integers(0, 20, 60), rng.integers(0, 50, 60))
    c = (rng.integers(0, 30, 90), rng.integers(0, 50, 90))
    q, c = (np.unique(np.array(x), axis=1) for x in (q, c))
    want = np.zeros((20, 30))
    for a, i in q.T:
        for b, j in c.T:
            want[a, b] += i == j
    assert (K._shared(tuple(q), 20, tuple(c), 30, 50) == want).all()
    dense = tuple(np.nonzero(np.ones((20, 50))))
    assert (K._shared(dense, 20, dense, 20, 50) == 50).all()


def test_one_against_all(spark):
    sets = random_sets(60, 4)
    sets[3] = {"hot", "warm", "r1"}
    items = spark.createDataFrame([(k, i) for k, s in sets.items() for i in s], "k long, i string")
    keys = spark.createDataFrame([(k,) for k in sets], "k long")
    scores = {r["k"]: r["score"] for r in J.similarity_to_one(items, "k", "i", 3, keys).collect()}
    assert scores == {k: len(s & sets[3]) / len(s | sets[3]) for k, s in sets.items() if k != 3}
    joined = {r["k"]: r["score"] for r in J.similarity_to_one(items, "k", "i", 3, keys, max_broadcast_bytes=0).collect()}
    assert joined == scores
    assert tuple(J.most_similar_to(items, "k", "i", 3, keys).first()) == best_by_hand(sets)[3]


def test_hashing_encoder():
    encode = hashing_encoder(16)()
    a, b, empty = encode(pa.array(["Word word other", "other\u00a0WORD \n\x1cword ", " "]))
    assert (a == b).all() and (empty == 0).all() and a.shape == (16,)
    assert abs(np.sqrt((a ** 2).sum()) - 1000) < 2


def test_embed_survives_bad_rows(spark):
    def make():
        def encode(texts):
            texts = texts.to_pylist()
            if any("bad" in t for t in texts):
                raise ValueError("no")
            return np.array([[len(t), 1.0] for t in texts])
        return encode

    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, None)], "id int, t string")
    got = {r["id"]: r["vector"] for r in embed(df, "t", make).collect()}
    assert got == {1: [3.0, 1.0], 2: None, 3: [0.0, 1.0]}


def test_failures_are_reported(spark):
    def make():
        def model(prompts):
            if any(p.startswith("bad") for p in prompts):
                raise ValueError("no")
            return [p.upper() for p in prompts]
        return model

    df = spark.createDataFrame([(p,) for p in ["ok", "bad 1", "fine", "bad 2", "good"]], "p string").coalesce(1)
    got = verify(df, "p", make, error="error").cache()
    assert {r["p"]: r["response"] for r in got.collect()} == {"ok": "OK", "bad 1": None, "fine": "FINE", "bad 2": None, "good": "GOOD"}
    assert [tuple(r) for r in failure_report(got).collect()] == [("ValueError: no", 2)]
    many = spark.range(12).select(F.concat(F.lit("bad "), "id").alias("p")).coalesce(1)
    with pytest.raises(Exception, match="failed on all"):
        verify(many, "p", make).collect()
    with pytest.raises(Exception, match="failed on all"):
        embed(many, "p", lambda: lambda texts: 1 / 0).collect()


def test_verify_scenes(spark):
    answers = {"INT. A": '{"tropes": ["A", "Z"], "examples": []}', "EXT. B": "", "INT. C": "not json"}

    def make():
        return lambda prompts: [next(answers[k] for k in answers if k in p) for p in prompts]

    df = spark.createDataFrame([(k, ["A", "B"]) for k in answers] + [("INT. D", [])], "scene string, names array<string>").coalesce(1)
    got = {r["scene"]: (r["confirmed"], r["score"], r["error"]) for r in verify_scenes(df, "scene", "names", make).collect()}
    assert got == {"INT. A": (["A", "Z"], 1.0, None), "EXT. B": ([], 0.0, None), "INT. C": ([], 0.0, None), "INT. D": ([], 0.0, "StopIteration: ")}


def test_unknown_reference(spark):
    items = spark.createDataFrame([("a", 1), ("b", 1)], "k string, i int")
    with pytest.raises(ValueError, match="no set named"):
        J.similarity_to_one(items, "k", "i", "z")
    keys = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    assert J.similarity_to_one(items, "k", "i", "z", keys).count() == 2
