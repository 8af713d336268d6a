"""Hard negatives for contrastive training: exact, by lists of candidates that a whole cluster of anchors shares.

Anchors are clustered by direction. For a cluster and a candidate the inner product with any member is at most the product of the
norms with the cosine of (angle to the centre less the cluster's radius): the *angular upper bound*. Candidates are sorted by it once per
cluster; all members walk that list together, in growing steps, and a member leaves as soon as the next bound is below the last score it
still needs, which certifies that nothing behind can enter its result. First the walk looks for positives (same label), then for negatives of
every positive (another label, scores within a band below the positive's).

The candidates stay where they are. Anchors visit them in shards of ``SHARD`` rows, the only thing that is collected and broadcast, and each task
sends its best rows per list only. Of candidates with equal vectors and labels only the smallest ids can be among the first ``k``, so a vector
that a third of all rows share is cut to that many rows before the walk; the result is the same.

Rows without an id, a label or a vector, or with a null component, take no part. Of rows with one id the one with the smallest label, then vector, counts;
repeats count once. Missing components of a shorter vector are zero. Equal scores go to the smaller id. Scores beyond 63 bits raise an error.
An empty table, or one without anchors, gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scriptorium.llm.common import store

#: Anchors of a shard, members a cluster has on average, candidates of a task that are ordered at once.
SHARD, MEMBERS, BLOCK = 1 << 15, 48, 1 << 14
#: Steps of the walk along a list: the first and the largest.
STEP, LONGEST = 256, 4096
FOUND = pa.schema([("anchor_id", pa.int64()), ("given", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])


def matrix(vectors: pa.Array, dim: int = 0) -> np.ndarray:
    """Lists of integers as rows, padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    dim = max(dim, int(n.max(initial=0)))
    if (n == dim).all():
        return values.reshape(len(n), dim)
    out = np.zeros((len(n), dim), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms and unit vectors; a vector of zeros stays zero."""
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(1))
    return norm, x / np.where(norm > 0, norm, 1)[:, None]


def clusters(units: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Cluster numbers by rounds of assignment to the nearest mean direction; deterministic."""
    k = max(1, len(units) // MEMBERS)
    centres = units[np.linspace(0, len(units) - 1, k).astype(int)]
    for _ in range(rounds):
        own = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        norm = np.sqrt((sums * sums).sum(1))
        centres = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1)[:, None], centres)
    return np.argmax(units @ centres.T, axis=1)


class Shard:
    """Anchors in clusters, and the lists that each of them wants: a band of scores, from the same or from other labels."""

    def __init__(self, ids, labels, vectors: np.ndarray, wanted: list[tuple[int, int, int, int]], same: bool, k: int):
        """``wanted`` holds (anchor's row, what is given back with a hit, lowest score, highest score)."""
        self.ids, self.labels, self.x, self.same, self.k = np.asarray(ids, np.int64), np.asarray(labels, np.int64), vectors, same, k
        self.norm, units = directions(vectors)
        own = clusters(units)
        w = np.array(wanted, np.int64).reshape(-1, 4)
        self.parts = []
        for c in np.unique(own):
            rows = np.flatnonzero(own == c)
            centre = units[rows].sum(0)
            centre /= np.sqrt((centre * centre).sum()) or 1
            radius = np.arccos(np.clip(units[rows] @ centre, -1, 1)).max()
            lists = w[np.isin(w[:, 0], rows)]
            if len(lists):
                self.parts.append((rows, centre, radius, lists))


class Walk:
    """One task's walk of a shard's clusters along the blocks of candidates it meets."""

    def __init__(self, shard: Shard):
        self.shard = shard
        empty = np.empty(0, np.int64)
        self.need = [lists[:, 2].copy() for *_, lists in shard.parts]  # the lowest score that can still enter
        self.pool = [(empty, empty, empty) for _ in shard.parts]  # list, score, id
        self.products = 0

    def block(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        s = self.shard
        dim = max(x.shape[1], s.x.shape[1])
        wide = lambda m: m if m.shape[1] == dim else np.pad(m, ((0, 0), (0, dim - m.shape[1])))
        x, anchors = wide(x), wide(s.x)
        norm, units = directions(x)
        top = float(norm.max(initial=0)) * float(s.norm.max(initial=0))
        if top >= 2.0 ** 63:
            raise ValueError("scores do not fit 63 bits")
        kind = np.float64 if top < 2.0 ** 53 else np.int64  # sums of integers below 2**53 are exact in floating point
        x, anchors = x.astype(kind), anchors.astype(kind)
        for c, (rows, centre, radius, lists) in enumerate(s.parts):
            angle = np.arccos(np.clip(units @ np.pad(centre, (0, dim - len(centre))), -1, 1)) - radius - 1e-6
            bound = norm * np.cos(np.maximum(angle, 0))
            order = np.argsort(-bound, kind="stable")
            bound, member = bound[order], np.searchsorted(rows, lists[:, 0])
            size = s.norm[lists[:, 0]]
            at, step = 0, STEP
            while at < len(order):
                alive = np.flatnonzero(bound[at] * size + 1e-9 * top + 0.5 >= self.need[c])
                if not len(alive):
                    break
                some = order[at:at + step]
                live = np.unique(member[alive])
                scores = (anchors[rows[live]] @ x[some].T).astype(np.int64)
                self.products += scores.size
                mine = scores[np.searchsorted(live, member[alive])]
                anchor = lists[alive, 0]
                good = (mine >= self.need[c][alive, None]) & (mine <= lists[alive, 3][:, None]) & (ids[some] != s.ids[anchor][:, None])
                good &= (labels[some] == s.labels[anchor][:, None]) == s.same
                i, j = np.nonzero(good)
                if len(i):
                    self._add(c, alive[i], mine[i, j], ids[some][j])
                at, step = at + step, min(step * 2, LONGEST)

    def _add(self, c: int, own: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        own, score, ids = (np.concatenate([a, b]) for a, b in zip(self.pool[c], (own, score, ids)))
        order = np.lexsort((ids, -score, own))
        own, score, ids = own[order], score[order], ids[order]
        start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        rank = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
        last = rank == self.shard.k - 1
        self.need[c][own[last]] = np.maximum(self.need[c][own[last]], score[last])
        keep = rank < self.shard.k
        self.pool[c] = own[keep], score[keep], ids[keep]

    def found(self):
        for (_, _, _, lists), (own, score, ids) in zip(self.shard.parts, self.pool):
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(self.shard.ids[lists[own, 0]]), pa.array(lists[own, 1]), pa.array(score), pa.array(ids)], schema=FOUND)


def _walk(shard):
    def run(batches):
        walk, have, rows = Walk(shard.value), [], 0

        def take():
            dim = max(m.shape[1] for *_, m in have)
            parts = [np.concatenate(p) for p in zip(*((i, y, np.pad(m, ((0, 0), (0, dim - m.shape[1])))) for i, y, m in have))]
            have.clear()
            for a in range(0, len(parts[0]), BLOCK):
                walk.block(*(p[a:a + BLOCK] for p in parts))

        for b in batches:
            if b.num_rows:
                have.append((b.column("vec_id").to_numpy(), b.column("label").to_numpy(), matrix(b.column("vector"))))
                rows += b.num_rows
            if rows >= BLOCK:
                take()
                rows = 0
        if have:
            take()
        yield from walk.found()
    return run


def _best(candidates: DataFrame, shard: Shard, k: int, name: str) -> DataFrame | None:
    """The first ``k`` of every list of a shard, over all tasks. The shard's broadcast goes as soon as they are stored."""
    if not shard.parts:
        return None
    shared = candidates.sparkSession.sparkContext.broadcast(shard)
    hits = candidates.mapInArrow(_walk(shared), "anchor_id long, given long, score long, vec_id long")
    order = Window.partitionBy("anchor_id", "given").orderBy(F.desc("score"), "vec_id")
    out = store(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name)
    shared.destroy()
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score`` from ``vec_id``, ``label``, ``vector`` (integers).

    A negative's score lies between ``low`` and ``high`` per cent of the positive's.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"))
    v = v.where("vec_id is not null and label is not null and vector is not null").where(F.forall("vector", lambda x: x.isNotNull()))
    v = v.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("m")).select("vec_id", "m.label", "m.vector")
    v = store(v, "vectors")
    # Equal rows are told apart by id only: the first of them stand for all. One more than wanted, as an anchor is not its own positive.
    equal = Window.partitionBy("vector", "label").orderBy("vec_id")
    candidates = store(v.withColumn("__nth", F.row_number().over(equal)).where(F.col("__nth") <= max(positives + 1, negatives)).drop("__nth"), "candidates")
    anchors = v.where(is_anchor)
    shards = max(1, -(-anchors.count() // SHARD))
    out = []
    for s in range(shards):
        table = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(shards)) == s).orderBy("vec_id").toArrow()
        if not table.num_rows:
            continue
        ids, labels, x = table.column("vec_id").to_numpy(), table.column("label").to_numpy(), matrix(table.column("vector"))
        small, large = np.iinfo(np.int64).min // 2, np.iinfo(np.int64).max
        found = _best(candidates, Shard(ids, labels, x, [(i, 0, small, large) for i in range(len(ids))], True, positives), positives, "positives")
        row = {i: n for n, i in enumerate(ids.tolist())}
        given = sorted({(row[r.anchor_id], r.score) for r in found.select("anchor_id", "score").toLocalIterator()})
        bands = [(i, p, -(-low * p // 100), high * p // 100) for i, p in given]
        worse = _best(candidates, Shard(ids, labels, x, [b for b in bands if b[2] <= b[3]], False, negatives), negatives, "negatives")
        if worse is not None:
            first = found.select("anchor_id", F.col("score").alias("given"), F.col("vec_id").alias("positive_id"))
            out.append(worse.join(first, ["anchor_id", "given"]).select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), F.col("given").alias("positive_score"), F.col("score").alias("negative_score")))
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
