"""Quality by a factorisation machine over hashed words, structure statistics and length.

A document is a sparse vector: its words hashed to slots (damped counts, scaled to length one), statistics of its
structure, and its length. The machine adds a weight per feature and, for each pair of features, the product of their
short vectors; the sum over all pairs is half of (square of sums less sum of squares), linear in the number of features.
It is trained by gradient steps in numpy on a bounded sample of labelled rows.

A null or empty text has no words and all statistics zero, and gets the score of that vector. Rows are independent. Without any
labelled row every score is 0.5.
Very long texts are read whole; null ids are kept. Of labels of one id the larger counts. Equal texts have equal scores. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from scriptorium.llm.common import Hashes, bounds, grams, slices, store
from scriptorium.llm.labelled import MOST, scored, training_rows

SLOTS_LOG2, STATS, RANK = 12, 12, 8
SLOTS = 1 << SLOTS_LOG2
_CLASS = np.zeros((256, 5), np.float32)
for _b in range(256):
    _CLASS[_b] = (65 <= _b <= 90, 48 <= _b <= 57, _b in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", _b == 10, _b > 127)


def features(texts: list[bytes], hashes: Hashes):
    """Sparse rows: ends, slots, values (statistics come as slots from ``SLOTS`` on)."""
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words])
    at, size = bounds(n), np.array([len(t) for t in texts])
    h = hashes.of([w for t in words for w in t])
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), n)
    key, count = np.unique((doc << SLOTS_LOG2) | (h >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64), return_counts=True)
    row, value = key >> SLOTS_LOG2, np.log1p(count).astype(np.float32)
    norm = np.sqrt(np.bincount(row, value * value, len(texts)))
    value = value / np.maximum(norm[row], 1e-9).astype(np.float32)
    data, ends = np.frombuffer(b"".join(texts), np.uint8), bounds(size)
    kinds = np.stack([np.bincount(np.repeat(np.arange(len(texts)), size), _CLASS[data, c], len(texts)) for c in range(5)], 1) / np.maximum(size, 1)[:, None]
    pair = grams(h, 2)
    inside = doc[:len(pair)] == doc[1:] if len(pair) else np.empty(0, bool)
    pairs = np.unique((doc[:len(pair)][inside] << 40) | (pair[inside] >> np.uint64(24)).astype(np.int64)) >> 40
    n1 = np.maximum(n, 1)
    lines = [t.split(b"\n") for t in texts]
    stats = np.column_stack([
        kinds, np.log1p(size) / 10, (size - n) / n1 / 10, np.bincount(row, minlength=len(texts)) / n1,
        np.bincount(pairs, minlength=len(texts)) / n1, [1 - len(set(x)) / len(x) for x in lines], n / np.array([len(x) for x in lines]) / 100, n > 0]).astype(np.float32)
    stats = np.clip(stats, 0, 5)
    rows = np.concatenate([row, np.repeat(np.arange(len(texts)), STATS)])
    order = np.argsort(rows, kind="stable")
    slots = np.concatenate([key & (SLOTS - 1), np.tile(np.arange(SLOTS, SLOTS + STATS), len(texts))])[order]
    values = np.concatenate([value, stats.ravel()])[order]
    return bounds(np.bincount(rows, minlength=len(texts))), slots, values.astype(np.float32)


class Machine:
    def __init__(self, seed: int = 7):
        self.bias = 0.0
        self.w = np.zeros(SLOTS + STATS, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (SLOTS + STATS, RANK)).astype(np.float32)

    def sums(self, at, slots, x):
        """Logits, and the sums of scaled vectors that the gradient needs as well."""
        vx = self.v[slots] * x[:, None]
        s = np.add.reduceat(vx, at[:-1])
        pairs = (s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), at[:-1])
        return self.bias + np.add.reduceat(self.w[slots] * x, at[:-1]) + 0.5 * pairs, s, vx

    def score(self, at, slots, x) -> np.ndarray:
        if len(at) == 1:
            return np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self.sums(at, slots, x)[0], -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 20, rate: float = 0.05, seed: int = 11) -> "Machine":
        """Adagrad on the log loss. Word weights are held back more than those of the statistics."""
        rng = np.random.default_rng(seed)
        gw, gv, gb = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        keep = np.full(len(self.w), 2e-3, np.float32)
        keep[SLOTS:] = 1e-5
        self.bias = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), 64):
                own = [rows[i] for i in order[a:a + 64]]
                at = bounds([len(s) for s, _ in own])
                slots, x = np.concatenate([s for s, _ in own]), np.concatenate([v for _, v in own])
                logit, s, vx = self.sums(at, slots, x)
                e = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[order[a:a + 64]]) / len(own)
                per = np.repeat(e, np.diff(at)).astype(np.float32) * x
                dv = per[:, None] * (np.repeat(s, np.diff(at), axis=0) - vx)
                u, inverse = np.unique(slots, return_inverse=True)
                w = np.bincount(inverse, per) + keep[u] * self.w[u]
                v = np.stack([np.bincount(inverse, dv[:, f]) for f in range(RANK)], 1) + keep[u, None] * self.v[u]
                gw[u] += w * w
                gv[u] += v * v
                gb += e.sum() ** 2
                self.w[u] -= (rate * w / np.sqrt(gw[u])).astype(np.float32)
                self.v[u] -= (0.4 * rate * v / np.sqrt(gv[u])).astype(np.float32)
                self.bias -= rate * e.sum() / gb ** 0.5
        return self


def _vectors(batches):
    import pyarrow as pa

    hashes = Hashes()
    for b in batches:
        y = b.column("y").to_pylist()
        done = 0
        for ids, texts in slices(b):
            at, slots, x = features(texts, hashes)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "y": pa.array(y[done:done + len(ids)], pa.int32()),
                "slots": pa.array([slots[i:j].astype(np.int32).tobytes() for i, j in zip(at, at[1:])]), "x": pa.array([x[i:j].tobytes() for i, j in zip(at, at[1:])])})
            done += len(ids)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Machine | None:
    """A machine from at most ``most`` labelled documents; only their sparse vectors come to the driver."""
    rows = training_rows(docs, labels, "quality", most).mapInArrow(_vectors, "doc_id long, y int, slots binary, x binary")
    rows = sorted(store(rows, "vectors").collect(), key=lambda r: (r.doc_id, r.slots))
    if not rows:
        return None
    return Machine().fit([(np.frombuffer(r.slots, np.int32), np.frombuffer(r.x, np.float32)) for r in rows], np.array([r.y for r in rows], np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = MOST) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    machine = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches):
        hashes, m = Hashes(), machine.value
        for b in batches:
            for ids, texts in slices(b, 2 << 20):
                yield ids, m.score(*features(texts, hashes)) if m else np.full(len(ids), 0.5)

    return scored(docs, run, threshold)
