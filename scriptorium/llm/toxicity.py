"""Toxicity by a bidirectional gated recurrent network with attention pooling, over all overlapping windows.

Every word gets an input of a few numbers, from tables of log-odds between toxic and other training documents: of the word, of its
beginnings and of its inner character runs (hashed). The network reads windows of 32 words, every 16 words, in both
directions; attention weighs its states, and a linear unit scores the window. A document has the score of its highest window, put on
the scale of probabilities by a logistic fit.

Labels belong to documents, so training takes from each document the window with the strongest inputs and two others. Inputs of a
training document come from tables counted on the other half of the sample. Words of more than 64 bytes, as in scripts without blanks, are several
inputs. All of it is numpy, on a bounded sample.

A null or empty text is one window without words. Rows are independent. Without labelled rows of both kinds every score is 0.
Very long texts have all their windows scored; null ids are kept. Of labels of one id the larger counts. Equal texts have equal scores. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scriptorium.llm.anchors import BYTE_HASH
from scriptorium.llm.common import ODD, bounds, freeing, grams, mix, slices, store
from scriptorium.llm.labelled import MOST, scored, training_rows

SIZE, STEP, HIDDEN, INPUTS = 32, 16, 8, 6
SLOTS_LOG2 = 18
SLOTS = 1 << SLOTS_LOG2
#: Bytes of a word's beginnings, length of its inner runs, most bytes of a word.
BEGINNINGS, RUN, LONGEST = range(3, 8), 4, 64
#: Rows of a batch that goes back with all columns.
PART = 500
_BLANK = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
#: Words a worker remembers, windows scored at once.
KNOWN, TOGETHER = 300_000, 4096


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of letters and digits (and anything outside ASCII), cut between code points if they are very long."""
    words = text.lower().translate(_BLANK).split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [p for w in words for p in ([w] if len(w) <= LONGEST else _pieces(w))]


def _pieces(word: bytes) -> list[bytes]:
    out, a = [], 0
    while len(word) - a > LONGEST:
        b = a + LONGEST
        while b > a + LONGEST - 3 and word[b] & 0xC0 == 0x80:
            b -= 1
        out.append(word[a:b])
        a = b
    return [*out, word[a:]]


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


def parts_of(words: list[bytes]):
    """Slots of the words, of their beginnings (a list of word numbers and slots), and of their inner runs."""
    size = np.array([len(w) for w in words])
    at = bounds(size)
    h = BYTE_HASH[np.frombuffer(b"".join(words), np.uint8)]
    word = np.zeros(len(words), np.uint64)
    begin = []
    for i in range(int(size.max())):
        on = np.flatnonzero(size > i)
        word[on] = word[on] * ODD + h[at[on] + i]
        if i + 1 in BEGINNINGS:
            begin.append((on, _slot(mix(word[on] ^ np.uint64(0xB)))))
    whole = _slot(mix(word ^ size.astype(np.uint64)))
    run = grams(h, RUN)
    own = np.repeat(np.arange(len(words)), size)
    inside = own[:len(run)] == own[RUN - 1:] if len(run) else np.empty(0, bool)
    return whole, begin, (own[:len(run)][inside], _slot(mix(run[inside])))


def inputs(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """The input of each word; the last number tells a word from padding."""
    whole, begin, (own, run) = parts_of(words)
    x = np.zeros((len(words), INPUTS), np.float32)
    x[:, 0] = table[whole]
    for on, slot in begin:
        v = table[slot]
        x[on, 1] = np.maximum(x[on, 1], v)
        x[on, 2] = np.minimum(x[on, 2], v)
    if len(own):
        v = table[run]
        start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        x[own[start], 3] = np.maximum.reduceat(v, start)
        x[own[start], 4] = np.add.reduceat(v, start) / np.diff(np.append(start, len(own)))
    x[:, 5] = 1
    return x


def log_odds(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """From documents with a feature, by label (rows), and documents in all: what is left after 1.5 standard errors."""
    clean, toxic = (np.log((c + 0.5) / (m + 1)) for c, m in zip(counts, n))
    odds, error = toxic - clean, np.sqrt((1 / (counts + 0.5)).sum(0))
    return (np.sign(odds) * np.clip(np.abs(odds) - 1.5 * error, 0, 6)).astype(np.float32)


class Network:
    """Gates of both directions side by side: update, reset, candidate."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        n = lambda *s: (r.normal(0, 1, s) / np.sqrt(s[-2])).astype(np.float32)
        self.p = {"wx": n(2, INPUTS, 3 * HIDDEN) * 0.7, "u": n(2, HIDDEN, 3 * HIDDEN) * 0.7, "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
                  "att": n(2 * HIDDEN, 1), "out": n(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def forward(self, x: np.ndarray, keep: list | None = None):
        """Logits of windows ``x`` (windows, words, inputs)."""
        p, (m, t, _) = self.p, x.shape
        states = np.empty((t, m, 2 * HIDDEN), np.float32)
        for d in (0, 1):
            h = np.zeros((m, HIDDEN), np.float32)
            pre = (x.reshape(-1, INPUTS) @ p["wx"][d] + p["b"][d]).reshape(m, t, -1).transpose(1, 0, 2)
            for i in range(t) if d == 0 else range(t - 1, -1, -1):
                hu = h @ p["u"][d]
                g = 0.5 * np.tanh(0.5 * (pre[i, :, :2 * HIDDEN] + hu[:, :2 * HIDDEN])) + 0.5
                z, r = g[:, :HIDDEN], g[:, HIDDEN:]
                c = np.tanh(pre[i, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
                if keep is not None:
                    keep.append((d, i, h, z, r, c, hu[:, 2 * HIDDEN:]))
                h = c + z * (h - c)
                states[i, :, d * HIDDEN:(d + 1) * HIDDEN] = h
        e = (states @ p["att"])[..., 0]
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tm,tmh->mh", a, states)
        return (pooled @ p["out"])[:, 0] + p["bias"][0], states, a, pooled

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        keep: list = []
        logit, states, a, pooled = self.forward(x, keep)
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        e = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / weight.sum()
        e = e.astype(np.float32)
        g["bias"][0], g["out"] = e.sum(), pooled.T @ e[:, None]
        d_pooled = e[:, None] * p["out"].T
        d_a = np.einsum("mh,tmh->tm", d_pooled, states)
        d_e = a * (d_a - (a * d_a).sum(0))
        g["att"] = np.einsum("tm,tmh->h", d_e, states)[:, None]
        d_states = a[..., None] * d_pooled + d_e[..., None] * p["att"][:, 0]
        dh = [np.zeros_like(states[0, :, :HIDDEN]), np.zeros_like(states[0, :, :HIDDEN])]
        for d, i, h, z, r, c, hc in reversed(keep):
            own = dh[d] + d_states[i, :, d * HIDDEN:(d + 1) * HIDDEN]
            dz, dc = own * (h - c) * z * (1 - z), own * (1 - z) * (1 - c * c)
            dr = dc * hc * r * (1 - r)
            into = np.concatenate([dz, dr, dc], 1)
            back = np.concatenate([dz, dr, dc * r], 1)
            g["wx"][d] += x[:, i].T @ into
            g["b"][d, 0] += into.sum(0)
            g["u"][d] += h.T @ back
            dh[d] = own * z + back @ p["u"][d].T
        return g, float((weight * np.logaddexp(0, np.where(y > 0, -logit, logit))).sum() / weight.sum())

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 500, batch: int = 192, rate: float = 0.01, seed: int = 3) -> "Network":
        """Adam on the weighted log loss."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        for s in range(1, steps + 1):
            own = rng.integers(0, len(x), batch)
            g, _ = self.gradient(x[own], y[own], weight[own])
            for k, d in g.items():
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                self.p[k] -= (rate * (1 - 0.7 * s / steps) * (m[k] / (1 - 0.9 ** s)) / (np.sqrt(v[k] / (1 - 0.999 ** s)) + 1e-7)).astype(np.float32)
        return self

    def calibrate(self, logit: np.ndarray, y: np.ndarray) -> None:
        """Logistic fit of labels on documents' highest logits, by Newton steps."""
        x, w = np.stack([logit, np.ones_like(logit)], 1), np.array([1.0, 0.0])
        for _ in range(25):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w = w - np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (q - y) + 1e-3 * (w - [1, 0]))
        self.scale, self.shift = float(w[0]), float(w[1])


class Reader:
    """Texts to windows of word inputs; words are remembered in bounded memory."""

    def __init__(self, table: np.ndarray):
        self.table, self.at = table, {}
        self.x = np.zeros((1, INPUTS), np.float32)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        fresh = [w for w in set(words) if w not in self.at]
        if fresh and len(self.at) + len(fresh) > KNOWN:
            self.at, self.x = {}, np.zeros((1, INPUTS), np.float32)
            fresh = list(set(words))
        if fresh:
            base = len(self.x)
            self.at.update(zip(fresh, range(base, base + len(fresh))))
            self.x = np.concatenate([self.x, inputs(fresh, self.table)])
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def windows(self, texts: list[bytes]):
        """Word numbers in windows (0 is padding), and the text of each. All words of a text are in one or two."""
        words = [words_of(t) for t in texts]
        n = np.array([len(w) for w in words])
        at = bounds(n)
        number = np.append(self.numbers([w for t in words for w in t]), 0)
        many = np.maximum(1, -(-(n - SIZE) // STEP) + 1)
        own = np.repeat(np.arange(len(texts)), many)
        first = (np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)) * STEP
        place = first[:, None] + np.arange(SIZE)
        return np.where(place < n[own][:, None], number[np.minimum(at[own][:, None] + place, len(number) - 1)], 0), own


def _counts(batches):
    """Documents with each feature, by half of the sample and label; one row per task and half."""
    total = np.zeros((2, 2, SLOTS), np.int32)
    docs = np.zeros((2, 2), np.int64)
    for b in batches:
        y = b.column("y").to_pylist()
        done = 0
        for ids, texts in slices(b):
            for i, t in zip(ids, texts):
                half, label = i // 4 % 2, int(y[done] > 0)
                done += 1
                docs[half, label] += 1
                words = list(set(words_of(t)))
                if words:
                    whole, begin, (_, run) = parts_of(words)
                    slots = np.unique(np.concatenate([whole, run, *(s for _, s in begin)]))
                    total[half, label, slots] += 1
    for half in (0, 1):
        yield pa.RecordBatch.from_pydict({"half": pa.array([half], pa.int32()), "clean": pa.array([int(docs[half, 0])], pa.int64()),
                                          "toxic": pa.array([int(docs[half, 1])], pa.int64()), "counts": pa.array([total[half].tobytes()])})


def _examples(tables):
    """Three windows of each training document: the strongest, the first and the last. ``x`` holds their inputs."""
    def run(batches):
        readers = [Reader(t) for t in tables.value]
        for b in batches:
            y, done = b.column("y").to_pylist(), 0
            for ids, texts in slices(b):
                for i, t in zip(ids, texts):
                    reader = readers[1 - i // 4 % 2]
                    number, _ = reader.windows([t])
                    x = reader.x[number]
                    best = int(np.maximum(x[:, :, 0], x[:, :, 1]).max(1).argmax())
                    own = x[[best, 0, len(x) - 1]]
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()), "y": pa.array([y[done]], pa.int32()), "x": pa.array([own.astype(np.float32).tobytes()])})
                    done += 1
    return run


def _highest(batches, reader_of, network):
    for b in batches:
        for ids, texts in slices(b, 1 << 20):
            reader = reader_of(ids)
            number, own = reader.windows(texts)
            logit = np.concatenate([network.forward(reader.x[number[a:a + TOGETHER]])[0] for a in range(0, len(number), TOGETHER)])
            yield ids, np.maximum.reduceat(logit, np.searchsorted(own, np.arange(len(ids))))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> tuple[np.ndarray, Network] | None:
    """Table and network from at most ``most`` labelled documents. What comes to the driver has a fixed size for each task or document."""
    spark = docs.sparkSession
    train = store(training_rows(docs, labels, "toxic", most), "train").coalesce(6)
    counts, n = np.zeros((2, 2, SLOTS)), np.zeros((2, 2))
    for r in train.mapInArrow(_counts, "half int, clean long, toxic long, counts binary").toLocalIterator():
        counts[r.half] += np.frombuffer(r.counts, np.int32).reshape(2, SLOTS)
        n[r.half] += (r.clean, r.toxic)
    if not (n.sum(0) > 0).all():
        return None
    tables = spark.sparkContext.broadcast([log_odds(counts[0], n[0]), log_odds(counts[1], n[1])])
    rows = sorted(train.mapInArrow(_examples(tables), "doc_id long, y int, x binary").collect(), key=lambda r: (r.doc_id, r.x))
    x = np.stack([np.frombuffer(r.x, np.float32).reshape(3, SIZE, INPUTS) for r in rows])
    y = np.array([int(r.y > 0) for r in rows], np.float64)
    toxic = y > 0
    examples = np.concatenate([x[:, 0], x[~toxic, 1], x[~toxic, 2]])
    marks = np.concatenate([y, np.zeros(2 * (~toxic).sum())])
    weight = np.where(marks > 0, min(4.0, (marks == 0).sum() / max(1, toxic.sum())), 1.0)
    network = Network().fit(examples, marks, weight)
    logit = np.stack([network.forward(x[:, k])[0] for k in range(3)]).max(0)
    network.calibrate(logit.astype(np.float64), y)
    return log_odds(counts.sum(0), n.sum(0)), network


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: int = MOST) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches):
        if model.value is None:
            for b in batches:
                yield b.column("doc_id").to_pylist(), np.zeros(b.num_rows)
            return
        table, network = model.value
        reader = Reader(table)
        for ids, logit in _highest(batches, lambda _: reader, network):
            yield ids, 1 / (1 + np.exp(-np.clip(network.scale * logit + network.shift, -30, 30)))

    return scored(docs, run, threshold)


def _parts(batch: pa.RecordBatch, keep: pa.Array):
    """The rows to keep in small batches: the caller sets how large batches come in, but what goes back the JVM has to hold once more."""
    for i in range(0, batch.num_rows, PART):
        yield batch.slice(i, PART).filter(keep.slice(i, PART))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below ``threshold``. Nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))

    def run(batches):
        reader = Reader(model.value[0]) if model.value else None
        for b in batches:
            if reader is None:
                yield b
                continue
            network = model.value[1]
            logit = np.concatenate([v for _, v in _highest([b], lambda _: reader, network)] or [np.empty(0)])
            keep = pa.array(1 / (1 + np.exp(-np.clip(network.scale * logit + network.shift, -30, 30))) < threshold)
            yield from _parts(b, keep)

    return docs.mapInArrow(freeing(run), docs.schema)
