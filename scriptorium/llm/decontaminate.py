"""Benchmark decontamination: BM25 over test items, with passages of the training texts as queries.

Test items are indexed by shards of a bounded number of words, built one after another and broadcast. A term's weight in an item is its BM25 score
over the item's score against itself, so 1 is a full match and one threshold serves all items. Postings are cut into
blocks of 8 items with their largest weight. Passages are overlapping windows of every text, of a length that fits the item: items are indexed by classes of
length, so a hit depends on no other item. For a batch of passages the bounds are summed term by term:
first over the whole index, then block by block; what cannot reach the threshold is skipped, as in block-max WAND, and the rest is
scored exactly. Every item at or above the threshold is retrieved.

A hit is verified on the words around its passage: at least half of the question's and of the answer's word trigrams
have to be there. The answer is an item's last sentence, or its last quarter if it has only one. Where that is a few words, a passage that lacks them
is a hit too if it has half of the trigrams of the item's last 8 words; these are then its answer overlap.

Result: one row per leaking document and item. Null or empty texts and items leak nothing; repeated rows are judged each by themselves.
Very long texts are read in overlapping passages; null ids are kept, items without an id are not. Equal items are one. An empty table of texts or items gives no hits.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import bounds, freeing, slices, two_columns

K1, B = 1.2, 0.75
BLOCK, SHARD_WORDS, LEAST_PASSAGE = 8, 1_000_000, 64
#: Shorter answers may also be shown by so many last words of the item.
LEAST_ANSWER = 8
#: Bounds of passages by blocks held at once.
CELLS = 1 << 21
_BLANK = bytes(32 if b < 33 or (b < 128 and not chr(b).isalnum()) else b for b in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs without blanks and ASCII punctuation."""
    return text.decode("utf-8", "replace").lower().encode().translate(_BLANK).split()


def trigrams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(3, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    parts = [p for p in _SENTENCE.split(text.strip()) if words_of(p.encode())]
    words = words_of(text.encode())
    last = words_of(parts[-1].encode()) if len(parts) > 1 else words[-max(1, len(words) // 4):]
    return (words[:len(words) - len(last)] or words), last


class Index:
    """Items of one class of length: terms, postings by term with weights, block bounds, and what verification needs."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean: float, passage: int = LEAST_PASSAGE):
        self.ids = np.array([i for i, _ in items], np.int64)
        self.parts = [question_answer(t) for _, t in items]
        words = [words_of(t.encode()) for _, t in items]
        self.parts = [(trigrams(q), trigrams(a), trigrams(w[-LEAST_ANSWER:]) if len(a) < LEAST_ANSWER else set()) for (q, a), w in zip(self.parts, words)]
        self.passage = passage
        self.terms: dict[bytes, int] = {}
        postings: list[tuple[int, int, float]] = []
        for k, own in enumerate(words):
            tf: dict[bytes, int] = {}
            for w in own:
                tf[w] = tf.get(w, 0) + 1
            norm = K1 * (1 - B + B * len(own) / mean)
            weight = {w: np.log(1 + (n_items - df[w.decode()] + 0.5) / (df[w.decode()] + 0.5)) * f * (K1 + 1) / (f + norm) for w, f in tf.items()}
            whole = sum(weight.values())
            postings += [(self.terms.setdefault(w, len(self.terms)), k, x / whole) for w, x in weight.items()]
        postings.sort()
        term, self.item = (np.array([p[i] for p in postings], np.int64) for i in (0, 1))
        self.weight = np.array([p[2] for p in postings], np.float32)
        self.at = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.most = np.maximum.reduceat(self.weight, self.at[:-1])
        key = term * (len(items) // BLOCK + 1) + self.item // BLOCK
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.block, self.block_most = self.item[start] // BLOCK, np.maximum.reduceat(self.weight, start)
        self.block_at = np.searchsorted(term[start], np.arange(len(self.terms) + 1))
        self.block_post = np.append(start, len(term))

    @staticmethod
    def _spread(at: np.ndarray, which: np.ndarray):
        """All entries of the lists ``which``: where they stand, and the list's number in ``which``."""
        n = at[which + 1] - at[which]
        own = np.repeat(np.arange(len(which)), n)
        return np.repeat(at[which] - (np.cumsum(n) - n), n) + np.arange(len(own)), own

    def search(self, passage: np.ndarray, term: np.ndarray, threshold: float):
        """Passages and items at or above the threshold. ``passage`` and ``term`` are pairs sorted by passage, without repeats."""
        start = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        total = np.add.reduceat(self.most[term], start)
        live = np.repeat(total >= threshold - 1e-4, np.diff(np.append(start, len(term))))
        passage, term = passage[live], term[live]
        if not len(term):
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        blocks = int(self.block.max()) + 1
        number = np.cumsum(np.concatenate([[0], passage[1:] != passage[:-1]]))
        kept = []
        some = max(1, CELLS // blocks)  # passages whose bounds are held at once
        for a in range(0, int(number[-1]) + 1, some):
            lo, hi = np.searchsorted(number, [a, a + some])
            entry, own = self._spread(self.block_at, term[lo:hi])
            cell = (number[lo:hi][own] - a) * blocks + self.block[entry]
            keep = (np.bincount(cell, self.block_most[entry]) >= threshold - 1e-4)[cell]
            kept.append((entry[keep], own[keep] + lo))
        entry, own = (np.concatenate(x) for x in zip(*kept))
        post, of = self._spread(self.block_post, entry)
        key, which = np.unique(passage[own][of] * len(self.ids) + self.item[post], return_inverse=True)
        score = np.bincount(which, self.weight[post])
        good = score >= threshold - 1e-6
        return key[good] // len(self.ids), key[good] % len(self.ids), score[good]

    def hits(self, words: list[list[bytes]], threshold: float, overlap: float):
        """``(text, item, score, question overlap, answer overlap)`` of verified hits in the words of some texts, the best passage of each."""
        n = np.array([len(w) for w in words])
        at = bounds(n)
        term = np.fromiter(map(self.terms.get, chain.from_iterable(words), repeat(-1)), np.int64, int(at[-1]))
        step = self.passage // 2
        many = np.maximum(1, -(-n // step) - 1)
        base = bounds(many)
        here = np.flatnonzero(term >= 0)
        if not len(here):
            return []
        own = np.searchsorted(at, here, side="right") - 1
        half = (here - at[own]) // step
        first, second = np.minimum(half, many[own] - 1), half - 1
        passage = np.concatenate([base[own] + first, (base[own] + second)[(second >= 0) & (second != first)]])
        terms = np.concatenate([term[here], term[here][(second >= 0) & (second != first)]])
        # A first bound counts repeated terms every time: what stays below the threshold need not be sorted.
        live = (np.bincount(passage, self.most[terms]) >= threshold - 1e-4)[passage]
        key = np.sort(passage[live] * len(self.terms) + terms[live])
        if not len(key):
            return []
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        passage, item, score = self.search(key // len(self.terms), key % len(self.terms), threshold)
        best: dict[tuple[int, int], tuple] = {}
        for p, k, s in zip(passage.tolist(), item.tolist(), score.tolist()):
            d = int(np.searchsorted(base, p, side="right")) - 1
            a = (p - int(base[d])) * step
            around = trigrams_of_size(words[d][max(0, a - step):a + self.passage + step], self.parts[k])
            q, r, end = (len(x & around) / len(x) if x else 0.0 for x in self.parts[k])
            r = r if r >= overlap else max(r, end)
            if q >= overlap and r >= overlap and s > best.get((d, k), (0,))[0]:
                best[d, k] = (s, q, r)
        return [(d, int(self.ids[k]), *v) for (d, k), v in best.items()]


def passage_of(n_words: int) -> int:
    """Words of the passages that an item of so many words is looked for in: half as many again, rounded up to a class.

    It depends on no other item, nor on the shard.
    """
    size = LEAST_PASSAGE
    while 2 * size < 3 * n_words:
        size *= 2
    return size


def hits_of(indexes: list[Index], texts: list[bytes], threshold: float, overlap: float):
    words = [words_of(t) for t in texts]
    return [hit for index in indexes for hit in index.hits(words, threshold, overlap)]


def trigrams_of_size(words: list[bytes], parts) -> set[tuple[bytes, ...]]:
    """The word runs of a passage, of the lengths that an item's parts are made of."""
    sizes = {len(g) for part in parts for g in part}
    return {tuple(words[i:i + n]) for n in sizes for i in range(len(words) - n + 1)}


_HITS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])

_HITS_SQL = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _scan(shared, threshold: float, overlap: float):
    def run(batches):
        for b in batches:
            for ids, texts in slices(b, 2 << 20):
                found = [(ids[d], *rest) for d, *rest in hits_of(shared.value, texts, threshold, overlap)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], c.type) for i, c in enumerate(_HITS)], schema=_HITS)
    return run


def _words(texts):
    """The words of an item for the shared statistics, as ``words_of`` cuts them."""
    for b in texts:
        rows = [(i, sorted({w.decode("utf-8", "replace") for w in words_of(t.encode())}), len(words_of(t.encode()))) for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist())]
        yield pa.RecordBatch.from_pydict({"item_id": pa.array([r[0] for r in rows], pa.int64()), "terms": pa.array([r[1] for r in rows], pa.list_(pa.string())), "n": pa.array([r[2] for r in rows], pa.int64())})


def shard_indexes(spark, benchmark: DataFrame):
    """The broadcast indexes of each shard, one for each class of lengths; statistics are those of all items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    terms = items.mapInArrow(_words, "item_id long, terms array<string>, n long").where("n > 0")
    n_items, n_words = terms.agg(F.count("*"), F.sum("n")).first()
    df = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    shards = max(1, -(-(n_words or 0) // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("item_id"), F.lit(shards))
    for s in range(shards if n_items else 0):
        own: dict[int, list[tuple[int, str]]] = {}
        for r in items.where(shard == s).orderBy("item_id", "text").collect():
            if n := len(words_of(r.text.encode())):
                own.setdefault(passage_of(n), []).append((r.item_id, r.text))
        if own:
            asked = terms.where(shard == s).select(F.explode("terms").alias("term")).distinct()
            known = {r.term: r.df for r in df.join(asked, "term").collect()}
            yield spark.sparkContext.broadcast([Index(rows, known, n_items, n_words / n_items, passage) for passage, rows in sorted(own.items())])


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.5) -> DataFrame:
    """``doc_id``, ``item_id``, ``score``, ``question_overlap``, ``answer_overlap`` of every verified leak."""
    docs, spark = two_columns(docs), docs.sparkSession
    found = spark.createDataFrame([], _HITS_SQL)
    for index in shard_indexes(spark, benchmark):
        found = found.unionByName(docs.mapInArrow(freeing(_scan(index, threshold, overlap)), _HITS_SQL))
    return found


def drop_leaking(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, overlap: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all columns, that leak no item. Nothing is shuffled."""
    schema = docs.schema
    for index in shard_indexes(docs.sparkSession, benchmark):
        docs = docs.mapInArrow(freeing(_keep(index, threshold, overlap)), schema)
    return docs


def _keep(shared, threshold: float, overlap: float):
    def run(batches):
        for b in batches:
            good, base = np.ones(b.num_rows, bool), 0
            for ids, texts in slices(b, 2 << 20):
                good[[base + d for d, *_ in hits_of(shared.value, texts, threshold, overlap)]] = False
                base += len(ids)
            yield b.filter(pa.array(good))
    return run
