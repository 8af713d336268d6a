"""Byte strings that an earlier document also has, by range-partitioned, sorted suffixes.

Suffixes start at anchors (``anchors``): a string of 50 bytes holds one, at the same place in every copy, so it is enough to sort the
suffixes that begin there. A suffix carries up to 30 bytes before it, since the strings it stands for begin there. Whole
texts equal to that of a smaller id, and suffixes whose anchor the sketch knows from one document only, are not sorted.

1. Spark samples the suffixes' leading bytes (then ids, so that one very common suffix is split as well) and partitions them by
   range.
2. A bucket sorts its strings, each turned to begin at the anchor, by multikey quicksort over words of eight bytes: only rows equal so far
   are compared further. Equal neighbours form a run, whose smallest id keeps the string; the others are marked.
3. A run may go on beyond a bucket only if its leading bytes are the first or last of the bucket. The first rows of such runs are
   compared across buckets by a join on the string's hash.

Matches never cross documents, and are judged on the input. Null ids and texts of fewer than 50 bytes have nothing
removed and remove nothing; rows of one id never remove from each other. A null text is empty.
Very long texts are read in blocks with an overlap. Equal strings keep the smallest id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.anchors import RepeatSketch, Windows, copies, Without, covered, first_of_equal, keyed, marked, remove, runs, sketch_log2
from scriptorium.llm.common import Hashes, grams, slices, store

KIND = Windows(length=50, k=20, words=False)
#: Leading bytes the ranges are made of (at most ``k``), strings a bucket should hold, strings turned at once.
LEAD, BUCKET, TURN = 16, 300_000, 20_000
#: Strings compared within a task before they are sent.
AT_ONCE = 600_000

_SUFFIX = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("back", pa.int32()), ("data", pa.binary())])
_SUFFIX_SQL = "doc_id long, digest long, start int, count int, back int, data binary"
_FLAG = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])
_FLAG_SQL = "doc_id long, digest long, start int, count int, h1 long, h2 long"


def _collect(kind: Windows, shared):
    """Suffixes that may repeat; strings a smaller id in the same batch also has are marked at once (``data`` is null)."""
    def run(batches):
        hashes, sketch = Hashes(), shared.value
        for batch in batches:
            ids, digests = batch.column("doc_id").to_numpy(), batch.column("digest").to_numpy()
            parts, base, size = [], 0, 0
            for own_ids, texts in slices(batch, 1 << 20):
                for own, offsets, at, h, data in kind.blocks(texts, hashes):
                    part, first, count, place, anchor = kind.records(at, h)
                    keep = sketch.repeated(anchor)
                    if keep.any():
                        part, first, count, place, anchor = (x[keep] for x in (part, first, count, place, anchor))
                        each = np.repeat(np.arange(len(first)), count)
                        at_window = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                        raw = data.tobytes()
                        parts.append((own[part] + base, first - at[part] + offsets[part], count, place - first, anchor, grams(h, kind.length)[at_window],
                                      [raw[a:a + n + kind.length - 1] for a, n in zip(first.tolist(), count.tolist())]))
                        size += len(each)
                base += len(own_ids)
                if size > AT_ONCE:
                    yield from _send(kind, parts, ids, digests)
                    parts, size = [], 0
            if parts:
                yield from _send(kind, parts, ids, digests)
    return run


def _send(kind: Windows, parts: list, ids: np.ndarray, digests: np.ndarray):
    """Strings that a smaller id among these also has are settled; the suffixes of the others are sent on."""
    row, start, count, back, anchor, window = (np.concatenate([p[i] for p in parts]) for i in range(6))
    data = [x for p in parts for x in p[6]]
    record = np.repeat(np.arange(len(row)), count)
    place = np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count)
    doc = ids[row][record]
    settled = doc > first_of_equal([window, anchor[record]], doc)
    for open_ in (False, True):
        which = settled != open_
        r, p = record[which], place[which]
        begin, n = runs(r, p)
        if not len(begin):
            continue
        r, p = r[begin], p[begin]
        seg = [None] * len(r)
        if open_:
            seg = [data[i][a:a + m + kind.length - 1] for i, a, m in zip(r.tolist(), p.tolist(), n.tolist())]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids[row[r]]), pa.array(digests[row[r]]), pa.array((start[r] + p).astype(np.int32)),
            pa.array(n.astype(np.int32)), pa.array((back[r] - p).astype(np.int32)), pa.array(seg, pa.binary())], schema=_SUFFIX)


def multikey_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by ``columns``, and where a row differs from the one before: each further column sorts only what is still equal."""
    order = np.argsort(columns[0], kind="stable")
    new = np.ones(len(order), bool)
    first = columns[0][order]
    new[1:] = first[1:] != first[:-1]
    for column in columns[1:]:
        group = np.cumsum(new) - 1
        open_ = np.flatnonzero(np.bincount(group)[group] > 1)
        if not len(open_):
            break
        g, key = group[open_], column[order[open_]]
        inner = np.lexsort((key, g))
        order[open_] = order[open_][inner]
        key = key[inner]
        new[open_[1:]] |= (g[1:] != g[:-1]) | (key[1:] != key[:-1])
    return order, new


def turned(data: np.ndarray, at: np.ndarray, back: np.ndarray, length: int) -> list[np.ndarray]:
    """Strings as words of eight bytes, beginning at the anchor and going on from the start; the anchor's place comes third."""
    words = np.empty((-(-length // 8) + 1, len(at)), np.uint64)
    for a in range(0, len(at), TURN):
        b = slice(a, a + TURN)
        place = (back[b, None] + np.arange(length)) % length + at[b, None]
        wide = np.zeros((len(place), -(-length // 8) * 8), np.uint8)
        wide[:, :length] = data[place]
        words[:-1, b] = wide.view(">u8").astype(np.uint64).T
    words[-1] = back
    return [words[0], words[1], words[-1], *words[2:-1]]


def _bucket(kind: Windows):
    def run(batches):
        columns = [[] for _ in range(6)]
        for b in batches:
            for c, column in zip(columns, b.columns):
                c.append(column)
        if not columns[0]:
            return
        whole = pa.Table.from_arrays([pa.chunked_array(c) for c in columns], schema=_SUFFIX)
        doc, digest, start, count, back = (whole.column(i).to_numpy() for i in range(5))
        seg = whole.column("data").to_pylist()
        lead = [x[b:b + LEAD] for x, b in zip(seg, back.tolist())]
        edges = (min(lead), max(lead))
        edge = np.fromiter((x == edges[0] or x == edges[1] for x in lead), bool, len(lead))
        begin = np.cumsum([0] + [len(x) for x in seg])[:-1]
        data = np.frombuffer(b"".join(seg), np.uint8)
        del lead, seg, whole
        record = np.repeat(np.arange(len(doc)), count)
        step = np.arange(len(record)) - np.repeat(np.cumsum(count) - count, count)
        keys = turned(data, begin[record] + step, back[record] - step, kind.length)
        order, new = multikey_order(keys)
        group = np.cumsum(new) - 1
        own = doc[record]
        sorted_doc = own[order]
        low = np.minimum.reduceat(sorted_doc, np.flatnonzero(new))[group]
        mark = np.zeros(len(record), bool)
        mark[order] = sorted_doc > low
        place = start[record] + step
        first, n = runs(record[mark], place[mark])
        r = record[mark][first]
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array(digest[r]), pa.array(place[mark][first].astype(np.int32)), pa.array(n.astype(np.int32)), pa.nulls(len(r), pa.int64()), pa.nulls(len(r), pa.int64())], schema=_FLAG)
        ask = np.flatnonzero(edge[record] & ~mark)
        if len(ask):
            both = np.stack([k[ask] for k in keys], 1)
            h1, h2 = grams(both.ravel(), both.shape[1])[::both.shape[1]], grams(both[:, ::-1].ravel(), both.shape[1])[::both.shape[1]]
            r = record[ask]
            yield pa.RecordBatch.from_arrays([pa.array(doc[r]), pa.array(digest[r]), pa.array(place[ask].astype(np.int32)), pa.array(np.ones(len(r), np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], schema=_FLAG)
    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _cut(length: int, texts: bool):
    def run(batches):
        for b in batches:
            out = []
            for t, *mark in zip(b.column("text").cast(pa.binary()).to_pylist(), *(b.column(c).to_pylist() for c in ("whole", "starts", "counts"))):
                kept, removed, spans = t or b"", 0, 0
                size = len(kept)
                gone = covered(size, length, *mark)
                if gone is not None:
                    kept = np.frombuffer(kept, np.uint8)[~gone].tobytes()
                    removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((size, removed, spans, hashlib.sha256(kept).hexdigest(), kept if texts else None))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([o[i] for o in out], f.type) for i, f in enumerate(list(_RESULT)[1:]))], schema=_RESULT)
    return run


def repeated_strings(docs: DataFrame, kind: Windows = KIND) -> DataFrame:
    """The marks of ``anchors.marked`` for documents with ``doc_id``, ``text``, ``digest``."""
    spark = docs.sparkSession
    same = store(copies(docs), "copies")
    texts = Without(docs, same)
    sketch = spark.sparkContext.broadcast(RepeatSketch.of(texts, kind, sketch_log2(docs, kind)))
    found = store(texts.map(_collect(kind, sketch), _SUFFIX_SQL), "suffixes")
    sketch.unpersist()
    suffixes = found.where("data is not null")
    strings = suffixes.agg(F.sum("count")).first()[0] or 0
    lead = F.substring("data", F.col("back") + 1, F.lit(LEAD))
    sorted_ = suffixes.repartitionByRange(max(1, -(-strings // BUCKET)), lead, "doc_id").mapInArrow(_bucket(kind), _FLAG_SQL)
    sorted_ = store(sorted_, "flags")
    ask = sorted_.where("h1 is not null")
    low = ask.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"))
    across = ask.join(low, ["h1", "h2"]).where("doc_id > low")
    plain = ("doc_id", "digest", "start", "count")
    flags = sorted_.where("h1 is null").select(*plain).unionByName(across.select(*plain)).unionByName(found.where("data is null").select(*plain))
    return marked(flags, same)


def remove_strings(docs: DataFrame, kind: Windows = KIND, texts: bool = True) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (runs removed), ``kept_sha256`` and, with ``texts``, the bytes ``kept``."""
    docs = keyed(docs)
    out = remove(docs, repeated_strings(docs, kind), _cut(kind.length, texts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if texts else out.drop("kept")
