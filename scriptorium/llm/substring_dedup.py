"""Word windows that an earlier document also has, by a count-min prefilter and an exact second pass.

1. Whole texts equal to that of a smaller id are set aside: all their words go (if they hold a window at all).
2. Tasks count, in a sketch of two rows, the documents each window's anchor is in (``anchors``); the merged sketch overestimates.
3. Windows estimated to be in one document are done with. Of the others, those that a smaller id in the same batch also has are marked
   at once, so a passage of very many documents sends about one record per batch. The rest is grouped exactly, by anchor
   and window hash (128 bits together), in order of ids: a window is marked if a smaller id came before.

Windows never cross documents, and are judged on the input. Null ids and texts of fewer words than a window have nothing
removed and remove nothing; rows of one id never remove from each other. A null text has no words.
Very long texts are read in blocks with an overlap. Equal windows keep the smallest id. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scriptorium.llm.anchors import RepeatSketch, Windows, copies, Without, covered, first_of_equal, keyed, marked, remove, runs, sketch_log2
from scriptorium.llm.common import Hashes, grams, slices, store

KIND = Windows(length=13, k=7, words=True)
#: Windows compared within a task before they are sent.
AT_ONCE = 400_000

_OPEN = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("hashes", pa.binary())])
_OPEN_SQL = "anchor long, doc_id long, digest long, start int, count int, hashes binary"
_FLAG_SQL = "doc_id long, digest long, start int, count int"


def _windows(batch, kind, sketch, hashes):
    """The windows of a batch that may be repeated, some hundred thousand at once: anchor, window hash, row, start, record."""
    found, base, records, size = [], 0, 0, 0
    for ids, texts in slices(batch, 2 << 20):
        for own, offsets, at, h, _ in kind.blocks(texts, hashes):
            part, first, count, _, anchor = kind.records(at, h)
            keep = sketch.repeated(anchor)
            if keep.any():
                part, first, count, anchor = part[keep], first[keep], count[keep], anchor[keep]
                each = np.repeat(np.arange(len(first)), count)
                at_window = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                found.append((anchor[each], grams(h, kind.length)[at_window], own[part][each] + base, at_window - at[part][each] + offsets[part][each], each + records))
                records += len(first)
                size += len(each)
        base += len(ids)
        if size > AT_ONCE:
            yield [np.concatenate(x) for x in zip(*found)]
            found, size = [], 0
    if found:
        yield [np.concatenate(x) for x in zip(*found)]


def _collect(kind, shared):
    def run(batches):
        hashes = Hashes()
        for batch in batches:
            ids, digests = batch.column("doc_id").to_numpy(), batch.column("digest").to_numpy()
            for anchor, window, row, start, record in _windows(batch, kind, shared.value, hashes):
                doc, digest = ids[row], digests[row]
                settled = doc > first_of_equal([window, anchor], doc)
                for open_ in (False, True):
                    which = settled != open_
                    a, w, d, g, s, r = (x[which] for x in (anchor, window, doc, digest, start, record))
                    first, count = runs(r, s)
                    if len(first):
                        raw = w.tobytes()
                        yield pa.RecordBatch.from_arrays([
                            pa.array(a[first].view(np.int64) if open_ else [None] * len(first), pa.int64()), pa.array(d[first]), pa.array(g[first]),
                            pa.array(s[first].astype(np.int32)), pa.array(count.astype(np.int32)),
                            pa.array([raw[8 * i:8 * (i + n)] for i, n in zip(first.tolist(), count.tolist())] if open_ else [None] * len(first), pa.binary())], schema=_OPEN)
    return run


def _resolve(batches):
    """Rows come by anchor and id; ``last`` holds what the anchor under way had in earlier batches: window hashes and first ids."""
    last = None
    flags = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("start", pa.int32()), ("count", pa.int32())])
    for b in batches:
        if not b.num_rows:
            continue
        anchor, doc, digest = (b.column(i).to_numpy() for i in range(3))
        start, count = b.column("start").to_numpy().astype(np.int64), b.column("count").to_numpy().astype(np.int64)
        window = np.frombuffer(b"".join(b.column("hashes").to_pylist()), np.uint64)
        row = np.repeat(np.arange(len(anchor)), count)
        at = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        a, d, w = anchor[row], doc[row], window
        if last is not None and last[0] == anchor[0]:
            a, d, w = np.concatenate([np.full(len(last[1]), last[0]), a]), np.concatenate([last[2], d]), np.concatenate([last[1], w])
        low = first_of_equal([a, w], d)
        same = a == anchor[-1]
        seen, i = np.unique(w[same], return_index=True)
        last = anchor[-1], seen, low[same][i]
        mark = (d > low)[len(d) - len(row):]
        row, at = row[mark], at[mark]
        first, n = runs(row, at)
        if len(first):
            yield pa.RecordBatch.from_arrays([pa.array(doc[row[first]]), pa.array(digest[row[first]]), pa.array(at[first].astype(np.int32)), pa.array(n.astype(np.int32))], schema=flags)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _cut(length: int, texts: bool):
    def run(batches):
        for b in batches:
            out = []
            for t, *mark in zip(b.column("text").cast(pa.binary()).to_pylist(), *(b.column(c).to_pylist() for c in ("whole", "starts", "counts"))):
                words = (t or b"").split()
                gone = covered(len(words), length, *mark)
                kept = b" ".join(words if gone is None else compress(words, ~gone))
                out.append((len(words), 0 if gone is None else int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept if texts else None))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([o[i] for o in out], f.type) for i, f in enumerate(list(_RESULT)[1:]))], schema=_RESULT)
    return run


def repeated_windows(docs: DataFrame, kind: Windows = KIND) -> DataFrame:
    """The marks of ``anchors.marked`` for documents with ``doc_id``, ``text``, ``digest``."""
    spark = docs.sparkSession
    same = store(copies(docs), "copies")
    texts = Without(docs, same)
    sketch = spark.sparkContext.broadcast(RepeatSketch.of(texts, kind, sketch_log2(docs, kind)))
    found = store(texts.map(_collect(kind, sketch), _OPEN_SQL), "windows")
    sketch.unpersist()
    todo = found.where("anchor is not null").repartition("anchor").sortWithinPartitions("anchor", "doc_id")
    flags = todo.mapInArrow(_resolve, _FLAG_SQL).unionByName(found.where("anchor is null").select("doc_id", "digest", "start", "count"))
    return marked(flags, same)


def remove_repeats(docs: DataFrame, kind: Windows = KIND, texts: bool = True) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, with ``texts``, the words ``kept``, joined by blanks."""
    docs = keyed(docs)
    out = remove(docs, repeated_windows(docs, kind), _cut(kind.length, texts), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out if texts else out.drop("kept")
