"""Repeated windows of a fixed length, narrowed down before anything large is shuffled.

A window's *anchor* is the run of ``k`` elements inside it with the smallest hash, so equal windows have equal anchors at
equal places, and neighbouring windows mostly share theirs: one record stands for all of them. A sketch counts anchors over all
documents; a window cannot occur more often than its anchor, so windows whose anchor is estimated to be in one document only are
done with. The sketch never estimates too low, hence no repeat is lost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import ODD, Hashes, IdFilter, bounds, grams, may_be_in, mix, skipping, slices, small_batches, store, two_columns

#: Most elements hashed at once; longer texts are cut with an overlap.
BLOCK = 1 << 18
#: Cells of a row of the sketch that are merged together, as a power of two.
PART_LOG2 = 22
BYTE_HASH = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ODD)


@dataclass(frozen=True)
class Windows:
    """What a window is: ``length`` elements, bytes or words, found by anchors of ``k`` elements."""

    length: int
    k: int
    words: bool

    def blocks(self, texts: list[bytes], hashes: Hashes):
        """Element hashes of some texts: text numbers, their offsets in the text, ends in the block, hashes, and the elements."""
        own, offsets, parts, size = [], [], [], 0
        for i, t in enumerate(texts):
            if len(t) < self.length:
                continue
            items = t.split() if self.words else t
            for a in range(0, max(1, len(items) - self.length + 1), BLOCK):
                part = items[a:a + BLOCK + self.length - 1] if len(items) > BLOCK else items
                if size and size + len(part) > BLOCK:
                    yield self._block(own, offsets, parts, hashes)
                    own, offsets, parts, size = [], [], [], 0
                own.append(i)
                offsets.append(a)
                parts.append(part)
                size += len(part)
        if size:
            yield self._block(own, offsets, parts, hashes)

    def _block(self, own, offsets, parts, hashes):
        at = bounds([len(p) for p in parts])
        if self.words:
            h = hashes.of([w for p in parts for w in p])
            data = None
        else:
            data = np.frombuffer(b"".join(parts), np.uint8)
            h = BYTE_HASH[data]
        return np.array(own), np.array(offsets), at, h, data

    def records(self, at: np.ndarray, h: np.ndarray):
        """Runs of windows with the same anchor: part, first window, number of windows, anchor's place, anchor's hash."""
        n, wide = len(h), self.length - self.k + 1
        if n < self.length:
            empty = np.empty(0, np.int64)
            return empty, empty, empty, empty, np.empty(0, np.uint64)
        g = grams(h, self.k)
        low = np.uint64((1 << max(1, n.bit_length())) - 1)
        best = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        done = 1
        while done * 2 <= wide:
            best = np.minimum(best[:-done], best[done:])
            done *= 2
        if done < wide:
            best = np.minimum(best[:len(best) - (wide - done)], best[wide - done:])
        place = (best & low).astype(np.int64)
        part = np.repeat(np.arange(len(at) - 1), np.diff(at))
        here = np.flatnonzero(part[:len(place)] == part[self.length - 1:])
        p = place[here]
        if not len(here):
            return here, here, here, here, np.empty(0, np.uint64)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(here) != 1) | (np.diff(p) != 0)]))
        count = np.diff(np.append(new, len(here)))
        return part[here[new]], here[new], count, p[new], g[p[new]]


class RepeatSketch:
    """Two rows of cells: whether the anchors that fall there are in two documents or more."""

    def __init__(self, bits: np.ndarray, log2: int):
        self.bits, self.log2 = bits, log2

    @staticmethod
    def cells(anchors: np.ndarray, log2: int) -> list[np.ndarray]:
        shift = np.uint64(64 - log2)
        return [mix(anchors + ODD) >> shift, mix(anchors ^ ODD) >> shift]

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        out = np.ones(len(anchors), bool)
        for row, c in enumerate(self.cells(anchors, self.log2)):
            out &= (self.bits[row, (c >> np.uint64(3)).astype(np.int64)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    @classmethod
    def of(cls, docs: Without, kind: Windows, log2: int) -> "RepeatSketch":
        """Tasks send the cells they met, sorted and packed; the merged sketch has ``2 * 2**log2`` bits."""
        parts = 1 << (log2 - PART_LOG2)
        schema = "line int, part int, seen binary, twice binary"
        arrow = pa.schema([("line", pa.int32()), ("part", pa.int32()), ("seen", pa.binary()), ("twice", pa.binary())])

        def pack(cells: np.ndarray) -> bytes:
            return zstandard.ZstdCompressor(level=1).compress(np.diff(cells.astype(np.uint32), prepend=np.uint32(0)).tobytes())

        def unpack(raw: bytes) -> np.ndarray:
            return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint32), dtype=np.uint32)

        def send(anchors: list[np.ndarray]):
            if not anchors:
                return
            every = np.concatenate(anchors)
            for line, c in enumerate(cls.cells(every, log2)):
                cells, n = np.unique(c, return_counts=True)
                cut = np.searchsorted(cells, np.arange(parts + 1, dtype=np.uint64) << np.uint64(PART_LOG2))
                own = [p for p in range(parts) if cut[p] < cut[p + 1]]
                base = [np.uint64(p << PART_LOG2) for p in range(parts)]
                seen = [pack(cells[cut[p]:cut[p + 1]] - base[p]) for p in own]
                twice = [pack((cells[cut[p]:cut[p + 1]] - base[p])[n[cut[p]:cut[p + 1]] > 1]) for p in own]
                yield pa.RecordBatch.from_arrays([pa.array([line] * len(own), pa.int32()), pa.array(own, pa.int32()), pa.array(seen, pa.binary()), pa.array(twice, pa.binary())], schema=arrow)

        def count(batches):
            hashes, kept, size = Hashes(), [], 0
            for batch in batches:
                for _, texts in slices(batch, 2 << 20):
                    for own, _, at, h, _ in kind.blocks(texts, hashes):
                        part, _, _, _, anchor = kind.records(at, h)
                        if len(anchor):
                            doc = own[part]
                            order = np.lexsort((anchor, doc))
                            anchor, doc = anchor[order], doc[order]
                            new = np.ones(len(anchor), bool)
                            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                            kept.append(anchor[new])
                            size += int(new.sum())
                    if size > 2_000_000:
                        yield from send(kept)
                        kept, size = [], 0
            yield from send(kept)

        def merge(batches):
            state: dict[tuple[int, int], list[np.ndarray]] = {}
            for b in batches:
                for line, p, seen, twice in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if (line, p) not in state:
                        state[line, p] = [np.zeros(1 << PART_LOG2, bool), np.zeros(1 << PART_LOG2, bool)]
                    before, more = state[line, p]
                    cells = unpack(seen)
                    more[cells] |= before[cells]
                    before[cells] = True
                    more[unpack(twice)] = True
            for (line, p), (_, more) in state.items():
                yield pa.RecordBatch.from_arrays([pa.array([line], pa.int32()), pa.array([p], pa.int32()), pa.array([np.packbits(more, bitorder="little").tobytes()], pa.binary()), pa.array([None], pa.binary())], schema=arrow)

        rows = docs.map(count, schema).repartition(2 * parts, "line", "part").mapInArrow(merge, schema)
        bits = np.zeros((2, 1 << (log2 - 3)), np.uint8)
        size = 1 << (PART_LOG2 - 3)
        with small_batches(rows.sparkSession):
            for r in rows.toLocalIterator():
                bits[r.line, r.part * size:(r.part + 1) * size] = np.frombuffer(r.seen, np.uint8)
        return cls(bits, log2)


def sketch_log2(docs: DataFrame, kind: Windows, most: int = 28) -> int:
    """At least three cells an anchor, within ``most``: a fuller sketch is still right, it only keeps more windows for the exact step."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = size / (6 if kind.words else 1) * 2 / (kind.length - kind.k + 2)
    return min(most, max(PART_LOG2, math.ceil(math.log2(max(1, 3 * anchors)))))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and a digest; id and digest together tell rows of one id apart."""
    return two_columns(docs).withColumn("digest", F.xxhash64("text"))


def copies(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``digest`` of rows whose whole text is also that of a smaller id."""
    ids = docs.select("doc_id", "digest", F.md5("text").alias("same")).where("doc_id is not null")
    low = ids.groupBy("same").agg(F.min("doc_id").alias("low"))
    return ids.join(low, "same").where("doc_id > low").select("doc_id", "digest").distinct()


class Without:
    """The rows of ``docs`` (with an id) that are not in ``marks`` (``doc_id``, ``digest``), for functions on Arrow batches.

    Rows that the filter of marked ids rules out are not shuffled; the others are joined with the marks and stored.
    """

    def __init__(self, docs: DataFrame, marks: DataFrame):
        self.docs = docs.select("doc_id", "digest", "text")
        self.ids = docs.sparkSession.sparkContext.broadcast(IdFilter.of(marks.select("doc_id")))
        maybe = self.docs.where("doc_id is not null").where(may_be_in(self.ids, "doc_id"))
        self.rest = store(maybe.join(marks, ["doc_id", "digest"], "left_anti").select("doc_id", "digest", "text"), "rest")

    def map(self, run, schema: str) -> DataFrame:
        return self.docs.mapInArrow(skipping(self.ids, run), schema).unionByName(self.rest.mapInArrow(run, schema))


def first_of_equal(keys: list[np.ndarray], docs: np.ndarray) -> np.ndarray:
    """For each row the smallest ``docs`` among rows with equal ``keys``."""
    order = np.lexsort((docs, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    start = np.flatnonzero(new)
    low = np.empty(len(docs), docs.dtype)
    low[order] = np.repeat(docs[order][start], np.diff(np.append(start, len(order))))
    return low


def runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs in which the last column goes up by one and the others stay."""
    n = len(columns[-1])
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.diff(columns[-1]) != 1
    for c in columns[:-1]:
        new[1:] |= c[1:] != c[:-1]
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, n))


def marked(flags: DataFrame, whole: DataFrame) -> DataFrame:
    """One row per text with something to remove: runs of windows as ``starts`` and ``counts``; ``whole`` texts have a true ``whole``."""
    some = flags.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "count")).alias("r")).select(
        "doc_id", "digest", F.lit(False).alias("whole"), F.col("r.start").alias("starts"), F.col("r.count").alias("counts"))
    none = F.array().cast("array<int>")
    return store(some.unionByName(whole.select("doc_id", "digest", F.lit(True).alias("whole"), none.alias("starts"), none.alias("counts"))), "marks")


def remove(docs: DataFrame, marks: DataFrame, cut, schema: str) -> DataFrame:
    """Apply ``cut(batches)`` to all rows with their marks; rows without any are not shuffled."""
    ids = docs.sparkSession.sparkContext.broadcast(IdFilter.of(marks.select("doc_id")))
    none = F.lit(None)
    plain = docs.select("doc_id", "text", none.cast("boolean").alias("whole"), none.cast("array<int>").alias("starts"), none.cast("array<int>").alias("counts"))
    rest = docs.where(may_be_in(ids, "doc_id")).join(marks, ["doc_id", "digest"], "left").select("doc_id", "text", "whole", "starts", "counts")
    nameless = plain.where("doc_id is null")
    return plain.mapInArrow(skipping(ids, cut), schema).unionByName(rest.unionByName(nameless).mapInArrow(cut, schema))


def covered(size: int, length: int, whole, starts, counts) -> np.ndarray | None:
    """Which of ``size`` elements lie in a marked window; None if none does."""
    if whole:
        return np.ones(size, bool) if size >= length else None
    if starts is None or not len(starts):
        return None
    step = np.zeros(size + 1, np.int32)
    s = np.asarray(starts, np.int64)
    np.add.at(step, s, 1)
    np.add.at(step, s + np.asarray(counts, np.int64) + length - 1, -1)
    return np.cumsum(step[:-1]) > 0
