"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line ends, after sentences, and where the bytes before white space, or more rarely before any code point,
hash to a chosen value, so that a change only moves the cuts next to it. What is still longer is cut every 8 words, and then every 64 bytes. The
beginning is cut finer, into pieces of 1, 2, 4, 8 and 16 bytes (to the next code point), so short texts have several. These rules look only at
what stands before, hence a text that is kept up to some place keeps its paragraphs up to there. Each paragraph's 64-bit digest, which includes how many
equal ones stand before it, is added to three cells, which hold a
number, a sum of digests and a sum of checks. Of two versions the sketches are subtracted, what they share cancels out, and
peeling cells with a single digest recovers what only one of them has. If that gets stuck, both are sketched again four times larger, until
it succeeds. The likeness is the number of shared over all paragraphs, 1 for two empty texts.

``fingerprint`` is the sketch of the first size as text, so equal texts have equal ones. Documents are put in order of their ids by ranges; the first
document of a range is also sent to the range before, so every document meets its successor in one task.

Null texts are empty. A null id comes before all others; rows with equal ids follow each other in the order of their texts.
Very long texts are cut into paragraphs whole. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.anchors import BYTE_HASH
from scriptorium.llm.common import ODD, bounds, grams, mix, two_columns

#: Cells of one of the three parts at first, growth on failure, one cut in so many blanks and in so many code points, bytes handled at once.
CELLS, GROWTH, CUT, RARE_CUT, TOGETHER = 8, 4, 16, 64, 1 << 20
#: Longest paragraph in words and in bytes, and where the pieces at the beginning of a text start.
MOST_WORDS, MOST_BYTES, HEAD = 8, 64, (1, 3, 7, 15, 31)
#: Bytes of text a range should hold, and most ranges.
RANGE_BYTES, MOST_RANGES = 16 << 20, 100_000
_SALT = [np.uint64(x) for x in (0x51, 0x9D2C, 0x3F84D5B5)]


def _starts(data: np.ndarray, h: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where paragraphs start, by ``first`` and ``size`` of the texts, none of them empty."""
    n = len(data)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    inner = (data & 0xC0) == 0x80  # not the beginning of a code point
    stop = (data == 46) | (data == 33) | (data == 63)
    cut = np.zeros(n + 1, bool)  # before this byte
    after = np.zeros(n, bool)
    after[1:] = white[1:] & stop[:-1]
    after[first] = False
    cut[1:] = after | (data == 10)
    if n > 8:
        g = grams(h, 8)[:-1]  # the 8 bytes before
        seen = np.arange(8, n) - np.repeat(first, size)[8:] >= 8  # what stands before a text does not count
        cut[9:] |= white[8:] & seen & (g % np.uint64(CUT) == 0)
        cut[8:-1] |= ~inner[8:] & seen & (g % np.uint64(RARE_CUT) == 1)

    def snapped(at: np.ndarray) -> np.ndarray:
        for _ in range(3):
            at = np.where(inner[np.minimum(at, n - 1)], np.minimum(at + 1, n), at)
        return at

    for k in HEAD:
        cut[snapped(first[size > k] + k)] = True
    cut[first] = True
    start = np.flatnonzero(cut[:n])
    end = np.zeros(n, np.int64)  # words that end up to here
    end[1:] = white[1:] & ~white[:-1]
    end[first] = 0
    words = np.cumsum(end)
    before = np.repeat(words[start] - end[start], np.diff(np.append(start, n)))
    cut[1:] |= (end == 1) & (words > before) & ((words - before) % MOST_WORDS == 0)
    start = np.flatnonzero(cut[:n])
    more = (np.diff(np.append(start, n)) - 1) // MOST_BYTES
    step = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
    cut[snapped(np.repeat(start, more) + step * MOST_BYTES)] = True
    return np.flatnonzero(cut[:n])


def paragraphs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Paragraph digests of each text: text numbers and digests, by text; equal paragraphs of a text are told apart by their number."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    size = np.array([len(t) for t in texts])
    at = bounds(size)
    h = BYTE_HASH[data]
    start = _starts(data, h, at[:-1][size > 0], size[size > 0])
    length = np.diff(np.append(start, len(data)))
    power = np.ones(int(length.max()), np.uint64)
    power[1:] = ODD
    power = np.cumprod(power, dtype=np.uint64)
    place = np.arange(len(data)) - np.repeat(start, length)
    digest = mix(np.add.reduceat(h * power[place], start) + length.astype(np.uint64))
    doc = np.searchsorted(at, start, side="right") - 1
    order = np.lexsort((digest, doc))
    doc, digest = doc[order], digest[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1])
    at_new = np.flatnonzero(new)
    number = np.arange(len(doc)) - np.repeat(at_new, np.diff(np.append(at_new, len(doc))))
    return doc, mix(digest + number.astype(np.uint64) * ODD)


def _check(digest: np.ndarray) -> np.ndarray:
    return mix(digest ^ np.uint64(0xC0FFEE)) >> np.uint64(32)


class Sketches:
    """Sketches of many sets side by side: numbers, digest sums and check sums (all modulo 2**64)."""

    def __init__(self, many: int, part: int):
        self.part, self.size = part, 3 * part
        self.number = np.zeros(many * self.size, np.int64)
        self.digests = np.zeros(many * self.size, np.uint64)
        self.checks = np.zeros(many * self.size, np.uint64)

    def add(self, own: np.ndarray, digest: np.ndarray, sign: np.ndarray) -> None:
        """Add (or subtract) digests to the sketches ``own``."""
        s, c = sign.astype(np.int64), _check(digest)
        wide = s.view(np.uint64)
        for j in range(3):
            cell = own * self.size + j * self.part + (mix(digest ^ _SALT[j]) % np.uint64(self.part)).astype(np.int64)
            np.add.at(self.number, cell, s)
            np.add.at(self.digests, cell, digest * wide)
            np.add.at(self.checks, cell, c * wide)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All digests that can be recovered: sketch, digest, sign; and which sketches were emptied."""
        out = []
        while True:
            single = np.flatnonzero(np.abs(self.number) == 1)
            sign = self.number[single]
            digest = self.digests[single] * sign.view(np.uint64)
            good = _check(digest) * sign.view(np.uint64) == self.checks[single]
            single, sign, digest = single[good], sign[good], digest[good]
            if not len(single):
                break
            own = single // self.size
            order = np.lexsort((digest, own))
            own, digest, sign = own[order], digest[order], sign[order]
            new = np.ones(len(own), bool)
            new[1:] = (own[1:] != own[:-1]) | (digest[1:] != digest[:-1])
            own, digest, sign = own[new], digest[new], sign[new]
            out.append((own, digest, sign))
            self.add(own, digest, -sign)
        empty = ~((self.number != 0) | (self.digests != 0)).reshape(-1, self.size).any(1)
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), empty
        return *(np.concatenate(x) for x in zip(*out)), empty

    def texts(self, counts: np.ndarray) -> list[str]:
        """Each sketch, after its number of digests, as text."""
        n, m = len(counts), self.size
        number, checks = self.number.astype("<i2").reshape(n, m), self.checks.astype("<u4").reshape(n, m)
        digests = self.digests.astype("<u8").reshape(n, m)
        return [base64.b64encode(np.array([c], "<u4").tobytes() + a.tobytes() + b.tobytes() + d.tobytes()).decode() for c, a, b, d in zip(counts.tolist(), number, digests, checks)]


def _members(doc: np.ndarray, digest: np.ndarray, many: int):
    """The digests of each document as ranges."""
    return np.searchsorted(doc, np.arange(many + 1)), digest


def _take(at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of the sets ``which``, and the set's place in ``which``."""
    n = at[which + 1] - at[which]
    own = np.repeat(np.arange(len(which)), n)
    return np.repeat(at[which] - (np.cumsum(n) - n), n) + np.arange(len(own)), own


def differences(at_a, a, which_a, at_b, b, which_b) -> tuple[np.ndarray, np.ndarray]:
    """Recovered digests only in the first and only in the second set of each pair, as numbers, by subtracting and peeling."""
    many = len(which_a)
    only_a, only_b = np.zeros(many, np.int64), np.zeros(many, np.int64)
    todo, part = np.arange(many), CELLS
    while len(todo):
        sketch = Sketches(len(todo), part)
        for at, digest, which, sign in ((at_a, a, which_a, 1), (at_b, b, which_b, -1)):
            place, own = _take(at, which[todo])
            sketch.add(own, digest[place], np.full(len(own), sign))
        own, _, sign, done = sketch.peel()
        plus, minus = np.bincount(own[sign > 0], minlength=len(todo)), np.bincount(own[sign < 0], minlength=len(todo))
        only_a[todo[done]], only_b[todo[done]] = plus[done], minus[done]
        todo, part = todo[~done], part * GROWTH
    return only_a, only_b


def likeness(at_a, a, which_a, at_b, b, which_b) -> np.ndarray:
    only_a, only_b = differences(at_a, a, which_a, at_b, b, which_b)
    n = at_a[which_a + 1] - at_a[which_a]
    whole = n + only_b
    return np.where(whole > 0, (n - only_a) / np.maximum(whole, 1), 1.0)


def fingerprint_texts(at: np.ndarray, digest: np.ndarray) -> list[str]:
    many = len(at) - 1
    sketch = Sketches(many, CELLS)
    place, own = _take(at, np.arange(many))
    sketch.add(own, digest[place], np.ones(len(own), np.int64))
    return sketch.texts(np.diff(at))


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_RESULT_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str]) -> pa.RecordBatch:
    """All but the last document, each with its successor."""
    n = len(ids) - 1
    edited = [t[:len(t) - len(t) // 4] + nxt[:len(t) // 4] for t, nxt in zip(texts, texts[1:])]
    at, digest = _members(*paragraphs([t.encode() for t in texts]), n + 1)
    raw = [e.encode() for e in edited]
    at_e, digest_e = _members(*paragraphs(raw), n)
    own = np.arange(n)
    columns = [
        ids[:-1], [len(t) for t in texts[:-1]], [hashlib.sha256(e).hexdigest() for e in raw], fingerprint_texts(at, digest)[:-1], fingerprint_texts(at_e, digest_e),
        likeness(at, digest, own, at_e, digest_e, own), likeness(at, digest, own, at, digest, own + 1)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)


def _stream(batches):
    """Ranges come one after another, in order, each ended by the first document of the next one."""
    ids, texts, size, now, ended = [], [], 0, None, False
    for b in batches:
        for i, t, bucket, tail in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "tail"))):
            if bucket != now:
                ids, texts, size, now, ended = [], [], 0, bucket, False
            if ended:
                continue
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1])
            ended = tail
            if (ended or size > TOGETHER) and len(ids) > 1:
                yield _rows(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next`` of every row."""
    docs = two_columns(docs).withColumn("k", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = int(min(MOST_RANGES, max(1, size // RANGE_BYTES)))
    cuts = np.unique(np.array(docs.approxQuantile("k", [i / many for i in range(1, many)], 0.1 / many) if many > 1 else [], np.float64))

    @F.pandas_udf("int")
    def bucket(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(np.float64), side="right").astype(np.int32))

    firsts = sorted((r.bucket, r.k) for r in docs.select(bucket("k").alias("bucket"), "k").groupBy("bucket").agg(F.min("k").alias("k")).collect())
    starts = np.array([k for _, k in firsts], np.int64)
    before = np.array([b for b, _ in firsts[-1:] + firsts[:-1]], np.int32)

    @F.pandas_udf("int")
    def range_before(k: pd.Series) -> pd.Series:
        key = k.to_numpy(np.int64)
        at = np.minimum(np.searchsorted(starts, key), len(starts) - 1)
        return pd.Series(np.where(starts[at] == key, before[at], -1).astype(np.int32))

    placed = docs.withColumns({"own": bucket("k"), "earlier": range_before("k")})
    rows = placed.select("doc_id", "text", "k", F.explode(F.when(F.col("earlier") >= 0, F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("tail")), F.struct(F.col("earlier").alias("bucket"), F.lit(True).alias("tail")))).otherwise(
        F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("tail"))))).alias("r")).select("doc_id", "text", "k", "r.bucket", "r.tail")
    ordered = rows.repartition(max(1, len(firsts)), "bucket").sortWithinPartitions("bucket", "tail", "k", "text")
    return ordered.select("doc_id", "text", "bucket", "tail").mapInArrow(_stream, _RESULT_SQL)
