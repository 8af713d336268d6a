"""What the operators share: reading documents, batches of bytes, hashes, bounded id filters."""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from scriptorium import session
from scriptorium.sources.tables import load

#: Multipliers of the polynomial and finalising hashes.
ODD, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Entries a worker's dictionary may hold before it is emptied.
DICT_ENTRIES = 150_000


#: Rows and bytes of an Arrow batch in the passes below: whole texts are large, and each batch is held by the JVM and by Python.
ARROW_ROWS, ARROW_BYTES = 2_000, 8 << 20


@contextmanager
def small_batches(spark, rows: int = ARROW_ROWS):
    """Arrow batches of at most ``rows`` rows for what is run inside; the session's own setting is put back."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES}
    before = {name: spark.conf.get(name) for name in limits}
    for name, most in limits.items():
        own = int(before[name].rstrip("b"))  # bytes are given with their unit
        spark.conf.set(name, str(min(most, own) if own > 0 else most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def store(df: DataFrame, name: str, rows: int = ARROW_ROWS) -> DataFrame:
    """``session.store`` with small batches."""
    with small_batches(df.sparkSession, rows):
        return session.store(df, name)


def forget(*stored: DataFrame) -> None:
    """Delete tables of :func:`store` that nothing reads any more."""
    for df in stored:
        session.forget(df)


def freeing(run):
    """``run`` over the batches of a task; afterwards the worker, which lives on, gives back the memory that the task took.

    Freed memory would otherwise stay with Arrow's pool and the C library, beside an executor's heap.
    """
    def go(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim:
                trim(0)
    return go


def documents(spark, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents", "doc_id", "text")


def two_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text``, whatever else the table carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def slices(batch: pa.RecordBatch, max_bytes: int = 8 << 20):
    """Runs of rows of about ``max_bytes`` of text (a longer text stands alone): ids and texts as bytes."""
    ids = batch.column("doc_id").to_pylist()
    texts = batch.column("text").cast(pa.binary())
    start, size = 0, 0
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    for i, n in enumerate(lengths):
        if size and size + n > max_bytes:
            yield ids[start:i], [t or b"" for t in texts[start:i].to_pylist()]
            start, size = i, 0
        size += int(n)
    if start < len(ids):
        yield ids[start:], [t or b"" for t in texts[start:].to_pylist()]


def to_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising permutation of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * MIX1
    h = (h ^ (h >> np.uint64(27))) * MIX2
    return h ^ (h >> np.uint64(31))


class Hashes(dict):
    """Word (bytes) to 64-bit hash, remembered in bounded memory."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > DICT_ENTRIES:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` elements; shorter than ``h`` by ``k - 1``."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    have, out, width, power = h, None, 1, 1
    done, left = 0, k
    while left:  # runs of 1, 2, 4, ... elements, joined for the bits of k
        factor = np.uint64(pow(int(ODD), width, 1 << 64))
        if left & 1:
            if out is None:
                out = have
            else:
                n = len(h) - done - width + 1
                out = out[:n] * factor + have[done:done + n]
            done += width
        left >>= 1
        if left:
            n = len(have) - width
            have = have[:n] * factor + have[width:width + n]
            width <<= 1
    return mix(out[:len(h) - k + 1])


def bounds(lengths) -> np.ndarray:
    """Offsets of consecutive runs, from 0 to the total."""
    return np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))])


class IdFilter:
    """A Bloom filter of longs with a fixed number of bits: no id that was put in is missed.

    Its size does not depend on the data; an overfull filter lets more through, and whatever it
    lets through is decided by an exact join afterwards.
    """

    def __init__(self, bits: np.ndarray, log2: int):
        self.bits, self.log2 = bits, log2

    @staticmethod
    def cells(ids: np.ndarray, log2: int) -> list[np.ndarray]:
        h = mix(ids.astype(np.int64).view(np.uint64) + ODD)
        shift = np.uint64(64 - log2)
        return [h >> shift, mix(h + ODD) >> shift]

    def has(self, ids: np.ndarray) -> np.ndarray:
        out = np.ones(len(ids), bool)
        for c in self.cells(ids, self.log2):
            out &= (self.bits[(c >> np.uint64(3)).astype(np.int64)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    @classmethod
    def of(cls, ids: DataFrame, log2: int = 24) -> "IdFilter":
        """From the only column of ``ids``. Every task sends one bitmap of ``2**log2`` bits at most."""
        parts, chunk = 64, (1 << log2) // 8 // 64

        def fill(batches):
            bits = np.zeros((1 << log2) // 8, np.uint8)
            for b in batches:
                got = b.column(0).drop_null().to_numpy(zero_copy_only=False)
                for c in cls.cells(got, log2):
                    np.bitwise_or.at(bits, (c >> np.uint64(3)).astype(np.int64), np.uint8(1) << (c & np.uint64(7)).astype(np.uint8))
            for p in range(parts):
                piece = bits[p * chunk:(p + 1) * chunk]
                if piece.any():
                    yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "bits": pa.array([piece.tobytes()])})

        def merge(batches):
            have: dict[int, np.ndarray] = {}
            for b in batches:
                for p, raw in zip(b.column("part").to_pylist(), b.column("bits").to_pylist()):
                    piece = np.frombuffer(raw, np.uint8)
                    have[p] = have[p] | piece if p in have else piece
            for p, piece in have.items():
                yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "bits": pa.array([piece.tobytes()])})

        schema = "part int, bits binary"
        rows = ids.mapInArrow(fill, schema).repartition(8, "part").mapInArrow(merge, schema).collect()
        bits = np.zeros((1 << log2) // 8, np.uint8)
        for r in rows:
            bits[r.part * chunk:(r.part + 1) * chunk] = np.frombuffer(r.bits, np.uint8)
        return cls(bits, log2)


def skipping(shared, run):
    """``run`` over the batches without rows whose id is null or may be in the broadcast filter."""
    return _chosen(shared, run, False)


def holding(shared, run):
    """``run`` over the rows whose id is null or may be in the broadcast filter."""
    return _chosen(shared, run, True)


def _chosen(shared, run, inside: bool):
    def go(batches):
        def rest():
            for b in batches:
                ids = b.column("doc_id")
                there = shared.value.has(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)) | np.asarray(pc.is_null(ids))
                yield b.filter(pa.array(there if inside else ~there))
        yield from run(rest())
    return go


def may_be_in(shared, column: str):
    """Filter condition: the id may be in the broadcast :class:`IdFilter`. Nulls are not.

    Meant for rows that are shuffled or stored next: right before a function on batches it would take a second Python worker a task.
    """
    @F.arrow_udf("boolean")
    def test(ids: pa.Array) -> pa.Array:
        there = shared.value.has(pc.fill_null(ids, 0).cast(pa.int64()).to_numpy(zero_copy_only=False))
        return pa.array(there & np.asarray(pc.is_valid(ids)), pa.bool_())

    return test(F.col(column))
