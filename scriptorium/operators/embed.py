"""Text encoders and other user models, run in Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts in (``.to_pylist()`` gives plain strings), one row of numbers per text out.
Encoder = Callable[[pa.Array], np.ndarray]

#: So many failing rows of a task, and no other ones, mean a broken model.
BROKEN = 10


def hashing_encoder(dim: int = 64) -> Callable[[], Encoder]:
    """Word-hashing vectors: the default where no trained model is at hand.

    A word counts in the bucket given by the first 32 bits of the MD5 of its lower case, modulo
    ``dim``. The counts are scaled to length 1000 and rounded, so distances between such vectors
    are whole numbers and the same on every machine.
    """

    def make() -> Encoder:
        def encode(texts: pa.Array) -> np.ndarray:
            tokens = pc.utf8_split_whitespace(pc.utf8_lower(texts))
            lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
            words = tokens.flatten().dictionary_encode()
            distinct = words.dictionary.cast(pa.binary()).to_pylist()
            heads = b"".join([hashlib.md5(w, usedforsecurity=False).digest()[:4] for w in distinct])
            bucket = np.frombuffer(heads, dtype=">u4").astype(np.int64) % dim
            bucket[[i for i, w in enumerate(distinct) if not w]] = -1  # edges of the text, not a word
            codes = bucket[words.indices.to_numpy(zero_copy_only=False)]
            cell = np.repeat(np.arange(len(texts)), lengths) * dim + codes
            counts = np.bincount(cell[codes >= 0], minlength=len(texts) * dim).reshape(-1, dim).astype(np.float64)
            norm = np.sqrt((counts * counts).sum(1))
            return np.floor(1000.0 * counts / np.where(norm == 0, 1.0, norm)[:, None] + 0.5)

        return encode

    return make


def _as_lists(vectors: list) -> pa.Array:
    """One float list per row, built from one flat buffer; null where there is no vector."""
    known = [v for v in vectors if v is not None]
    offsets = np.cumsum([0, *(0 if v is None else len(v) for v in vectors)])
    flat = np.concatenate(known) if known else np.zeros(0, np.float32)
    missing = pa.array([v is None for v in vectors]) if len(known) < len(vectors) else None
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.float32()), mask=missing)


def _attempt(call: Callable, items: pa.Array) -> tuple[list, list]:
    """Results and errors, one per item. A batch that fails is halved until only the bad items are left."""
    try:
        results = list(call(items))
        if len(results) != len(items):
            raise ValueError(f"{len(results)} results for {len(items)} rows")
        return results, [None] * len(items)
    except Exception as error:
        if len(items) == 1:
            return [None], [f"{type(error).__name__}: {error}"]
        half = len(items) // 2
        left, right = _attempt(call, items.slice(0, half)), _attempt(call, items.slice(half))
        return left[0] + right[0], left[1] + right[1]


def _run(df: DataFrame, column: str, make: Callable, keep: list[str], out: str, kind: T.DataType, convert: Callable,
         error: str | None) -> DataFrame:
    """Call a model on Arrow batches of ``column``.

    A row the model fails on gets null, and the message in the column ``error`` if one is asked for. A task of ``BROKEN`` rows or more
    in which every row fails raises: then it is the model that is broken, not the rows.
    """
    fields = [df.schema[c] for c in keep] + [T.StructField(out, kind)] + ([T.StructField(error, T.StringType())] if error else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, good, bad, last = make(), 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            results, errors = _attempt(model, batch.column(column))
            good += sum(e is None for e in errors)
            bad += sum(e is not None for e in errors)
            last = next((e for e in errors if e), last)
            columns = [*batch.select(keep).columns, convert(results)] + ([pa.array(errors, pa.string())] if error else [])
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        if bad >= BROKEN and not good:
            raise RuntimeError(f"the model failed on all {bad} rows of a task, last with {last}")

    return df.mapInArrow(run, T.StructType(fields))


def embed(df: DataFrame, text: str, make_encoder: Callable[[], Encoder] | None = None,
          out: str = "vector", error: str | None = None) -> DataFrame:
    """Replace ``text`` by its vector. ``make_encoder`` runs once per task, e.g. to load a model. ``error`` as for ``verify``."""
    make_encoder = make_encoder or hashing_encoder()

    def make():
        encode = make_encoder()
        return lambda texts: np.asarray(encode(pc.fill_null(texts, "")), dtype=np.float32)

    names = [c for c in df.columns if c != text]
    return _run(df.select(*names, text), text, make, names, out, T.ArrayType(T.FloatType()), _as_lists, error)


def verify(df: DataFrame, prompt: str, make_model: Callable[[], Callable[[list[str]], list[str]]],
           out: str = "response", error: str | None = None) -> DataFrame:
    """Add a model's answer per prompt; the model takes a list of prompts.

    Null where it fails on a row, with the message in ``error`` if such a column is wanted; ``failure_report`` counts them.
    """
    def make():
        model = make_model()
        return lambda prompts: model(prompts.to_pylist())

    return _run(df, prompt, make, df.columns, out, T.StringType(), lambda answers: pa.array(answers, pa.string()), error)


def failure_report(df: DataFrame, error: str = "error") -> DataFrame:
    """Failed rows by message: ``(error, n)``."""
    return df.where(F.col(error).isNotNull()).groupBy(error).agg(F.count("*").alias("n"))
