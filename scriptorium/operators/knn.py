"""Exact nearest-neighbour join of query vectors with a catalogue of vectors."""

from __future__ import annotations

from collections.abc import Iterator
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.operators.kernels import matrix, nearest
from scriptorium.session import store

MAX_BROADCAST_BYTES = 128 << 20
#: Bytes of a catalogue that are compared at once where the whole does not fit the bound, and that go to all tasks at once.
SHARD_BYTES = PASS_BYTES = 64 << 20


def usable(vector: str, dim: int) -> Column:
    """True for a vector of the right length without missing, undefined or infinite values."""
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.array_size(c) == dim) & ~bad, F.lit(False))


def knn_join(queries: DataFrame, catalogue: DataFrame, k: int = 5, *, vector: str = "vector",
             item: str = "item_id", exclude: str | None = None,
             dim: int | None = None, max_broadcast_bytes: int = MAX_BROADCAST_BYTES, shard_bytes: int = SHARD_BYTES,
             pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The ``k`` catalogue rows nearest to each query by squared L2.

    ``queries`` has ``vector`` and any key columns, which must identify a row; ``catalogue`` has
    ``item`` (unique) and ``vector``. Returns the key columns, ``neighbour``, ``distance`` and
    ``rank`` (from 1; equal distances in item order). ``exclude`` names a query column with an
    item the query must not return, such as itself. Vectors have ``dim`` numbers, or else as many as most
    of the catalogue's; rows without such a vector are left out, row by row, and ``left_out`` gives them.

    A catalogue whose size is known to fit the bound goes to all tasks. A larger one goes there in passes of about
    ``pass_bytes`` (at least a shard), one after another, each compared shard by shard. Either way the queries are not shuffled at all.
    """
    dim = dim or common_dimension(catalogue, vector)
    item_type = catalogue.schema[item].dataType
    keys = [f for f in queries.schema.fields if f.name != vector]
    out = T.StructType([*keys, T.StructField("neighbour", item_type),
                        T.StructField("distance", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    names = [f.name for f in keys]
    queries = queries.where(usable(vector, dim)).select(*names, vector)
    catalogue = catalogue.where(usable(vector, dim)).select(item, F.col(vector).cast("array<double>").alias(vector))
    n, length = catalogue.agg(F.count("*"), F.sum(F.octet_length(F.col(item).cast("string")))).first()
    size = n * (8 * dim + 16) + (length or 0)
    if size <= max_broadcast_bytes:
        return _by_broadcast(queries, catalogue, k, vector, item, exclude, out)
    shard_rows = max(1, n * shard_bytes // size)
    return _by_shards(queries, catalogue, k, vector, item, exclude, out, -(-size // max(pass_bytes, shard_bytes)), shard_rows)


def common_dimension(catalogue: DataFrame, vector: str = "vector") -> int:
    """The most frequent length of the catalogue's vectors, the smaller of equally frequent ones; 0 if there is none."""
    sizes = catalogue.where(F.col(vector).isNotNull()).groupBy(F.array_size(vector).alias("dim")).count()
    first = sizes.orderBy(F.desc("count"), "dim").first()
    return first["dim"] if first else 0


def left_out(vectors: DataFrame, dim: int, vector: str = "vector") -> DataFrame:
    """The rows that a search skips, with a reason."""
    c = F.col(vector)
    reason = F.when(c.isNull(), "missing").when(F.array_size(c) != dim, "length").otherwise("values")
    return vectors.where(~usable(vector, dim)).withColumn("reason", reason).drop(vector)


def _positions(wanted: pa.Array, items: pa.Array) -> np.ndarray:
    found = pc.index_in(wanted.cast(items.type), value_set=items)
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _answers(batch: pa.RecordBatch, names: list[str], items: pa.Array, found) -> pa.RecordBatch:
    rows, cols, distance, rank = found
    taken = batch.select(names).take(pa.array(rows))
    columns = [*taken.columns, items.take(pa.array(cols)), pa.array(distance, pa.float64()),
               pa.array(rank, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=[*names, "neighbour", "distance", "rank"])


def _by_broadcast(queries, catalogue, k, vector, item, exclude, out) -> DataFrame:
    table = catalogue.orderBy(item).toArrow().combine_chunks()  # its size has been checked
    items = table.column(item).combine_chunks()
    vectors = table.column(vector).combine_chunks()
    shared = queries.sparkSession.sparkContext.broadcast((items, matrix(vectors) if len(items) else None))
    names = [f.name for f in out.fields[:-3]]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, vectors = shared.value
        for batch in batches:
            if batch.num_rows == 0 or vectors is None:
                continue
            own = _positions(batch.column(exclude), items) if exclude else None
            found = nearest(matrix(batch.column(vector)), vectors, k, own)
            yield _answers(batch, names, items, found)

    return queries.mapInArrow(search, out)


def _by_shards(queries, catalogue, k, vector, item, exclude, out, passes, shard_rows) -> DataFrame:
    """The same for a catalogue of any size: pass by pass, with a running top ``k``.

    A pass has a share of the items by hash, small enough to go to all tasks, which compare ``shard_rows`` of it at once. Queries are never shuffled
    or copied: each pass reads them with the best answers so far and adds its own. All passes but the last store the ``k`` best of both, and release
    what they sent before the next is sent, so memory is bounded however large the catalogue is; a catalogue of one pass stores no queries.
    """
    spark, context = queries.sparkSession, queries.sparkSession.sparkContext
    item_type = out["neighbour"].dataType
    state = queries.withColumn("_best", F.array().cast(best_type(item_type)))
    schema = state.schema
    catalogue = store(catalogue, "catalogue") if passes > 1 else catalogue
    for number in range(passes):
        part = catalogue.where(F.pmod(F.xxhash64(item), F.lit(passes)) == number)
        table = part.orderBy(item).toArrow().combine_chunks()  # a pass's size is bounded
        if not table.num_rows:
            continue
        shared = context.broadcast((table.column(item).combine_chunks(), matrix(table.column(vector).combine_chunks())))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, vectors = shared.value
            for batch in batches:
                if batch.num_rows:
                    own = _positions(batch.column(exclude), items) if exclude else None
                    rows, cols, distance, _ = nearest(matrix(batch.column(vector)), vectors, k, own, shard_rows)
                    best = _merged(batch.column("_best"), rows, distance, items.take(pa.array(cols)), k)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:-1], best], names=batch.schema.names)

        state = state.mapInArrow(search, schema)
        if number < passes - 1:
            state = store(state, "neighbours")
            shared.destroy()
    keys = [f.name for f in out.fields[:-3]]
    return state.select(*keys, F.posexplode("_best").alias("_at", "_b")).select(
        *keys, F.col("_b.i").alias("neighbour"), F.col("_b.d").alias("distance"), (F.col("_at") + 1).cast("int").alias("rank"))


def best_type(item_type: T.DataType) -> T.ArrayType:
    """Type of a query's best answers so far, nearest first: distance and item."""
    return T.ArrayType(T.StructType([T.StructField("d", T.DoubleType()), T.StructField("i", item_type)]))


def _merged(best: pa.ListArray, rows: np.ndarray, distance: np.ndarray, items: pa.Array, k: int) -> pa.ListArray:
    """The ``k`` best per row of the answers so far and the new ones, nearest first, equal distances in item order."""
    old = best.flatten()
    lengths = pc.list_value_length(best).to_numpy(zero_copy_only=False)
    row = np.concatenate([np.repeat(np.arange(len(best)), lengths), rows])
    every = pa.table({"row": row, "d": pa.chunked_array([old.field("d"), pa.array(distance, pa.float64())]),
                      "i": pa.chunked_array([old.field("i"), items.cast(old.field("i").type)])})
    every = every.sort_by([("row", "ascending"), ("d", "ascending"), ("i", "ascending")]).combine_chunks()
    row = every.column("row").to_numpy()
    start = np.searchsorted(row, np.arange(len(best) + 1))
    keep = np.flatnonzero(np.arange(len(row)) - start[row] < k)
    kept = every.take(pa.array(keep)).combine_chunks()
    values = pa.StructArray.from_arrays([kept.column("d").combine_chunks(), kept.column("i").combine_chunks()], fields=list(old.type))
    offsets = np.searchsorted(row[keep], np.arange(len(best) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values, type=best.type)


def majority_label(neighbours: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Most frequent label among each query's neighbours; equal counts take the smallest label."""
    votes = neighbours.groupBy(*keys, label).agg(F.count("*").alias("votes"))
    best = F.max_by(F.col(label), F.struct(F.col("votes"), (-F.col(label)).alias("low")))
    return votes.groupBy(*keys).agg(best.alias(label), F.max("votes").alias("votes"))
