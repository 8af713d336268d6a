"""Pair blocks of queries with blocks of catalogue rows, none of them larger than asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def cell_blocks(catalogue: DataFrame, cell: str, sizes: dict[int, int], key: Column, row: Column,
                block_rows: int) -> DataFrame:
    """``(cell, _catalogue)``: each cell in as many blocks as its known size asks for.

    Rows go to blocks by a hash of ``key``, so a block holds about ``block_rows`` of them however
    uneven the cells are.
    """
    counts = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, -(-n // block_rows))])
    slot = F.pmod(F.xxhash64(key), F.element_at(counts, F.col(cell)).cast("bigint"))
    return catalogue.groupBy(cell, slot.alias("_slot")).agg(F.collect_list(row).alias("_catalogue")).drop("_slot")


def query_blocks(queries: DataFrame, cell: str, key: Column, row: Column, n_queries: int, block_rows: int) -> DataFrame:
    """``(cell, _salt, _queries)``: the queries of each cell, about ``block_rows`` to a block."""
    chunk = F.pmod(F.xxhash64(key), F.lit(max(1, n_queries // block_rows)))
    packed = queries.groupBy(cell, chunk.alias("_chunk")).agg(F.collect_list(row).alias("_queries"))
    return packed.select(cell, F.pmod(F.col("_chunk"), F.lit(SALTS)).cast("int").alias("_salt"), "_queries")


def block_pairs(queries: DataFrame, blocks: DataFrame, cell: str) -> DataFrame:
    """``(_queries, _catalogue)``: every block of queries of a cell with every block of that cell.

    Only whole blocks are joined, never rows. The salt spreads the query blocks of one cell over
    several join keys; AQE splits what is still uneven.
    """
    salted = blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return queries.join(salted, [cell, "_salt"]).select("_queries", "_catalogue")
