"""Connected components of a table of links, by rounds of joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scriptorium.llm.common import store


def _state(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def roots(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of every node in ``links`` (columns ``u``, ``v``, undirected).

    Each round hangs a node's larger neighbours, then its smaller ones, on its smallest neighbour; this ends
    when all links of a component lead to its smallest node. Loops and repeated links do no harm.
    """
    now = store(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b")).where("a <> b")
        now = store(small.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _state(now)
        if after == before:
            break
        before = after
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
