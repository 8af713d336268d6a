"""Most frequent items without a count of every item: mergeable summaries, then exact counts of the few that can matter.

Each task keeps a Misra-Gries summary: at most ``capacity`` counters after every batch, lowered together when there are more. A counter is too low by no more than
what was taken off in its task, and so is the absence of an item. Summaries are added up by item; what was taken off in all tasks, the slack, bounds the error of every sum. Only items
whose sum and slack reach the ``k``-th largest sum can be among the first ``k``. They are counted exactly in a second pass, and the
answer is certain if the last of them has more than the slack. If not, all items are counted after all.

What is shuffled is ``capacity`` rows a task at most, however many different items there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.operators.stats import top_items
from scriptorium.session import store

#: Counters of a task; candidates that are counted in the second pass, at most.
CAPACITY, CANDIDATES = 20_000, 100_000


class Summary:
    """Counters of items, and how much was ``taken`` off any of them."""

    def __init__(self, capacity: int):
        self.capacity, self.counts, self.taken = capacity, {}, 0

    def add(self, items: list, counts: list[int]) -> None:
        have = self.counts
        for item, n in zip(items, counts):
            have[item] = have.get(item, 0) + n
        if len(have) > self.capacity:
            values = np.fromiter(have.values(), np.int64, len(have))
            cut = int(np.partition(values, len(values) - self.capacity - 1)[len(values) - self.capacity - 1])
            self.counts = {i: n - cut for i, n in have.items() if n > cut}
            self.taken += cut


def summaries(items: DataFrame, item: str, capacity: int = CAPACITY) -> DataFrame:
    """``item``, ``n`` of every task's counters, and one row a task with ``taken``."""
    schema = T.StructType([T.StructField("item", items.schema[item].dataType), T.StructField("n", T.LongType()), T.StructField("taken", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kind = Summary(capacity), None
        for b in batches:
            kind = b.column(0).type
            # A few thousand items at a time, so that the counters never grow far beyond their number.
            for a in range(0, b.num_rows, capacity):
                found = pc.value_counts(b.column(0).slice(a, capacity))
                own.add(found.field(0).to_pylist(), found.field(1).to_pylist())
        if kind is not None:
            n = len(own.counts)
            yield pa.RecordBatch.from_arrays([pa.array([*own.counts, None], kind), pa.array([*own.counts.values(), None], pa.int64()), pa.array([None] * n + [own.taken], pa.int64())],
                                             names=["item", "n", "taken"])

    return items.select(item).mapInArrow(run, schema)


def heavy_items(items: DataFrame, item: str, k: int = 10, *, capacity: int = CAPACITY, candidates: int = CANDIDATES) -> DataFrame:
    """What ``top_items`` gives: the ``k`` most frequent items with ``n`` and ``rank``; equal counts in item order, null first."""
    found = store(summaries(items, item, capacity), "summaries")
    slack = found.agg(F.sum("taken")).first()[0] or 0
    sums = found.where("n is not null").groupBy("item").agg(F.sum("n").alias("low"))
    first = [r.low for r in sums.orderBy(F.desc("low")).limit(k).collect()]
    least = first[-1] if len(first) == k else 0
    wanted = store(sums.where(F.col("low") + slack >= least).select(F.col("item").alias("_wanted")), "candidates")
    if wanted.count() <= candidates:
        counted = store(items.join(wanted, F.col(item).eqNullSafe(F.col("_wanted")), "left_semi").groupBy(item).agg(F.count("*").alias("n")), "counted")
        order = [F.desc("n"), F.asc(item)]
        best = counted.orderBy(*order).limit(k)
        n, last = best.agg(F.count("*"), F.min("n")).first()
        if slack == 0 or (n == k and last > slack):
            return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return top_items(items, item, k)
