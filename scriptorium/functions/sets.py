"""Column expressions on item sets held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def jaccard(a: Column, b: Column) -> Column:
    """Shared items over all items; 0 when both sets are empty. Null counts as empty."""
    empty = F.array().cast("array<string>")
    a, b = F.coalesce(a, empty), F.coalesce(b, empty)
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def overlap_score(shared: Column, size_a: Column, size_b: Column) -> Column:
    """The same ratio from counts."""
    union = size_a + size_b - shared
    return F.when(union == 0, F.lit(0.0)).otherwise(shared / union)


def union_all(arrays: Column) -> Column:
    """Sorted union of an array of arrays."""
    return F.array_sort(F.array_distinct(F.flatten(arrays)))
