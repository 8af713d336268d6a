"""Writing catalogue tables: create, append, keyed overwrite. Each may be repeated, and may read the table it writes.

A keyed table is partitioned into shares of its keys by linear hashing. The number of shares is a property of the table, nowhere an argument that could be
given wrongly, and it grows with the table: where the shares hold more than ``SHARE_BYTES`` on average, the next ones in turn are split, and
only those are read and written. A row counts where its key belongs by the present number of shares, so the change of that one property
is the moment at which a split takes effect; what a broken run left in other places is not seen by :func:`keyed_rows` and goes with the next rewrite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.merge import append_new_keys, keyed_update, unmatched_updates
from scriptorium.session import few_listings, store

#: Column that a keyed table is partitioned by: a share of the keys by hash.
SHARE = "key_share"
#: Properties of a keyed table.
SHARES, KEY, BYTES = "scriptorium.shares", "scriptorium.key", "scriptorium.share_bytes"
#: Bytes of a share, on average, at which the table grows.
SHARE_BYTES = 128 << 20


def share_of(key: str, shares: int) -> Column:
    """The share of a key by linear hashing: the hash modulo a power of two, or modulo half of it where that share is not split off yet."""
    whole = 1 << (shares - 1).bit_length()
    h = F.xxhash64(key)
    low, high = F.pmod(h, F.lit(max(1, whole >> 1))), F.pmod(h, F.lit(whole))
    return F.when(high < shares, high).otherwise(low).cast("int")


def parent(share: int, shares: int) -> int:
    """Which of ``shares`` shares holds the keys that will be in ``share``."""
    while share >= shares:
        share -= 1 << (share.bit_length() - 1)
    return share


def create_keyed(spark: SparkSession, table: str, df: DataFrame, key: str, shares: int = 1, share_bytes: int = SHARE_BYTES) -> bool:
    """Create a table with the columns of ``df`` and no rows, in ``shares`` shares to begin with; False when it was there already."""
    if spark.catalog.tableExists(table):
        return False
    spark.createDataFrame([], df.withColumn(SHARE, F.lit(0)).schema).write.partitionBy(SHARE).format("parquet").saveAsTable(table)
    _set(spark, table, {SHARES: shares, KEY: key, BYTES: share_bytes})
    return True


def _set(spark: SparkSession, table: str, values: dict) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in values.items())})")


def _layout(spark: SparkSession, table: str, key: str | None = None) -> tuple[int, str, int]:
    """Number of shares, key column and bytes of a share, as the table has them."""
    held = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if SHARES not in held:
        raise ValueError(f"{table} is no keyed table")
    if key is not None and held[KEY] != key:
        raise ValueError(f"{table} is keyed by {held[KEY]!r}, not by {key!r}")
    return int(held[SHARES]), held[KEY], int(held[BYTES])


def _placed(spark: SparkSession, table: str) -> DataFrame:
    """The rows that stand where their key belongs, with the share."""
    shares, key, _ = _layout(spark, table)
    return spark.table(table).where(F.col(SHARE) == share_of(key, shares))


def keyed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a keyed table, without the share."""
    return _placed(spark, table).drop(SHARE)


def _bytes(spark: SparkSession, at: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def size_of(spark: SparkSession, table: str) -> int:
    """Bytes of the table's files."""
    return _bytes(spark, next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "Location"))


def _overwrite(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Put ``rows`` in place of the partitions that they belong to."""
    name = "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        rows.select(*spark.table(table).columns).repartition(SHARE).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, mode)


def append_keyed(spark: SparkSession, table: str, incoming: DataFrame, key: str, shares: int = 1, share_bytes: int = SHARE_BYTES) -> int:
    """Append the rows whose key is not in the table yet, one per key, and say how many. Rows without a key are passed over.

    ``shares`` and ``share_bytes`` are for a table that has to be created. The rows are stored before the table is touched, so a repeated or broken run
    adds nothing twice, and the table grows first, so no task has to write more than a share.
    """
    create_keyed(spark, table, incoming, key, shares, share_bytes)
    _layout(spark, table, key)
    with few_listings(spark):
        fresh = store(append_new_keys(keyed_rows(spark, table), incoming.where(F.col(key).isNotNull()), key), "fresh")
        added = fresh.count()
        if added:
            now, done = _grow(spark, table, _bytes(spark, fresh.stored_at), fresh)
            if len(done) < now:
                rest = fresh.withColumn(SHARE, share_of(key, now)).where(~_among(SHARE, done))
                rest.select(*spark.table(table).columns).repartition(SHARE).write.insertInto(table)
    return added


def _among(column: str, values: list[int]) -> Column:
    """Whether a number is one of the sorted ``values``, by runs of them: a table may have many thousands of shares, which mostly lie together."""
    found, runs = F.lit(False), []
    for v in values:
        if runs and v == runs[-1][1] + 1:
            runs[-1][1] = v
        else:
            runs.append([v, v])
    if len(runs) > 64:
        return F.col(column).isin(values)
    for low, high in runs:
        found = found | F.col(column).between(low, high)
    return found


def grow(spark: SparkSession, table: str, more: int = 0) -> int:
    """Split shares until they hold ``share_bytes`` on average at most, with ``more`` bytes to come; the new number of shares.

    New shares are written first, then the table's property changes, then the shares that were split are written without the rows that left.
    """
    with few_listings(spark):
        return _grow(spark, table, more)[0]


def _grow(spark: SparkSession, table: str, more: int, fresh: DataFrame | None = None) -> tuple[int, list[int]]:
    """The number of shares after :func:`grow`, and those that were written anew. The rows of ``fresh`` that belong there are written with them, so they get one
    file and not two; rows in new shares do not count before the property changes, as all others there.
    """
    shares, key, most = _layout(spark, table)
    wanted = max(shares, -(-(size_of(spark, table) + more) // most))
    if wanted == shares:
        return shares, []
    split = sorted({parent(s, shares) for s in range(shares, wanted)})
    done, columns = [*split, *range(shares, wanted)], spark.table(table).columns
    moved = _placed(spark, table).where(_among(SHARE, split)).withColumn(SHARE, share_of(key, wanted)).select(*columns)
    if fresh is not None:
        moved = moved.unionByName(fresh.withColumn(SHARE, share_of(key, wanted)).where(_among(SHARE, done)).select(*columns))
    moved = store(moved, "split")
    there = {r[0] for r in moved.select(SHARE).distinct().collect()}  # no more than shares
    _overwrite(spark, table, moved.where(F.col(SHARE) >= shares))
    _set(spark, table, {SHARES: wanted})
    _overwrite(spark, table, moved.where(F.col(SHARE) < shares))
    for s in sorted(set(split) - there):  # all of its keys have left
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({SHARE} = {s})")
    return wanted, done


def rows_of_keys(spark: SparkSession, table: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of the shares that hold any of ``keys``, with the share; other partitions are not read."""
    now, _, _ = _layout(spark, table, key)
    touched = sorted(r[0] for r in keys.where(F.col(key).isNotNull()).select(share_of(key, now)).distinct().collect())  # at most as many as there are shares
    return _placed(spark, table).where(_among(SHARE, touched))


def update_keyed(spark: SparkSession, table: str, updates: DataFrame, key: str, field: str, shares: int | None = None) -> DataFrame:
    """Set ``field`` where there is an update; only the partitions concerned are read and written anew.

    Returns the updates without a row in the table. The new partitions are stored first, then put in place of the old ones. ``shares`` has no
    effect: the table knows how many it has.
    """
    with few_listings(spark):
        updates = store(updates.select(key, field), "updates")
        rows = rows_of_keys(spark, table, updates, key)
        missing = store(unmatched_updates(rows, updates, key), "unmatched")
        _overwrite(spark, table, store(keyed_update(rows, updates, key, field), "updated"))
    return missing
