"""Prefix trie of conversations: how often each beginning occurs, and what a cache of prefixes would save.

1. Every conversation becomes one row of turn ids (64-bit hashes of role and text) and text lengths; texts are not shuffled.
2. The rows are range-partitioned and sorted by their turn ids, then by id, so that a node's conversations lie side by side and copies of one
   conversation, however many, spread over ranges. A range is read as a stream of chunks of about ``CHUNK`` turns.
3. A chunk is a matrix of turn ids, padded where a conversation has ended, taken ``WIDTH`` columns at a time. It is put in order by lexsort; the changes of
   each column, OR-ed over the columns so far, mark where the nodes of a depth start, and reduceat sums up every depth: down for members, up for subtrees.
4. Only nodes on the path of a chunk's first or last row can go on in another chunk. These boundary nodes are summed up by a digest of their path;
   what lies below them is added along each path once and then by node, which takes work in proportion to the paths' lengths.

A node's conversations that end there give one SHA-256 of all their ids. That is sequential by nature: boundary nodes send packed pieces, which one task
hashes in order, holding one piece at a time.

Turns are ordered by number, null first, equal numbers by their digest. Null roles and texts are empty. Rows without ``conv_id`` take no part. A repeated
row is one more turn. An empty table has no nodes. One conversation has to fit a row as 24 bytes a turn. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.llm.common import bounds, store

#: Turns of a chunk, columns of a matrix, most ranges that Spark's sampling is asked for.
CHUNK, WIDTH, RANGES = 50_000, 16, 2_000
#: Stands for no turn in a matrix; no turn has this id.
PAD = np.iinfo(np.int64).min
NODE = pa.schema([
    ("path", pa.int64()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("chars", pa.int64()), ("first", pa.int64()), ("ends", pa.binary())])
NODE_DDL = ("path long, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, ends_sha256 string, chars long, first long, ends binary")
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turns``: array of (``turn``, ``id``, ``chars``) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.greatest(F.xxhash64(role, text), F.lit(int(PAD) + 1)).alias("id"), F.char_length(text).cast("long").alias("chars"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("turns"))


def with_heads(convs: DataFrame, head: DataFrame, longest: int) -> DataFrame:
    """Conversations whose first ``h`` turns are those of another one.

    ``head`` holds ``conv_id``, ``head_id``, ``h`` (at most ``longest``); the head's first turns are taken as they were before.
    """
    own = convs.join(head, "conv_id", "left")
    heads = convs.join(head.select(F.col("head_id").alias("conv_id")).distinct(), "conv_id", "left_semi").select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, longest).alias("first"))
    h = F.coalesce("h", F.lit(0)).cast("int")
    none = F.array().cast(convs.schema["turns"].dataType)
    rest = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).otherwise(none)
    return own.join(heads, "head_id", "left").select(
        "conv_id", F.concat(F.coalesce(F.slice("first", F.lit(1), h), none), rest).alias("turns"))


class Chunk:
    """The trie of some conversations in order, as arrays over its nodes: a parent comes before its children, siblings in order."""

    def __init__(self, convs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, chars: np.ndarray):
        self.convs, at = convs, bounds(lengths)[:-1]
        node = np.zeros(len(convs), np.int64)
        levels = [(np.array([-1]), np.array([len(convs)]), np.array([convs.min()]), np.array([0]), np.array([PAD]))]
        total = 1
        for left in range(0, int(lengths.max(initial=0)), WIDTH):
            rows = np.flatnonzero(lengths > left)
            width = min(WIDTH, int(lengths.max()) - left)
            there = np.arange(width) < (lengths[rows] - left)[:, None]
            place = np.where(there, (at[rows] + left)[:, None] + np.arange(width), 0)
            block = np.where(there, ids[place], PAD)
            order = np.lexsort((*block.T[::-1], node[rows]))
            rows, block, there, place = rows[order], block[order], there[order], place[order]
            now = node[rows]
            change = np.append(True, now[1:] != now[:-1])
            for j in range(width):
                change[1:] |= block[1:, j] != block[:-1, j]
                here = np.flatnonzero(there[:, j])
                if not len(here):
                    break
                new = change[here]
                start = np.flatnonzero(new)
                levels.append((now[here[start]], np.diff(np.append(start, len(here))), np.minimum.reduceat(convs[rows[here]], start),
                               chars[place[here[start], j]], block[here[start], j]))
                now[here] = total + np.cumsum(new) - 1
                total += len(start)
            node[rows] = now
        self.level = bounds([len(x[0]) for x in levels])
        self.parent, self.n, self.low, self.chars, self.ids = (np.concatenate(x) for x in zip(*levels))
        self.depth = np.repeat(np.arange(len(levels)), np.diff(self.level))
        self.children = np.bincount(self.parent[1:], minlength=total)
        self.leaves = self.up((self.children == 0).astype(np.int64))
        self.saved = self.up((self.n - 1) * self.chars)
        self.order = np.lexsort((convs, node))
        self.ends = bounds(np.bincount(node, minlength=total))

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = values.copy()
        for d in range(len(self.level) - 1, 1, -1):
            a, b = self.level[d - 1], self.level[d]
            start = np.flatnonzero(np.append(True, self.parent[a + 1:b] != self.parent[a:b - 1]))
            out[self.parent[a:b][start]] += np.add.reduceat(out[a:b], start)
        return out

    def ended(self, node: int) -> np.ndarray:
        return self.convs[self.order[self.ends[node]:self.ends[node + 1]]]

    def paths(self) -> tuple[list[int], list[int]]:
        """Nodes of the first and of the last conversation in order: one that ends at a node comes before those that go on."""
        below = np.searchsorted(self.parent[1:], np.arange(len(self.n) + 1)) + 1  # children of a node are numbered in a row
        first, last = [0], [0]
        while self.ends[first[-1]] == self.ends[first[-1] + 1]:
            first.append(int(below[first[-1]]))
        while self.children[last[-1]]:
            last.append(int(below[last[-1] + 1]) - 1)
        return first, last


def listed(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _trie(batches):
    have, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        lists, convs = b.column("ids"), b.column("conv_id").to_numpy()
        n = np.diff(lists.offsets.to_numpy())
        ids, chars, at = lists.flatten().to_numpy(), b.column("chars").flatten().to_numpy(), bounds(n)
        a = 0
        while a < len(n):
            z = max(a + 1, int(np.searchsorted(at, at[a] + CHUNK - size, "right")) - 1)
            have.append((convs[a:z], n[a:z], ids[at[a]:at[z]], chars[at[a]:at[z]]))
            size += int(at[z] - at[a])
            if size >= CHUNK or z < len(n):
                yield from _nodes(Chunk(*map(np.concatenate, zip(*have))))
                have, size = [], 0
            a = z
    if have:
        yield from _nodes(Chunk(*map(np.concatenate, zip(*have))))


def _nodes(t: Chunk):
    """Rows of inner nodes, which are complete but for a parent on the boundary, and rows of the two boundary paths."""
    paths = t.paths()
    edge = np.zeros(len(t.n), bool)
    edge[paths[0] + paths[1]] = True
    inner, nothing = np.flatnonzero(~edge), hashlib.sha256(b"").hexdigest()
    keys = {0: b""}
    for path in paths:
        for x in path[1:]:
            keys[x] = hashlib.blake2b(keys[int(t.parent[x])] + int(t.ids[x]).to_bytes(8, "little", signed=True), digest_size=16).digest()
    parent = t.parent[inner]
    outer = edge[parent]
    own = inner[outer]
    below = lambda v: _sums(t.parent[own], v[own], len(t.n))
    children, leaves, saved = below(np.ones(len(t.n), np.int64)), below(t.leaves), below(t.saved)
    m = len(inner)
    if m:
        sha = [hashlib.sha256(listed(t.ended(x))).hexdigest() if t.ends[x] < t.ends[x + 1] else nothing for x in inner.tolist()]
        none = lambda kind: pa.nulls(m, kind)
        yield pa.RecordBatch.from_arrays([
            none(pa.int64()), none(pa.binary()), pa.array([keys[p] if o else None for p, o in zip(parent.tolist(), outer.tolist())], pa.binary()), pa.array(t.low[inner]),
            pa.array(t.depth[inner]), pa.array(t.low[parent], mask=outer), pa.array(t.n[inner]), pa.array(t.children[inner]), pa.array(t.leaves[inner]),
            pa.array(t.saved[inner]), pa.array(sha), none(pa.int64()), none(pa.int64()), none(pa.binary())], schema=NODE)
    done: set[int] = set()
    name = hashlib.blake2b(b"".join(int(t.ended(p[-1])[0]).to_bytes(8, "little", signed=True) + keys[p[-1]] for p in paths), digest_size=7).digest()
    rows = []
    for side, path in enumerate(paths):
        for x in path:
            again, ended = x in done, t.ended(x)
            done.add(x)
            rows.append((int.from_bytes(name, "little") * 2 + side, keys[x], keys[int(t.parent[x])] if x else None, int(t.low[x]), int(t.depth[x]), None,
                         *((0, 0, 0, 0) if again else (int(t.n[x]), int(children[x]), int(leaves[x]), int(saved[x]))), None, int(t.chars[x]),
                         int(ended[0]) if len(ended) and not again else None, zstandard.compress(listed(ended), 1) if len(ended) and not again else None))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), NODE)], schema=NODE)


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, at, values)
    return out


def _digests(batches):
    """Ids in pieces, sorted by node and first id: one hash a node, one piece in memory."""
    key, sha = None, None

    def row():
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "sha": pa.array([sha.hexdigest()])})

    for b in batches:
        for k, piece in zip(b.column("key"), b.column("ends")):
            k, text = k.as_py(), zstandard.decompress(piece.as_py())
            if k != key or sha is None:
                if sha is not None:
                    yield row()
                key, sha = k, hashlib.sha256(text)
            else:
                sha.update(b"," + text)
    if sha is not None:
        yield row()


def _boundary(rows: DataFrame) -> DataFrame:
    """One row per boundary node of any chunk, with its ``key``."""
    parts = rows.groupBy("key").agg(
        F.first("parent_key", ignorenulls=True).alias("parent_key"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"), F.sum("saved_tokens").alias("inner_saved"),
        F.max("chars").alias("chars"), F.min("path").alias("owner"))
    parts = store(parts, "boundary")
    kids = parts.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    nodes = parts.join(kids, "key", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("kids", F.lit(0)))
    own = nodes.select(F.col("owner").alias("path"), "depth", (F.col("inner_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
                       (F.col("inner_saved") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    # A node's own sums stand on one of its paths; what is below it on a path is summed along the path, then over its paths.
    down = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.select("path", "depth", "key").join(own, ["path", "depth"], "left").select("key", *[F.sum(F.coalesce(c, F.lit(0))).over(down).alias(c) for c in ("leaves", "saved")])
    sums = sums.groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    sha = rows.where("ends is not null").select("key", "first", "ends").repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, sha string")
    up = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(sums, "key").join(sha, "key", "left").join(up, "parent_key", "left").select(
        *[F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias(c) if c == "ends_sha256" else c for c in COLUMNS])


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node from ``conv_id``, ``turns`` (see :func:`conversations`); ``conv_id`` is the smallest member and occurs once."""
    rows = store(convs.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars")), "conversations")
    size = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    ranges = min(RANGES, max(1, -(-size // CHUNK)))
    nodes = store(rows.repartitionByRange(ranges, "ids", "conv_id").sortWithinPartitions("ids", "conv_id").mapInArrow(_trie, NODE_DDL), "nodes")
    edges = nodes.where("key is not null")
    inner = nodes.where("key is null")
    up = edges.groupBy(F.col("key").alias("parent_key")).agg(F.min("conv_id").alias("above"))
    hung = inner.where("parent_key is not null").drop("parent_conv_id").join(up, "parent_key").withColumnRenamed("above", "parent_conv_id")
    return inner.where("parent_key is null").select(*COLUMNS).unionByName(hung.select(*COLUMNS)).unionByName(_boundary(edges))
