"""Similarity join on sets of word n-grams, with rare-first prefixes, to components of similar documents.

1. A pass over the texts gives every document's set size and a digest of its set; documents with equal sets form one
   *node*. The same pass counts, in a sketch of fixed size, in how many documents an n-gram occurs (too high at times,
   never too low). The sketch only ranks n-grams: any total order gives the same links.
2. A set's n-grams are ordered rare first. Sets that reach the threshold share one of the first ``n - ceil(t n) + 1``, so only these
   are joined. N-grams in a single node's prefix are dropped.
3. Pairs are tried in three steps: in each n-gram's list the nodes against one of them, first the one with the fewest n-grams of its own, then a changing
   one, and last all pairs that are still in different components. So a large group of near copies takes work in proportion to its size,
   and no pair that could join two components is left out.
4. A pair has to pass the length filter and the positional filter at its first common n-gram; then the sets themselves are
   fetched, the suffix filter splits what follows the prefix and bounds the overlap, and the intersection is counted, once per pair.

A text without words has an empty set and no links; one with fewer words than ``n`` has its whole sequence as only
n-gram. A null or repeated ``doc_id`` does no harm: each row is judged by its own text, and a null is never the smallest id
(a component without any other id has a null one).
Very long texts are cut into words by pieces. Equal sets are one node. An empty table gives no rows. Further columns are ignored, or kept whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from scriptorium.llm.anchors import keyed
from scriptorium.llm.common import Hashes, IdFilter, bounds, forget, freeing, grams, holding, may_be_in, mix, skipping, slices, store, to_batch, unused
from scriptorium.llm.components import roots

#: Slots of the sketch that ranks n-grams (a power of two), and the pieces it travels in.
SLOTS_LOG2, PIECES = 24, 64
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 19
_BLANK = re.compile(rb"[\x09-\x0d\x20]")


def word_hashes(text: bytes, hashes: Hashes) -> np.ndarray:
    """Hashes of a text's words in lower case, ``PIECE`` bytes at a time, so that a very long text is never a list of all its words.

    ``bytes.split`` cuts at the six ASCII blanks, as the words are defined.
    """
    if len(text) <= PIECE:
        return hashes.of(text.lower().split())
    parts, at = [], 0
    while at < len(text):
        blank = _BLANK.search(text, at + PIECE)
        end = blank.start() if blank else len(text)
        parts.append(hashes.of(text[at:end].lower().split()))
        at = end
    return np.concatenate(parts)


def shingle_sets(texts: list[bytes], k: int, hashes: Hashes) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word ``k``-grams."""
    each = [word_hashes(t, hashes) for t in texts]
    at, h = bounds([len(x) for x in each]), np.concatenate(each)
    g = grams(h, k)
    out = []
    for i in range(len(texts)):
        a, b = at[i], at[i + 1]
        if b - a >= k:
            out.append(np.unique(g[a:b - k + 1]))
        elif b > a:
            out.append(mix(grams(h[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def node_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


_FIRST = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("piece", pa.int32()), ("counts", pa.binary())])


def _first_pass(k: int):
    def run(batches):
        hashes, counts = Hashes(), np.zeros(1 << SLOTS_LOG2, np.uint16)
        for batch in batches:
            digests, base = batch.column("digest"), 0
            for ids, texts in slices(batch, 2 << 20):
                sets = shingle_sets(texts, k, hashes)
                slots, n = np.unique(_slot(np.concatenate(sets)), return_counts=True)
                counts[slots] = np.minimum(counts[slots] + n, 65535)
                yield to_batch(_FIRST, doc_id=ids, digest=digests[base:base + len(ids)], n=[len(s) for s in sets], node=[node_of(s) if len(s) else None for s in sets],
                               piece=[None] * len(ids), counts=[None] * len(ids))
                base += len(ids)
        pack = zstandard.ZstdCompressor(level=1)
        for p, piece in enumerate(counts.reshape(PIECES, -1)):
            if piece.any():
                yield to_batch(_FIRST, doc_id=[None], digest=[None], n=[None], node=[None], piece=[p], counts=[pack.compress(piece.tobytes())])
    return run


def _ranks(first: DataFrame) -> np.ndarray:
    """The merged sketch as one byte per slot, on a logarithmic scale. Its size is fixed."""
    size = (1 << SLOTS_LOG2) // PIECES

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for p, raw in zip(b.column("piece").to_pylist(), b.column("counts").to_pylist()):
                own = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint16)
                total[p] = total.get(p, np.zeros(size, np.uint32)) + own
        for p, c in total.items():
            ranks = np.minimum(255, 8 * np.log2(1.0 + c)).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"piece": pa.array([p], pa.int32()), "ranks": pa.array([ranks.tobytes()])})

    rows = first.where("piece is not null").select("piece", "counts").repartition(PIECES, "piece").mapInArrow(merge, "piece int, ranks binary").collect()
    out = np.zeros(1 << SLOTS_LOG2, np.uint8)
    for r in rows:
        out[r.piece * size:(r.piece + 1) * size] = np.frombuffer(r.ranks, np.uint8)
    return out


_PREFIX = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])


def _prefixes(k: int, num: int, den: int, ranks):
    def run(batches):
        hashes, rank = Hashes(), ranks.value
        for batch in batches:
            for ids, texts in slices(batch, 2 << 20):
                rows = [(i, s) for i, s in zip(ids, shingle_sets(texts, k, hashes)) if len(s)]
                first = []
                for _, s in rows:
                    ordered = s[np.argsort(rank[_slot(s)], kind="stable")]
                    first.append(ordered[:len(s) + (-num * len(s)) // den + 1].view(np.int64))
                at = pa.array(bounds([len(f) for f in first]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _ in rows], pa.int64()), pa.array([node_of(s) for _, s in rows], pa.int64()),
                    pa.array([len(s) for _, s in rows], pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate(first) if first else np.empty(0, np.int64)))], schema=_PREFIX)
    return run


def _sets(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("members", pa.binary())])

    def run(batches):
        hashes = Hashes()
        for batch in batches:
            for ids, texts in slices(batch, 2 << 20):
                sets = shingle_sets(texts, k, hashes)
                yield to_batch(schema, doc_id=ids, node=[node_of(s) for s in sets], members=[s.tobytes() for s in sets])
    return run


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """At least so many members are in one of two sorted sets only: cut both at the middle of one, count the differences of size."""
    if not depth or not len(a) or not len(b):
        return abs(len(a) - len(b))
    i = len(a) // 2
    j = int(np.searchsorted(b, a[i]))
    there = int(j < len(b) and b[j] == a[i])
    return suffix_bound(a[:i], b[:j], depth - 1) + suffix_bound(a[i + 1:], b[j + there:], depth - 1) + 1 - there


def _verify(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column("ma").to_pylist(), batch.column("mb").to_pylist()
            good = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                need = -(-num * (len(x) + len(y)) // (den + num))
                ok = suffix_bound(x, y) <= len(x) + len(y) - 2 * need
                good.append(ok and _common(x, y) >= need)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["u", "v"])
    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _candidates(index: DataFrame, step: str, num: int, den: int) -> DataFrame:
    """Pairs of nodes in different components that pass the length and positional filters."""
    entry = ("node", "n", "pos", "live", "comp")
    ends = F.min("comp").alias("c0"), F.max("comp").alias("c1")
    if step == "all":
        live = index.groupBy("token").agg(*ends).where("c0 < c1").select("token")
        mine = index.join(live, "token", "left_semi")
        other = mine.select("token", *[F.col(c).alias(c + "2") for c in entry])
    else:
        # A node with few n-grams of its own is near all others of its group; else a different node for each n-gram.
        own = F.shiftleft(F.col("pos").cast("long") - F.col("live"), 44).bitwiseOR(F.shiftrightunsigned(F.xxhash64("node"), 20))
        key = own if step == "central" else F.xxhash64("node", "token")
        mine = index
        other = index.groupBy("token").agg(F.min(F.struct(key.alias("key"), *entry)).alias("best"), *ends).where("c0 < c1").select(
            "token", *[F.col(f"best.{c}").alias(c + "2") for c in entry])
    need = lambda a, b: F.ceil(F.lit(num) * (a + b) / F.lit(den + num) - F.lit(1e-9))
    # At a pair's first common n-gram, what is left of both sets has to reach the overlap; at later ones less is left.
    left = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    fits = (F.least("n", "n2") * den >= F.greatest("n", "n2") * num) & (left >= need(F.col("n"), F.col("n2"))) & (F.col("comp") != F.col("comp2"))
    if step == "all":
        fits = fits & (F.col("node") < F.col("node2"))
    smaller = F.col("node") < F.col("node2")
    return mine.join(other, (mine.token == other.token) & fits).select(
        F.when(smaller, F.col("node")).otherwise(F.col("node2")).alias("a"), F.when(smaller, F.col("node2")).otherwise(F.col("node")).alias("b")).distinct()


def similar_components(docs: DataFrame, k: int, num: int, den: int = 100) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and the text's ``digest`` for every row; sets link when ``den * intersection >= num * union``."""
    docs, spark = keyed(docs), docs.sparkSession
    first = store(docs.mapInArrow(freeing(_first_pass(k)), "doc_id long, digest long, n long, node long, piece int, counts binary"), "sets")
    rows = first.where("piece is null").select("doc_id", "digest", "n", "node")
    ranks = spark.sparkContext.broadcast(_ranks(first))
    reps = rows.where("node is not null").groupBy("node", "doc_id").agg(F.count("*").alias("n"))
    reps = store(reps.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")), "nodes")
    # One row of each node is read; only rows that may be others are joined to find out. Stored, as the n-grams of several nodes are found first and picked out then.
    spare = rows.where("node is not null").join(reps, (rows.node == reps.node) & rows.doc_id.eqNullSafe(reps.doc_id), "left_anti").select(rows.doc_id)
    spare = spare.unionByName(reps.where("n > 1").select("doc_id")).where("doc_id is not null")
    others = spark.sparkContext.broadcast(IdFilter.of(store(spare, "spare")))
    prefixes, kind = _prefixes(k, num, den, ranks), "doc_id long, node long, n long, tokens array<long>"
    perhaps = docs.mapInArrow(freeing(holding(others, prefixes)), kind)
    perhaps = perhaps.join(reps, (perhaps.node == reps.node) & perhaps.doc_id.eqNullSafe(reps.doc_id), "left_semi")
    lists = docs.mapInArrow(freeing(skipping(others, prefixes)), kind).unionByName(perhaps)
    lists = store(lists.select("node", "n", "tokens"), "prefixes")
    index = lists.select("node", "n", F.posexplode("tokens").alias("pos", "token"))
    shared = index.groupBy("token").count().where("count > 1").select("token")  # a node has an n-gram once
    # ``live`` is the number of n-grams before it in the prefix that another node has as well: only those can be shared.
    before = (F.row_number().over(Window.partitionBy("node").orderBy("pos")) - 1).cast("long")
    index = store(index.join(shared, "token", "left_semi").select("token", "node", "n", "pos", before.alias("live")), "index")
    forget(lists)
    comps, tried = None, None
    for step in ("central", "spread", "all"):
        named = index.withColumn("comp", F.col("node")) if comps is None else index.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        pairs = _candidates(named, step, num, den)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = store(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = _linked(docs, reps, pairs, k, num, den)
        if comps is not None:
            side = lambda n, c: comps.select(F.col("node").alias(n), F.col("comp").alias(c))
            links = links.join(side("u", "cu"), "u", "left").join(side("v", "cv"), "v", "left").select(
                F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
        found = roots(links)
        if comps is None:
            comps = found.select("node", F.col("root").alias("comp"))
        else:
            moved = comps.join(found.select(F.col("node").alias("comp"), "root"), "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
            fresh = found.join(comps, "node", "left_anti").select("node", F.col("root").alias("comp"))
            comps = moved.unionByName(fresh)
        comps = store(comps, "components")
    named = reps.drop("n")
    named = named.withColumn("comp", F.col("node")) if comps is None else named.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    low = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    members = named.select("node", "comp").join(low, "comp").select("node", "component_id")
    alone = rows.where("node is null").withColumn("component_id", F.col("doc_id"))
    joined = rows.where("node is not null").join(members, "node")
    columns = "doc_id", F.col("n").alias("n_shingles"), "component_id", "digest"
    return joined.select(*columns).unionByName(alone.select(*columns))


def _linked(docs: DataFrame, reps: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs that reach the threshold. Only the texts of their nodes are cut into n-grams again."""
    spark = docs.sparkSession
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = store(reps.select("node", "doc_id").join(nodes, "node"), "wanted")
    ids = spark.sparkContext.broadcast(IdFilter.of(wanted.select("doc_id").where("doc_id is not null")))
    # Sets of other nodes that the filter lets through meet no pair. A set may be there twice: its row is, or a copy of it passed the filter.
    sets = store(docs.mapInArrow(freeing(holding(ids, _sets(k))), "doc_id long, node long, members binary").select("node", "members"), "members")
    if not sets.groupBy("node").count().where("count > 1").isEmpty():
        every = sets
        sets = store(every.dropDuplicates(["node"]), "members")
        forget(every)
    left, right = (sets.select(F.col("node").alias(n), F.col("members").alias(m)) for n, m in (("a", "ma"), ("b", "mb")))
    links = store(pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb").mapInArrow(freeing(_verify(num, den)), "u long, v long"), "links")
    forget(sets, wanted)
    ids.destroy()
    return links


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs``, with all columns, whose id is the smallest of their component; repeats of such a row go as well.

    Rows without an id stay. Only rows that the filter of dropped ids can't rule out are shuffled.
    """
    spark = docs.sparkSession
    found = store(similar_components(docs, k, num, den).where("doc_id is not null").select("doc_id", "digest", "component_id"), "found")
    own, same, gone = unused(docs, "__id", "__digest", "__gone")
    touched = found.groupBy("doc_id", "digest").agg(F.max(F.col("doc_id") != F.col("component_id")).alias(gone), F.count("*").alias("n"))
    touched = store(touched.where(F.col(gone) | (F.col("n") > 1)).select(F.col("doc_id").alias(own), F.col("digest").alias(same), gone), "touched")
    ids = spark.sparkContext.broadcast(IdFilter.of(touched.select(own)))
    key = (F.col("doc_id").cast("long") == F.col(own)) & (F.xxhash64(F.col("text").cast("string")) == F.col(same))
    rest = docs.where(may_be_in(ids, "doc_id")).join(touched, key, "left").where(F.col(gone).isNull() | ~F.col(gone))
    once = rest.where(F.col(own).isNull()).unionByName(rest.where(F.col(own).isNotNull()).dropDuplicates(["doc_id", "text"]))
    return docs.where(~may_be_in(ids, "doc_id")).unionByName(once.drop(own, same, gone))
