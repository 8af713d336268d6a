"""Numpy kernels that score one block of queries against one block of catalogue rows.

Each works on a bounded block inside a task and returns only the ``k`` best per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_Q_CHUNK, _C_CHUNK, _P_CHUNK = 512, 8192, 2048
#: Squared lengths, of a longest vector, that products in single precision are right for; numbers of pairs that are worked out again at once.
_SINGLE, _REFINED = (1e-25, 1e30), 1 << 21


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long numeric lists as a float64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def best_per_query(rows: np.ndarray, cols: np.ndarray, cost: np.ndarray, k: int):
    """Keep the ``k`` cheapest (then lowest ``cols``) entries per row; adds ranks from 1."""
    order = np.lexsort((cols, cost, rows))
    rows, cols, cost = rows[order], cols[order], cost[order]
    first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)])) + 1
    keep = rank <= k
    return rows[keep], cols[keep], cost[keep], rank[keep]


def nearest(queries: np.ndarray, catalogue: np.ndarray, k: int, excluded: np.ndarray | None = None, block: int = _C_CHUNK):
    """Exact ``k`` nearest catalogue rows by squared L2: ``(row, col, distance, rank)`` arrays.

    A matrix product gives approximate distances with a known error; whatever lies within that
    error of the k-th best so far is worked out again term by term. So equal vectors get equal distances
    and ties fall to the lower catalogue position. ``excluded[i]`` is a catalogue position that
    query ``i`` must not return (-1 for none). ``block`` is how many catalogue rows are compared at once.
    """
    block = max(1, min(block, _C_CHUNK))
    c_norm = np.einsum("ij,ij->i", catalogue, catalogue)
    parts = []
    for q0 in range(0, len(queries), _Q_CHUNK):
        q = queries[q0:q0 + _Q_CHUNK]
        q_norm = np.einsum("ij,ij->i", q, q)
        bound = np.full(len(q), np.inf)  # distance of the k-th best so far
        best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for c0 in range(0, len(catalogue), block):
            c = catalogue[c0:c0 + block]
            n = c_norm[c0:c0 + block]
            approx = (-2.0 * q) @ c.T  # and the query's norm, which is no matter within a row
            approx += n
            if excluded is not None:
                at = excluded[q0:q0 + _Q_CHUNK] - c0
                hit = np.flatnonzero((at >= 0) & (at < len(c)))
                approx[hit, at[hit]] = np.inf
            limit = bound - q_norm
            if k < len(c) and not np.isfinite(bound).all():
                limit = np.minimum(limit, np.partition(approx, k - 1, axis=1)[:, k - 1])
            slack = 1e-11 * (q_norm + n.max()) + 1e-300
            near = approx <= (limit + slack)[:, None]
            if not np.isfinite(limit).all():
                near &= approx < np.inf
            r, s = np.divmod(np.flatnonzero(near), len(c))
            if not len(r):
                continue
            diff = q[r] - c[s]
            found = r, s + c0, np.einsum("ij,ij->i", diff, diff)
            *best, rank = best_per_query(*(np.concatenate(x) for x in zip(best, found)), k)
            bound[best[0][rank == k]] = best[2][rank == k]
        parts.append((best[0] + q0, best[1], best[2]))
    if not parts:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0), empty
    return best_per_query(*(np.concatenate(x) for x in zip(*parts)), k)


class Piece:
    """Some rows of a catalogue, made ready to meet many queries; ``place`` orders rows of equal distance."""

    def __init__(self, vectors: np.ndarray, place: np.ndarray):
        self.vectors, self.place = vectors, place
        self.norm = np.einsum("ij,ij->i", vectors, vectors)
        self.most = self.norm.max()
        # Single precision does where no square can pass its range; a product with a column more adds the norm.
        self.single = np.c_[vectors, self.norm].astype(np.float32).T if self.most == 0 or _SINGLE[0] < self.most < _SINGLE[1] else None


class Running:
    """The ``k`` nearest rows so far of some queries, for a catalogue that comes in pieces: ``distance`` and ``place`` by query and rank (-1: none yet).

    As in ``nearest`` a matrix product gives distances with a known error, in single precision here, and what lies within that error of the ``k``-th best
    so far, over all pieces, is worked out term by term. Rows farther than ``bound`` are of no use to a query.
    """

    def __init__(self, queries: np.ndarray, k: int, bound: np.ndarray):
        self.queries, self.k, self.bound = queries, k, bound
        self.norm = np.einsum("ij,ij->i", queries, queries)
        self.single = np.c_[-2.0 * queries, np.ones(len(queries))].astype(np.float32) if self.norm.max(initial=0) < _SINGLE[1] else None
        self.distance, self.place = np.full((len(queries), k), np.inf), np.full((len(queries), k), -1, np.int64)

    def meet(self, rows: np.ndarray, piece: Piece, hit: tuple[np.ndarray, np.ndarray]) -> None:
        """Compare the queries ``rows`` with a piece. ``hit`` has pairs, of a place in ``rows`` and a row of the piece, that don't count."""
        norm, dim = self.norm[rows], self.queries.shape[1]
        if self.single is not None and piece.single is not None:
            approx = self.single[rows] @ piece.single  # and the query's norm, which is no matter within a row
            slack = 2 * (dim + 8) * 2.0 ** -24 * (norm + 2 * piece.most)
        else:
            approx = (-2.0 * self.queries[rows]) @ piece.vectors.T
            approx += piece.norm
            slack = 1e-11 * (norm + piece.most) + 1e-300
        approx[hit] = np.inf
        limit = self.bound[rows] - norm
        unbound = np.flatnonzero(np.isinf(limit))
        if len(unbound) and self.k < approx.shape[1]:
            limit[unbound] = np.partition(approx[unbound], self.k - 1, axis=1)[:, self.k - 1]
        limit = np.nextafter((limit + slack).astype(approx.dtype), approx.dtype.type(np.inf))
        some = np.flatnonzero(approx.min(axis=1) <= limit)
        if not len(some):
            return
        approx = approx[some]
        r, s = np.divmod(np.flatnonzero((approx <= limit[some, None]) & (approx < np.inf)), approx.shape[1])
        r, step = rows[some[r]], max(1, _REFINED // dim)
        distance = np.empty(len(r))
        for at in range(0, len(r), step):
            diff = self.queries[r[at:at + step]] - piece.vectors[s[at:at + step]]
            distance[at:at + step] = np.einsum("ij,ij->i", diff, diff)
        keep = distance <= self.bound[r]
        r, place, distance = r[keep], piece.place[s[keep]], distance[keep]
        changed = np.unique(r)
        old, rank = np.nonzero(self.place[changed] >= 0)
        old = changed[old]
        best = (old, self.place[old, rank], self.distance[old, rank]), (r, place, distance)
        r, place, distance, rank = best_per_query(*(np.concatenate(x) for x in zip(*best)), self.k)
        self.place[r, rank - 1], self.distance[r, rank - 1] = place, distance
        last = rank == self.k
        self.bound[r[last]] = distance[last]


def best_overlap(q_sets: pa.Array, q_sizes: np.ndarray, c_sets: pa.Array, c_sizes: np.ndarray,
                 own: np.ndarray | None = None):
    """Best catalogue row per query by shared / (size + size - shared): ``(col, score)`` arrays.

    Sizes may exceed the listed items (the rest is known not to be shared). Equal scores fall to
    the lower catalogue position; ``own[i]`` is a position query ``i`` must not return.
    Items are numbered among those the two blocks have in common only.
    """
    vocabulary = q_sets.flatten().unique()
    q_rows, q_codes = _coded(q_sets, vocabulary)
    c_rows, c_codes = _coded(c_sets, vocabulary)
    best = np.full(len(q_sizes), -1.0)
    col = np.full(len(q_sizes), -1, dtype=np.int64)
    for c0 in range(0, len(c_sizes), _C_CHUNK):
        sizes = c_sizes[c0:c0 + _C_CHUNK].astype(np.float64)
        c_part = _part(c_rows, c_codes, c0, len(sizes))
        for q0 in range(0, len(q_sizes), _Q_CHUNK):
            n = min(_Q_CHUNK, len(q_sizes) - q0)
            shared = _shared(_part(q_rows, q_codes, q0, n), n, c_part, len(sizes), len(vocabulary))
            total = q_sizes[q0:q0 + n].astype(np.float64)[:, None] + sizes[None, :] - shared
            score = np.divide(shared, total, out=np.zeros_like(shared), where=total > 0)
            if own is not None:
                at = own[q0:q0 + n] - c0
                hit = np.flatnonzero((at >= 0) & (at < len(sizes)))
                score[hit, at[hit]] = -1.0
            top = score.argmax(axis=1)
            value = score[np.arange(n), top]
            better = value > best[q0:q0 + n]
            best[q0:q0 + n][better] = value[better]
            col[q0:q0 + n][better] = top[better] + c0
    return col, best


def _coded(sets: pa.Array, vocabulary: pa.Array):
    """Row and vocabulary number of every listed item that is in the vocabulary."""
    lengths = pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = pc.index_in(sets.flatten(), value_set=vocabulary)
    known = np.flatnonzero(pc.is_valid(codes).to_numpy(zero_copy_only=False))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    return rows[known], pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)[known]


def _part(rows: np.ndarray, codes: np.ndarray, start: int, n: int):
    lo, hi = np.searchsorted(rows, [start, start + n])
    return rows[lo:hi] - start, codes[lo:hi]


def _shared(q, n_q: int, c, n_c: int, width: int) -> np.ndarray:
    """Matrix of shared item counts: by matrix product, or by meeting items when they are sparse."""
    c_freq = np.bincount(c[1], minlength=width)
    meetings = int(c_freq[q[1]].sum())
    if meetings * 500 > n_q * n_c * width and n_q * width <= 1 << 24 and n_c * width <= 1 << 26:
        a, b = np.zeros((n_q, width), np.float32), np.zeros((n_c, width), np.float32)
        a[q] = 1.0
        b[c] = 1.0
        return (a @ b.T).astype(np.float64)
    order = np.argsort(c[1], kind="stable")
    by_code, starts = c[0][order], np.cumsum(c_freq) - c_freq
    out = np.zeros(n_q * n_c)
    step = max(1, (1 << 23) // max(1, n_c))
    for at in range(0, len(q[0]), step):
        rows, codes = q[0][at:at + step], q[1][at:at + step]
        times = c_freq[codes]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        met = by_code[np.repeat(starts[codes], times) + within]
        np.add.at(out, np.repeat(rows, times) * n_c + met, 1.0)
    return out.reshape(n_q, n_c)


def packed_sets(sets: pa.Array, vocabulary: np.ndarray) -> np.ndarray:
    """Lists of numbers that are all in the sorted ``vocabulary`` as bits, a row of bytes each."""
    lengths = pc.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
    bits = np.zeros((len(sets), len(vocabulary)), bool)
    bits[np.repeat(np.arange(len(sets)), lengths), np.searchsorted(vocabulary, sets.flatten().to_numpy(zero_copy_only=False))] = True
    return np.packbits(bits, axis=1)


def best_packed_overlap(q_bits: np.ndarray, q_sizes: np.ndarray, c_bits: np.ndarray, c_sizes: np.ndarray, width: int, own: np.ndarray):
    """``best_overlap`` for sets that hold much of a small vocabulary of ``width`` items: a matrix product of blocks that are unpacked as they are needed.

    Scores are taken in single precision first; what lies within their error of the best is divided again in double precision.
    """
    best, col = np.zeros(len(q_bits)), np.full(len(q_bits), -1, dtype=np.int64)
    unpacked = lambda bits: np.unpackbits(bits, axis=1, count=width).astype(np.float32)
    for q0 in range(0, len(q_bits), _Q_CHUNK):
        q, q_n, at = unpacked(q_bits[q0:q0 + _Q_CHUNK]), q_sizes[q0:q0 + _Q_CHUNK], own[q0:q0 + _Q_CHUNK]
        for c0 in range(0, len(c_bits), _P_CHUNK):
            shared = q @ unpacked(c_bits[c0:c0 + _P_CHUNK]).T
            c_n = c_sizes[c0:c0 + _P_CHUNK]
            rough = np.add.outer(q_n.astype(np.float32), c_n.astype(np.float32))
            rough -= shared
            np.divide(shared, rough, out=rough)
            hit = np.flatnonzero((at >= c0) & (at < c0 + len(c_n)))
            rough[hit, at[hit] - c0] = -1.0
            most = rough.max(axis=1)
            least = np.maximum(most, best[q0:q0 + len(q)]) * (1 - 1e-5)
            rows = np.flatnonzero((most > 0) & (most >= least))
            r, s = np.nonzero(rough[rows] >= least[rows, None])
            r = rows[r]
            both = shared[r, s].astype(np.float64)
            row, place, cost, rank = best_per_query(r, s, -(both / (q_n[r] + c_n[s] - both)), 1)
            better = -cost > best[q0 + row]
            best[q0 + row[better]], col[q0 + row[better]] = -cost[better], place[better] + c0
    return col, best
