"""Nearest neighbours by a block matrix join of int8 product tiles.

Vectors are quantised to int8 with a scale of their own; the norm of what quantisation loses is
kept. A tile multiplies a block of queries with blocks of candidates. The product gives a distance
between the quantised vectors, and the two lost norms bound how far the true distance can be from
it, by the triangle inequality. A pair survives a tile if its lower bound is no more than the k-th
smallest upper bound of its query, over the different vec_ids beside its own; survivors are computed again in double precision and kept in a
heap of k for each query. The heaps of all tiles are merged. The result is exact.

Vectors that are null, zero, or hold null or non-finite components take no part, and vectors only
meet vectors of their own length. A vec_id that repeats counts once, at its nearest, and never as
a neighbour of itself. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, mix, ship, shuffle_parts

QUERY_BLOCK = 4096
ROWS = 2048


def matrices(column, ids: np.ndarray):
    """(length, ids, float64 matrix) of the valid vectors, by length."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values
    gone = np.asarray(values.is_null()) if values.null_count else None
    flat = values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    valid = np.asarray(column.is_valid()) if column.null_count else np.ones(len(column), bool)
    for dim in np.unique(sizes[valid]).tolist():
        if not dim:
            continue
        at = np.flatnonzero(valid & (sizes == dim))
        for part in (at[k : k + ROWS] for k in range(0, len(at), ROWS)):
            where = offsets[part][:, None] + np.arange(dim)
            m = flat[where]
            ok = np.isfinite(m).all(1) & (m != 0).any(1)
            if gone is not None:
                ok &= ~gone[where].any(1)
            if ok.any():
                yield dim, ids[part[ok]], m[ok]


def quantised(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32, to multiply exactly), squared norms' scale and lost norm of each row."""
    scale = np.abs(m).max(1) / 127
    q = np.rint(m / scale[:, None])
    lost = np.sqrt(((m - q * scale[:, None]) ** 2).sum(1))
    return q.astype(np.int8), scale, lost


def survivors(a, b, k: int, limit: np.ndarray, own: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Mask of the pairs that may be among the k nearest; ``limit`` bounds the k-th distance so far,
    ``own`` and ``ids`` are the vec_ids of both sides."""
    (qa, sa, ea), (qb, sb, eb) = a, b
    kind = np.float32 if qa.shape[1] * 127 * 127 < 1 << 24 else np.float64  # whole numbers stay exact
    xa, xb = qa.astype(kind), qb.astype(kind)
    dot = (xa @ xb.T).astype(np.float64)
    na, nb = sa**2 * (xa.astype(np.float64) ** 2).sum(1), sb**2 * (xb.astype(np.float64) ** 2).sum(1)
    near = np.sqrt(np.maximum(na[:, None] + nb[None, :] - 2 * sa[:, None] * sb[None, :] * dot, 0))
    err = (ea[:, None] + eb[None, :]) * (1 + 1e-9) + 1e-7 * np.sqrt(na[:, None] + nb[None, :])
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
    if len(first) >= k:
        each = ids[order][first]
        upper = np.minimum.reduceat((near + err)[:, order], first, axis=1)  # a vec_id once, at its nearest
        at = np.minimum(np.searchsorted(each, own), len(each) - 1)
        self_ = np.flatnonzero(each[at] == own)
        upper[self_, at[self_]] = np.inf
        limit = np.minimum(limit, np.partition(upper, k - 1, axis=1)[:, k - 1])
    return near - err <= limit[:, None]


class Heaps:
    """The k nearest found so far of every query of a block."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, k: int):
        self.ids, self.m, self.k, self.q = ids, m, k, quantised(m)
        self.score = np.full((len(ids), k), np.inf)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, m: np.ndarray) -> None:
        i, j = np.nonzero(survivors(self.q, quantised(m), self.k, self.score[:, -1] * (1 + 1e-12), self.ids, ids))
        keep = self.ids[i] != ids[j]
        i, j = i[keep], j[keep]
        score = np.zeros(len(i))
        for d in range(m.shape[1]):  # in the order of the components
            score += (self.m[i, d] - m[j, d]) ** 2
        score = np.sqrt(score)
        rows = np.unique(i)
        old = np.repeat(rows, self.k)
        i, vec, score = np.concatenate([i, old]), np.concatenate([ids[j], self.vec[rows].ravel()]), np.concatenate([score, self.score[rows].ravel()])
        order = np.lexsort((score, vec, i))  # a vec_id once, at its nearest
        i, vec, score = i[order], vec[order], score[order]
        once = np.r_[True, (i[1:] != i[:-1]) | (vec[1:] != vec[:-1])] if len(i) else np.zeros(0, bool)
        i, vec, score = i[once], vec[once], score[once]
        order = np.lexsort((vec, score, i))
        i, vec, score = i[order], vec[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = (place < self.k) & np.isfinite(score)
        i, vec, score, place = i[keep], vec[keep], score[keep], place[keep]
        self.score[rows], self.vec[rows] = np.inf, np.iinfo(np.int64).max
        self.score[i, place], self.vec[i, place] = score, vec

    def rows(self) -> pa.RecordBatch:
        i, j = np.nonzero(np.isfinite(self.score))
        return pa.RecordBatch.from_arrays([pa.array(self.ids[i]), pa.array(self.vec[i, j]), pa.array(self.score[i, j])], names=["query_id", "vec_id", "score"])


TILE = "dim int, qb int, cg int, kind int, ids binary, vecs binary"


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query by Euclidean distance."""
    spark = vectors.sparkSession
    ship(spark)
    src = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), is_query.alias("q"), vectors[vector].alias("v")).where("vec_id is not null")
    blocks = max(1, math.ceil(src.where("q").count() / QUERY_BLOCK))
    groups = shuffle_parts(spark)

    def pack(batches):
        for n, b in enumerate(batches):
            ids = b.column("vec_id").to_numpy()
            asked = np.asarray(b.column("q").fill_null(False))
            out = []
            for dim, own, m in matrices(b.column("v"), ids):
                where = (int(own[0]) + n) % groups
                out += [(dim, qb, where, 1, own.tobytes(), m.tobytes()) for qb in range(blocks)]
            if asked.any():
                for dim, own, m in matrices(b.column("v").filter(pa.array(asked)), ids[asked]):
                    side = (mix(own.view(U64)) % U64(blocks)).astype(np.int64)
                    for qb in np.unique(side).tolist():
                        s = side == qb
                        out += [(dim, qb, cg, 0, own[s].tobytes(), m[s].tobytes()) for cg in range(groups)]
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:4]), *(pa.array(c, pa.binary()) for c in cols[4:])], names=["dim", "qb", "cg", "kind", "ids", "vecs"])

    def solve(batches):
        was, asked, heaps = None, [], None
        for b in batches:
            for dim, qb, cg, kind, ids, vecs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (dim, qb, cg) != was:
                    if heaps is not None:
                        yield heaps.rows()
                    was, asked, heaps = (dim, qb, cg), [], None
                ids, m = np.frombuffer(ids, np.int64), np.frombuffer(vecs, np.float64).reshape(-1, dim)
                if kind == 0:
                    asked.append((ids, m))
                elif asked:
                    if heaps is None:
                        heaps = Heaps(np.concatenate([x for x, _ in asked]), np.concatenate([x for _, x in asked]), k)
                    heaps.add(ids, m)
        if heaps is not None:
            yield heaps.rows()

    tiles = src.mapInArrow(pack, TILE).repartition(groups, "dim", "qb", "cg").sortWithinPartitions("dim", "qb", "cg", "kind")
    found = tiles.mapInArrow(solve, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
