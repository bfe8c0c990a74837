"""Exact top-k search by inner product, by no-random-access aggregation.

Queries and candidates are dealt to a grid of blocks. In a block every dimension has a list of the candidates sorted by their component. A query reads the lists sequentially, each from the end that its own component favours, in steps: a step reads each list as far as brings its open gap (what the next entry could still add above the least) down to one level for all. A candidate's score lies between what was read of it plus the least that its unread lists can add, and the same plus their frontiers. Candidates whose upper bound is below the k-th best lower bound (of this and earlier blocks) are outsiders for good. Steps go on until few candidates are left or the lists are at their ends; the tails of the lists are then read on for these few only, which makes their scores final. No candidate's vector is ever looked up. The k best of each block meet per query.

Vectors that are null or hold null or non-finite components take no part, nor do rows without an id; shorter vectors are filled up with zeros, an empty vector scores 0. Every row but those with the query's id is a candidate; repeated rows count once each. Ties go to the smaller id. Components times the scale that don't fit 64-bit integers saturate, and so do scores. Where sums may leave the doubles' exact integers, scores are computed in whole, by exact integers. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 8192
QUERY_BLOCK = 512
LEVELS = (0.15, 0.05, 0.025, 0.0)  # of the widest list's range
LEFT = 16  # a block's candidates are few when one of so many is left


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component; null for vectors that take no part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(good, F.lit(False)), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Lists:
    """Sorted lists of a block of candidates."""

    def __init__(self, ids: np.ndarray, X: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.X = ids[order], np.ascontiguousarray(X[order])
        self.order = np.argsort(self.X, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.X.T, self.order, axis=1).astype(np.float64)
        self.most = float(np.abs(self.X.astype(np.float64)).max(initial=0))
        self.unread = np.ones(self.X.T.shape, np.float32)  # one for all queries, made anew for each
        self.read, self.finished = 0, 0  # entries read before the steps ended, and candidates left then

    def search(self, q: np.ndarray, own: int, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The k best (-score, id) of this block and of those found before."""
        m, d = self.X.shape
        weights = q.astype(np.float64)
        reach = self.most * float(np.abs(weights).max(initial=0)) * d
        if reach >= 2**52:
            return self._whole(q, own, k, best, reach < 2**62)
        active = np.flatnonzero(weights)
        low = np.where(weights > 0, self.values[:, 0], self.values[:, -1]) * weights  # what a list adds at least
        high = np.where(weights > 0, self.values[:, -1], self.values[:, 0]) * weights
        widest = float((high - low).max(initial=0))
        partial = np.full(m, low.sum())  # what was read, above the least of each list
        unread = self.unread
        unread.fill(1)
        depth = np.zeros(d, np.int64)
        alive = np.flatnonzero(self.ids != own)
        earlier = np.array([-s for s, _ in best], np.float64)
        frontier = np.zeros(d)
        for level in LEVELS:
            if len(alive) <= max(2 * k, m // LEFT):
                break
            gap = level * widest
            for j in active.tolist():
                w, values = weights[j], self.values[j]
                # entries whose contribution exceeds the least by more than the gap
                if w > 0:
                    to = m - int(values.searchsorted((low[j] + gap) / w, side="right"))
                    new = slice(m - to, m - depth[j])
                else:
                    to = int(values.searchsorted((low[j] + gap) / w, side="left"))
                    new = slice(depth[j], to)
                if to > depth[j]:
                    rows = self.order[j, new]  # each candidate once
                    unread[j][rows] = 0
                    partial[rows] += values[new] * w - low[j]
                    depth[j] = to
                frontier[j] = 0.0 if depth[j] == m else values[m - depth[j] - 1 if w > 0 else depth[j]] * w - low[j]
            lower = partial[alive]
            upper = lower + (frontier.astype(np.float32) @ unread)[alive] * (1 + 1e-5) + 1.0  # above what single precision may lose
            both = np.concatenate([earlier, lower])
            if len(both) > k:
                alive = alive[upper >= np.partition(both, len(both) - k)[len(both) - k]]
        self.read += int(depth.sum())
        self.finished += len(alive)
        # the tails, for those that are left
        place = np.full(m, -1)
        place[alive] = np.arange(len(alive))
        scores = partial[alive]
        for j in active:
            if depth[j] < m:
                tail = slice(0, m - depth[j]) if weights[j] > 0 else slice(depth[j], m)
                at = place[self.order[j, tail]]
                hit = np.flatnonzero(at >= 0)
                scores[at[hit]] += self.values[j, tail][hit] * weights[j] - low[j]
        top = np.argsort(-scores, kind="stable")[:k]  # rows stand by id
        return _merge(best, [(-int(scores[t]), int(self.ids[alive[t]])) for t in top], k)

    def _whole(self, q: np.ndarray, own: int, k: int, best: list, fits: bool) -> list[tuple[int, int]]:
        """All scores, by exact integers."""
        scores = (self.X @ q if fits else self.X.astype(object) @ q.astype(object)).tolist()
        return _merge(best, [(-int(s), int(i)) for s, i in zip(scores, self.ids, strict=True) if i != own], k)


def _merge(a: list, b: list, k: int) -> list:
    return sorted([*a, *b])[:k]


def top_k(vectors: DataFrame, queries: Column, k: int = 10, scale: int = 1024, chunk: int = CHUNK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that `queries` selects against all rows."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("x"), F.coalesce(queries, F.lit(False)).alias("is_query")).filter("x is not null and vec_id is not null")
    total = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    across, down = max(1, -(-total.n // chunk)), max(1, -(-total.q // query_block))
    place = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.filter("is_query").select(place(down, 1).alias("qb"), every(across).alias("cb"), F.lit(0).alias("kind"), "vec_id", "x")
    offered = rows.select(every(down).alias("qb"), place(across, 2).alias("cb"), F.lit(1).alias("kind"), "vec_id", "x")

    def run(batches):
        cell, asked, found, held, size = None, [], {}, [], 0

        def matrix(lists, width):
            out = np.zeros((len(lists), width), np.int64)
            for i, x in enumerate(lists):
                out[i, : len(x)] = x
            return out

        def consume():
            nonlocal held, size
            if held and asked:
                ids = np.concatenate([i for i, _ in held])
                vectors = [x for _, xs in held for x in xs]
                width = max(1, max(map(len, vectors)), max(len(x) for _, x in asked))
                lists = Lists(ids, matrix(vectors, width))
                for n, (qid, x) in enumerate(asked):
                    found[n] = lists.search(matrix([x], width)[0], qid, k, found.get(n, []))
            held, size = [], 0

        def finish():
            consume()
            out = [(asked[n][0], n, i, min(max(-s, -(2**63)), 2**63 - 1)) for n, best in found.items() for s, i in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "query_row", "vec_id", "score"])

        for batch in batches:
            qb, cb, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("qb", "cb", "kind"))
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            xs = batch.column("x")
            cuts = [0, *(np.flatnonzero((np.diff(qb) != 0) | (np.diff(cb) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                here = (int(qb[a]), int(cb[a]))
                if here != cell:
                    yield from finish()
                    cell, asked, found = here, [], {}
                offsets = xs.slice(a, b - a)
                parts = np.split(offsets.flatten().to_numpy(zero_copy_only=False), np.cumsum(offsets.value_lengths().to_numpy(zero_copy_only=False))[:-1])
                if kind[a] == 0:
                    asked += list(zip(ids[a:b].tolist(), parts, strict=True))
                else:
                    for at in range(0, b - a, chunk):
                        held.append((ids[a + at : min(b, a + at + chunk)], parts[at : at + chunk]))
                        size += len(held[-1][0])
                        if size >= chunk:
                            consume()
        yield from finish()

    both = asked.unionByName(offered).repartition(across * down, "qb", "cb").sortWithinPartitions("qb", "cb", "kind", "vec_id")
    best = both.mapInArrow(run, "query_id long, query_row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
