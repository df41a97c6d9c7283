"""Approximate nearest neighbours: robust-pruned directed graphs, in shards.

Rows are dealt to shards by hash.  In each shard a directed graph is grown:
greedy beam searches from an entry point propose neighbours for the next
points; relaxed distance pruning keeps, nearest first, a neighbour only if no
kept one is nearer to it by the factor alpha, so edges point in diverse
directions; back edges are added and pruned in turn.  A beam search along the
edges, from the nearest of a few hundred points, then answers each query in
every shard, and the best of all shards stay.

The measure is the largest inner product.  With one more component,
sqrt(M^2 - |x|^2) for data and 0 for queries, it orders like the distance.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcast.llm.common import staged
from cohortcast.llm.knn import _rows
from cohortcast.llm.vectors import ranked, usable

#: Rows of a shard, and queries a task searches a shard for.
SHARD_ROWS, QUERY_ROWS = 8192, 4096
#: Out-edges of a point, beam of construction and of search, pruning factor.
DEGREE, BUILD_BEAM, SEARCH_BEAM, ALPHA = 28, 48, 128, 1.2
#: Points that a search may start from, and the nearest of them that it does.
START_POINTS, STARTS = 256, 8
#: Points inserted or queries searched side by side, beam entries expanded at once.
LANES, EXPAND = 256, 4


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int | np.ndarray, queries: np.ndarray, width: int):
    """(ids, squared distances) of the ``width`` nearest points met from the
    entry, or from a row of entries for each query, nearest first; -1 fills up.
    All queries advance side by side."""
    n, lanes = len(points), len(queries)
    norms = (points * points).sum(1)
    ids = np.full((lanes, width), -1, np.int64)
    dist = np.full((lanes, width), np.inf, np.float32)
    done = np.zeros((lanes, width), bool)
    seen = np.zeros((lanes, n), bool)
    rows = np.arange(lanes)
    start = np.full((lanes, 1), entry) if np.ndim(entry) == 0 else entry
    ids[:, :start.shape[1]], seen[rows[:, None], start] = start, True
    dist[:, :start.shape[1]] = norms[start] - 2 * np.einsum("ijk,ik->ij", points[start], queries)
    while len(rows):
        open_ = np.where(done[rows] | (ids[rows] < 0), np.inf, dist[rows])
        some = min(EXPAND, width)
        at = np.argpartition(open_, some - 1, 1)[:, :some]
        live = np.isfinite(np.take_along_axis(open_, at, 1))
        going = live.any(1)
        rows, at, live = rows[going], at[going], live[going]
        if not len(rows):
            break
        done[rows[:, None], at] |= live
        near = np.where(live[:, :, None], edges[ids[rows[:, None], at]], -1).reshape(len(rows), -1)
        near.sort(1)
        new = (near >= 0) & ~seen[rows[:, None], near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[rows[:, None], np.where(new, near, start[rows, :1])] = True
        # distances of the new ones only
        r, c = np.nonzero(new)
        d = np.full(near.shape, np.inf, np.float32)
        met = near[r, c]
        d[r, c] = norms[met] - 2 * np.einsum("ij,ij->i", points[met], queries[rows[r]])
        all_d = np.concatenate([dist[rows], d], 1)
        order = np.argsort(all_d, 1, kind="stable")[:, :width]
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(new, near, -1)], 1), order, 1)
        dist[rows] = np.take_along_axis(all_d, order, 1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], np.zeros_like(new)], 1), order, 1)
    return ids, dist


def robust_prune(points: np.ndarray, at: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` of each row's candidates (-1: none) for points ``at``."""
    out = np.full((len(at), degree), -1, np.int32)
    for k in range(0, len(at), 128):
        p, c = at[k:k + 128], cand[k:k + 128]
        x = points[c]  # (rows, candidates, length)
        d = ((x - points[p][:, None]) ** 2).sum(2)
        d[(c < 0) | (c == p[:, None])] = np.inf
        row = np.arange(len(p))
        for slot in range(degree):
            star = d.argmin(1)
            live = np.isfinite(d[row, star])
            if not live.any():
                break
            out[k:k + 128][live, slot] = c[row, star][live]
            between = ((x - x[row, star][:, None]) ** 2).sum(2)
            d[(alpha * alpha * between <= d) & live[:, None]] = np.inf
    return out


def grow(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5):
    """(edges, entry) of a graph over the points, inserted in random order in
    batches that double up to ``LANES``."""
    n = len(points)
    edges = np.full((n, degree), -1, np.int32)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        batch = order[done:done + min(LANES, done)]
        found, _ = beam_search(points, edges, entry, points[batch], beam)
        # neighbours within the batch are not in the graph yet: propose them too
        edges[batch] = robust_prune(points, batch, np.concatenate([found, _peers(points, batch)], 1), degree, alpha)
        src, slot = np.nonzero(edges[batch] >= 0)
        to, back = edges[batch][src, slot], batch[src]
        by = np.argsort(to, kind="stable")
        to, back = to[by], back[by]
        heads, first, count = np.unique(to, return_index=True, return_counts=True)
        for few in np.array_split(np.argsort(count, kind="stable"), max(1, len(heads) // 128)):
            if len(few):
                add = np.full((len(few), count[few].max()), -1, np.int64)
                spot = np.arange(add.shape[1])[None, :] < count[few][:, None]
                add[spot] = back[(first[few][:, None] + np.arange(add.shape[1]))[spot]]
                add[(add[:, :, None] == edges[heads[few]][:, None, :]).any(2)] = -1
                both = np.concatenate([edges[heads[few]].astype(np.int64), add], 1)
                fits = (both >= 0).sum(1) <= degree
                packed = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)[:, :degree]
                edges[heads[few][fits]] = packed[fits]
                if (~fits).any():
                    edges[heads[few][~fits]] = robust_prune(points, heads[few][~fits], both[~fits], degree, alpha)
        done += len(batch)
    return edges, entry


def _peers(points: np.ndarray, batch: np.ndarray, most: int = 8) -> np.ndarray:
    x = points[batch]
    d = ((x * x).sum(1)[None, :] - 2 * x @ x.T).astype(np.float32)
    np.fill_diagonal(d, np.inf)
    some = min(most, len(batch))
    at = batch[np.argpartition(d, some - 1, 1)[:, :some]]
    return np.where(at == batch[:, None], -1, at)


class Shard:
    """The graph of a shard; equal vectors share a point."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray | None = None):
        by = np.argsort(ids, kind="stable")
        self.vectors, self.point = np.unique(vectors[by], axis=0, return_inverse=True)
        self.point = self.point.ravel()
        order = np.argsort(self.point, kind="stable")  # ids of a point ascend
        self.copies = np.ones(len(ids), np.int64) if copies is None else copies[by][order]
        self.ids, self.begin = ids[by][order], np.searchsorted(self.point[order], np.arange(len(self.vectors) + 1))
        norms = (self.vectors ** 2).sum(1)
        self.size = max(float(np.sqrt(norms.max())), 1e-300)
        scaled = self.vectors / self.size
        self.graph = np.concatenate([scaled, np.sqrt((1 - (scaled ** 2).sum(1)).clip(0))[:, None]], 1).astype(np.float32)
        self.edges, self.entry = grow(self.graph)
        # points of all regions, so that no query starts far from its own
        self.starts = np.random.default_rng(7).permutation(len(self.graph))[:START_POINTS]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int):
        """(query row, id, copies, score) of each query's k best of what a beam meets."""
        out = ([], [], [], [])
        for at in range(0, len(queries), LANES):
            q, own = queries[at:at + LANES], query_ids[at:at + LANES]
            unit = q / np.maximum(np.sqrt((q * q).sum(1)), 1e-300)[:, None]
            flat = np.concatenate([unit, np.zeros((len(q), 1))], 1).astype(np.float32)
            near = (self.graph[self.starts] ** 2).sum(1) - 2 * flat @ self.graph[self.starts].T
            some = self.starts[np.argsort(near, 1, kind="stable")[:, :STARTS]]
            found, _ = beam_search(self.graph, self.edges, some, flat, max(beam, k + 1))
            for i, points in enumerate(found):
                points = points[points >= 0]
                score = self.vectors[points] @ q[i]
                # a point's k + 1 smallest ids are all that can be among the k best
                spans = [np.arange(self.begin[p], min(self.begin[p + 1], self.begin[p] + k + 1)) for p in points]
                spot, scores = np.concatenate(spans), np.repeat(score, [len(s) for s in spans])
                other = self.ids[spot] != own[i]
                spot, scores = spot[other], scores[other]
                best = np.lexsort((self.ids[spot], -scores))[:k]
                out[0].extend([at + i] * len(best))
                out[1].extend(self.ids[spot[best]])
                out[2].extend(self.copies[spot[best]])
                out[3].extend(scores[best])
        return out


def build(rows: DataFrame, shards: int) -> DataFrame:
    """``(shard, graph)``: one pickled :class:`Shard` a shard, of ``(id, vec, copies)``."""

    def one(table: pa.Table) -> pa.Table:
        shard = Shard(table.column("id").to_numpy(), _rows(table, "vec"), table.column("copies").to_numpy())
        return pa.table([table.column("shard").slice(0, 1), pa.array([pickle.dumps(shard)], pa.binary())], names=["shard", "graph"])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    # ranges finer than a shard end at every shard: each is built by a task of its own
    return dealt.repartitionByRange(4 * shards, "shard").groupBy("shard").applyInArrow(one, "shard int, graph binary")


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: k near neighbours of each query by
    inner product, in double precision on the vectors themselves.

    ``queries`` says of a row's ``id`` whether it is a query; every row but
    those of the query's own id is its candidate, every row is indexed.
    Nearest first, ties to the smaller id; all candidates found if there are
    fewer than k.  A repeated row is a candidate each time and asks once; rows
    of one id and different vectors ask each.  Zero vectors, rows with nulls
    and vectors of different lengths: see :func:`cohortcast.llm.vectors.usable`.  Extra columns are not read.
    """
    rows = staged(usable(vectors, id_col, vec_col, zero_too=False), "ann-vectors")
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    index = staged(build(rows, shards), "ann-graphs")
    asked = rows.where(queries)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    # The query set in blocks, each sent to every shard.
    ask = (asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int"))
           .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if left.num_rows and right.num_rows:
            shard = pickle.loads(left.column("graph")[0].as_py())
            out = shard.search(right.column("id").to_numpy(), _rows(right, "vec"), k, beam)
        asks = pa.array(out[0], pa.int64())
        return pa.table([right.column("id").take(asks), right.column("row").take(asks), pa.array(out[1], pa.int64()),
                         pa.array(out[2], pa.int64()), pa.array(out[3], pa.float64())], names=["query_id", "row", "vec_id", "copies", "score"])

    found = (graphs.groupBy("shard", "block").cogroup(ask.select("shard", "block", "id", "vec", "row").groupBy("shard", "block"))
             .applyInArrow(answer, "query_id long, row long, vec_id long, copies long, score double"))
    return ranked(found, k)
