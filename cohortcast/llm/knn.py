"""Exact top-k search: a Voronoi kNN join on integer inner products.

Queries and data are grouped by their nearest of a few pivots.  Each group is
summarised: its size and the ``k`` + 1 vectors nearest its pivot.  Scores
against the summaries bound every query's k-th best score from below; for a
vector x of group j, with pivot p and distance d = |x - p|,

    q.x = q.p + q.(x - p) <= q.p + |q| d

bounds its score from above.  So x can matter to a query group only where d is
at least the least (bound - q.p) / |q| of its queries: x is replicated to those
groups and to no other, and each group is solved on its own.  Groups with few
queries are merged first (:func:`merge_cells`): what several of them need moves
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast.llm.common import staged
from cohortcast.llm.vectors import ranked, usable

#: Pivots, the bounded sample they are fitted on, rows of a group's data and
#: queries that one task solves together.
PIVOTS, PIVOT_SAMPLE, DATA_ROWS, QUERY_ROWS = 48, 2000, 16384, 4096
SCALE = 1024
RESULT = "query_id long, rank int, vec_id long, score long"
_EXACT = float(1 << 53)


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres of a sample by Lloyd's rounds from every len/n-th vector."""
    if not len(sample):
        return np.zeros((0, sample.shape[1] if sample.ndim == 2 else 0))
    pivots = np.unique(sample[:: max(1, len(sample) // n)][:n], axis=0)
    for _ in range(rounds):
        near = _distances(sample, pivots).argmin(1)
        pivots = np.stack([sample[near == k].mean(0) if (near == k).any() else pivots[k] for k in range(len(pivots))])
    return np.unique(pivots, axis=0)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T
    return np.sqrt(square.clip(0))


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products (queries, vectors), exact: in doubles while every
    partial sum fits one, in integers of any size beyond; int64 at the ends."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < _EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(int(s), low), high) for s in row] for row in q.astype(object) @ x.astype(object).T],
                    np.int64).reshape(len(q), len(x))


def best(scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int):
    """(query row, column) of each query's k best, ties to the smaller id."""
    for i, row in enumerate(scores):
        at = np.flatnonzero(ids != query_ids[i])
        if len(at) > k:  # everything that ties with the k-th stays until sorted
            at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
        for j in at[np.lexsort((ids[at], -row[at]))][:k]:
            yield i, j


def merge_cells(centres: np.ndarray, queries: dict[int, int]) -> list[int]:
    """The group of each cell: cells are walked from pivot to nearest pivot
    and share a group while it has QUERY_ROWS queries at most."""
    group, rows, n = [0] * len(centres), 0, 0
    left, at = set(range(len(centres))), 0
    while left:
        left.discard(at)
        here = queries.get(at, 0)
        if rows and rows + here > QUERY_ROWS:
            n, rows = n + 1, 0
        group[at], rows = n, rows + here
        if left:
            near = sorted(left)
            at = near[int(_distances(centres[near], centres[at:at + 1])[:, 0].argmin())]
    return group


def _rows(batch: pa.RecordBatch | pa.Table, column: str) -> np.ndarray:
    """A column of equal-length lists as a matrix."""
    c = batch.column(column)
    lists = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def search(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best candidates of each query.

    Components x count as floor(scale * x).  ``queries`` says of a row's ``id``
    whether it is a query; every row but those of the query's own id is its
    candidate.  Highest score first, ties to the smaller id; all candidates if
    there are fewer than k.  A repeated row is a candidate each time and asks
    once; rows of one id and different vectors ask each.  Rows with nulls and
    vectors of different lengths: see :func:`cohortcast.llm.vectors.usable`.  Scores beyond 64 bits stop at
    the ends of their range.  Extra columns are not read.
    """
    spark = vectors.sparkSession
    whole = staged(usable(vectors, id_col, vec_col, True, lambda x: F.floor(x * scale).cast("long")), "knn-vectors")
    pick = whole.orderBy(F.xxhash64("id", "vec"), "id").limit(PIVOT_SAMPLE).select("vec").collect()
    if not pick:
        return spark.createDataFrame([], RESULT)
    centres = fit_pivots(np.array([r["vec"] for r in pick], float), pivots)
    held = spark.sparkContext.broadcast(centres)  # pivots x length: fixed size

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = _distances(_rows(b, "vec").astype(float), held.value)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(near.astype("i4")), pa.array(d[np.arange(len(d)), near])],
                    names=["id", "vec", "copies", "row", "cell", "d"])

    grouped = staged(whole.mapInArrow(group, "id long, vec array<long>, copies long, row long, cell int, d double"), "knn-cells")
    # Summaries: sizes, and the vectors nearest each pivot; at most pivots x (k + 1) rows.
    size = {r["cell"]: r["n"] for r in grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    nearest = (grouped.withColumn("nth", F.row_number().over(W.partitionBy("cell").orderBy("d", "id")))
               .where(F.col("nth") <= k + 1).select("id", "vec").collect())
    summary = spark.sparkContext.broadcast((np.array([r["id"] for r in nearest], np.int64),
                                            np.array([r["vec"] for r in nearest], float).reshape(len(nearest), -1)))

    asked = grouped.where(queries)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, near = summary.value
        for b in batches:
            if not b.num_rows:
                continue
            q, own = _rows(b, "vec").astype(float), b.column("id").to_numpy()
            s = np.where(ids == own[:, None], -np.inf, q @ near.T)
            kth = np.partition(s, s.shape[1] - k, 1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(q), -np.inf)
            norm = np.sqrt((q * q).sum(1))
            slack = 1e-9 * (1 + np.abs(kth) + norm * np.sqrt((held.value ** 2).sum(1)).max(initial=0))
            need = kth[:, None] - slack[:, None] - q @ held.value.T
            # a zero query scores 0 everywhere: it needs all that can tie
            least = np.where(norm[:, None] > 0, need / np.maximum(norm, 1e-300)[:, None], -np.inf)
            cell = b.column("cell").to_numpy()
            for c in np.unique(cell):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held.value), c, "i4")), pa.array(np.arange(len(held.value), dtype="i4")),
                     pa.array(least[cell == c].min(0))], names=["asks", "cell", "least"])

    # Cells with few queries are asked together: a vector goes once to a merged
    # group, where it went to each of its cells.
    query_rows = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    merged = merge_cells(centres, query_rows)
    # pivots x pivots numbers at most
    need = asked.mapInArrow(bounds, "asks int, cell int, least double").groupBy("asks", "cell").agg(F.min("least").alias("least"))
    n_cells, n_groups = len(centres), max(merged) + 1
    least = np.full((n_groups, n_cells), np.inf)
    for r in need.collect():
        at = merged[r["asks"]], r["cell"]
        least[at] = min(least[at], r["least"])
    reach = spark.sparkContext.broadcast(least)
    # No group's data is larger than the cells it may draw on; a zero query's (-inf) may draw on all.
    splits = [max(1, -(-sum(n for c, n in size.items() if least[a, c] < np.inf) // DATA_ROWS)) for a in range(n_groups)]
    group_rows = np.bincount(merged, [query_rows.get(c, 0) for c in range(n_cells)], n_groups).astype(int).tolist()
    turns = [max(1, -(-n // QUERY_ROWS)) for n in group_rows]

    kept = ["id", "vec", "copies", "row"]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, d = b.column("cell").to_numpy(), b.column("d").to_numpy()
            row, asks = np.nonzero(d[:, None] * (1 + 1e-12) + 1e-9 >= reach.value[:, cell].T)
            for at in range(0, len(row), 8192):
                r = row[at:at + 8192]
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(r)) for c in kept),
                                                  pa.array(asks[at:at + 8192].astype("i4"))], names=[*kept, "asks"])

    of = lambda table, col: F.element_at(F.array(*map(F.lit, table)), F.col(col) + 1) if table else F.lit(1)
    spread = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")
    data = (grouped.mapInArrow(replicate, "id long, vec array<long>, copies long, row long, asks int")
            .withColumn("part", spread(of(splits, "asks"), 1))
            .withColumn("turn", F.explode(F.sequence(F.lit(0), of(turns, "asks") - 1))).withColumn("asked", F.lit(False)))
    ask = (asked.withColumn("asks", of(merged, "cell")).drop("cell").withColumn("turn", spread(of(turns, "asks"), 2))
           .withColumn("part", F.explode(F.sequence(F.lit(0), of(splits, "asks") - 1))).withColumn("asked", F.lit(True)))
    cols = ["asks", "part", "turn", "asked", *kept]

    def solve(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy()
        q, x = table.filter(pa.array(asked)), table.filter(pa.array(~asked))
        asks, gets, score = [], [], []
        if q.num_rows and x.num_rows:
            ids, own, xs = x.column("id").to_numpy(), q.column("id").to_numpy(), _rows(x, "vec")
            for k0 in range(0, q.num_rows, 256):
                scores = inner(_rows(q.slice(k0, 256), "vec"), xs)
                for i, j in best(scores, ids, own[k0:k0 + 256], k):
                    asks.append(k0 + i)
                    gets.append(j)
                    score.append(scores[i, j])
        asks, gets = pa.array(asks, pa.int64()), pa.array(gets, pa.int64())
        return pa.table([q.column("id").take(asks), q.column("row").take(asks), x.column("id").take(gets), x.column("copies").take(gets),
                         pa.array(score, pa.int64())], names=["query_id", "row", "vec_id", "copies", "score"])

    found = (data.select(cols).unionByName(ask.select(cols)).groupBy("asks", "part", "turn")
             .applyInArrow(solve, "query_id long, row long, vec_id long, copies long, score long"))
    return ranked(found, k)


#: DuckDB twin of the registered search of ``embeddings``: all products.
ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
asks AS (SELECT min(r) AS r FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id, vec),
c AS (SELECT r, vec_id, unnest(vec) AS x, generate_subscripts(vec, 1) AS i FROM v),
s AS (SELECT q.r AS asked, q.vec_id AS query_id, d.r, d.vec_id, sum(q.x * d.x)::BIGINT AS score
      FROM c q JOIN c d ON q.i = d.i AND q.vec_id <> d.vec_id WHERE q.r IN (SELECT r FROM asks) GROUP BY ALL)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""
