"""Vector searches against brute force."""

from collections import Counter

import numpy as np
import pytest

from cohortcast.llm import graphs, knn
from cohortcast.llm.vectors import divisible


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, rank string").repartition(4)


def clustered(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(8, d))[rng.integers(0, 8, n)] + 0.5 * rng.normal(size=(n, d))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def odd(d=16):
    one = [1.0] + [0.0] * (d - 1)
    return [(10_000, None), (10_020, [float("nan")] + one[1:]), (10_040, [None] + one[1:]), (10_060, [float("inf")] + one[1:]),
            (10_080, [0.0] * d), (None, one), (10_100, [1.0, 2.0]), (10_120, one), (10_120, one), (10_140, one), (10_140, one[::-1]), *[(20_000 + k, one) for k in range(300)]]


def best(rows, by, k, measure):
    """Of each id that asks the sorted answers: one a different vector."""
    x = np.array([v for _, v in rows], np.float32).astype(float)
    ids, x = np.array([i for i, _ in rows]), measure(x)
    out = {}
    for q in np.flatnonzero(ids % by == 0):
        s = x @ x[q]
        at = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        out.setdefault(int(ids[q]), {})[tuple(x[q])] = [(int(ids[j]), s[j]) for j in at]
    return {i: sorted(answers.values()) for i, answers in out.items()}


def answers(rows):
    """The same of result rows; two vectors of one id have the same ranks, in any order."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, {}).setdefault(r.rank, []).append((r.vec_id, r.score))
    for ranks in out.values():
        assert [*ranks] == [*range(1, len(ranks) + 1)]
    return out


def by_rank(lists):
    return [sorted(at) for at in zip(*lists)]


def taking_part(rows, zero_too):
    return [(i, v + [0.0] * (16 - len(v))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()
            and (zero_too or np.any(v))]


@pytest.mark.parametrize("data_rows,query_rows", [(16384, 4096), (100, 10)])
def test_knn_is_exact(spark, monkeypatch, data_rows, query_rows):
    monkeypatch.setattr(knn, "DATA_ROWS", data_rows)
    monkeypatch.setattr(knn, "QUERY_ROWS", query_rows)
    rows = clustered(1200) + odd()
    got = answers(knn.search(frame(spark, rows), divisible(20), 10, pivots=12).collect())
    want = best(taking_part(rows, True), 20, 10, lambda x: np.floor(1024 * x))
    assert {i: [sorted(at) for at in ranks.values()] for i, ranks in got.items()} == {i: by_rank(lists) for i, lists in want.items()}
    assert len(got[10_140][1]) == 2 and len(got[10_120][1]) == 1 and 10_100 in got


def test_knn_zero_query_is_split(spark, monkeypatch, tmp_path):
    def watched(scores, ids, own, k, real=knn.best):
        (tmp_path / f"{int(own.min())}-{int(ids.min())}-{int(ids.max())}-{len(ids)}").touch()
        return real(scores, ids, own, k)

    monkeypatch.setattr(knn, "DATA_ROWS", 100)
    monkeypatch.setattr(knn, "best", watched)
    rows = [(i + 1, v) for i, v in clustered(1199)] + [(5000, [0.0] * 16)]
    got = sorted(knn.search(frame(spark, rows), divisible(5000), 10, pivots=12).collect(), key=lambda r: r.rank)
    assert [(r.vec_id, r.score) for r in got] == [(i, 0) for i in range(1, 11)]
    sizes = [int(f.name.rsplit("-", 1)[1]) for f in tmp_path.iterdir()]
    assert len(sizes) == 12 and sum(sizes) == 1200 and max(sizes) < 200


def test_knn_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (100, [3.0, -1.0]), (7, [1e7, 1e7])]
    got = sorted(map(tuple, knn.search(frame(spark, rows), divisible(100)).collect()))
    big = int(np.floor(1024 * np.float64(1e7)))
    assert got == [(0, 1, 7, 3072 * big), (0, 2, 100, 1024 * 3072 - 2048 * 1024), (100, 1, 7, 2048 * big), (100, 2, 0, 1024 * 3072 - 2048 * 1024)]
    assert knn.search(frame(spark, rows).limit(0), divisible(100)).count() == 0


def test_inner_is_exact_beyond_doubles():
    q, x = np.array([[(1 << 30) + 1, 3]]), np.array([[(1 << 30) - 1, 1], [1 << 40, 0]])
    assert knn.inner(q, x).tolist() == [[((1 << 30) + 1) * ((1 << 30) - 1) + 3, min(((1 << 30) + 1) << 40, (1 << 63) - 1)]]


@pytest.mark.parametrize("shard_rows", [8192, 400])
def test_graph_recall(spark, shard_rows):
    rows = clustered(1500, seed=3) + odd()
    want = best(taking_part(rows, False), 20, 20, lambda x: x)
    got = answers(graphs.search(frame(spark, rows), divisible(20), 20, shard_rows=shard_rows).collect())
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert len(got[10_140][1]) == 2 and len(got[10_120][1]) == 1 and 10_100 in got
    flat = {q: Counter(f for at in ranks.values() for f in at) for q, ranks in got.items()}
    hits = sum(min(n, flat[q][f]) for q, lists in want.items() for f, n in Counter(f for at in lists for f in at).items())
    assert hits / sum(len(at) for lists in want.values() for at in lists) > 0.95
    for q, ranks in got.items():
        found = [at[0] for at in ranks.values()]
        assert q not in dict(found) and (len(ranks[1]) > 1 or found == sorted(found, key=lambda f: (-f[1], f[0])))


def test_graph_recall_at_a_full_shard():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 64))[rng.integers(0, 40, graphs.SHARD_ROWS)] * 0.15 + 0.125 * rng.normal(size=(graphs.SHARD_ROWS, 64))
    ids, asks = np.arange(len(x)), np.arange(0, len(x), 20)
    out = graphs.Shard(ids, x).search(asks, x[asks], 20, graphs.SEARCH_BEAM)
    scores = x[asks] @ x.T
    scores[np.arange(len(asks)), asks] = -np.inf
    want = np.argsort(-scores, 1)[:, :20]
    got = [set(np.array(out[1])[np.array(out[0]) == k]) for k in range(len(asks))]
    hits = np.array([len(g & set(w)) for g, w in zip(got, want)])
    assert hits.mean() / 20 > 0.9 and hits.min() >= 5, (hits.mean() / 20, hits.min())


def test_graph_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0]), (20, [3.0, -1.0]), (7, [1.0, 2.0])]
    got = sorted(map(tuple, graphs.search(frame(spark, rows), divisible(20)).collect()))
    assert got == [(0, 1, 7, 5.0), (0, 2, 20, 1.0), (20, 1, 0, 1.0), (20, 2, 7, 1.0)]
    assert graphs.search(frame(spark, rows).limit(0), divisible(20)).count() == 0


def test_repeated_rows_and_lengths(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (7, [2.0, 1.0]), (7, [2.0, 1.0]), (7, [2.0, 1.0]), (8, [4.0]), (9, [1.0, 1.0, 1.0]), (100, [0.0, 1.0])]
    want = [(0, 1, 7, 4.0), (0, 2, 7, 4.0), (0, 3, 7, 4.0), (0, 4, 8, 4.0), (0, 5, 9, 3.0), (0, 6, 100, 2.0)]
    got = sorted(map(tuple, graphs.search(frame(spark, rows), divisible(100), 6).collect()))
    assert [r for r in got if r[0] == 0] == want
    # both rows of 0 are candidates, the zero product comes last
    assert [r[2:] for r in got if r[0] == 100] == [(0, 2.0), (0, 2.0), (7, 1.0), (7, 1.0), (7, 1.0), (9, 1.0)]
    exact = sorted(map(tuple, knn.search(frame(spark, rows), divisible(100), 6, scale=1).collect()))
    assert exact == got


def test_knn_query_equals_sql(spark):
    from cohortcast.llm import queries
    from compare import compare, duck
    folder = "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), "op9_voronoi_knn", folder, queries.op9_voronoi_knn, queries.oracle_sql()["op9_voronoi_knn"])


def test_cells_with_few_queries_are_merged(spark, monkeypatch):
    centres = np.arange(12, dtype=float)[:, None]
    monkeypatch.setattr(knn, "QUERY_ROWS", 10)
    group = knn.merge_cells(centres, {0: 4, 1: 4, 2: 4, 5: 25, 6: 1, 11: 9})
    assert group == [0, 0, 1, 1, 1, 2, 3, 3, 3, 3, 3, 3]
    assert knn.merge_cells(centres, {}) == [0] * 12
    rows = clustered(900)
    got = answers(knn.search(frame(spark, rows), divisible(7), 10, pivots=12).collect())
    assert {i: [*ranks.values()] for i, ranks in got.items()} == {i: by_rank(lists) for i, lists in best(rows, 7, 10, lambda x: np.floor(1024 * x)).items()}
