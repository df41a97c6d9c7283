"""N-gram Jaccard join against a comparison of all pairs."""

import random
import re

import pytest

from cohortcast.llm import jaccard


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, (ia, x) in enumerate(sets):
        for b in range(a):
            ib, y = sets[b]
            if x and y and ia is not None and ib is not None and 100 * len(x & y) >= 75 * len(x | y):
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted((-1 if i is None else i, len(s), -1 if i is None else least[root(k)]) for k, (i, s) in enumerate(sets))


def edited(rng, words, rate):
    return [w if rng.random() > rate else f"e{rng.randrange(10 ** 6)}" for w in words]


def corpus():
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    rows = [None, "", "  \n ", "one", "One", "a b c d", "A B\tc  d", "a b c d e", "x" * 5000, "x" * 5000]
    base = text(120)
    rows += [" ".join(edited(rng, base, r)) for r in [0, 0, 0.01, 0.02, 0.03, 0.03, 0.04, 0.05, 0.06, 0.08] * 6]
    passage = text(60)
    for n in (5, 8, 10, 20, 60, 200, 400):
        rows += [" ".join(passage + text(n)) for _ in range(4)]
    for _ in range(20):
        b = text(rng.randrange(3, 90))
        rows += [" ".join(b), " ".join(b).upper(), " ".join(b[:-1]), " ".join(edited(rng, b, 0.03))]
    rows += [" ".join(base[k:] + base[:k]) for k in range(0, 120, 30)] + [" ".join(base * 3)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    out = [(i * 7 - 300, t) for i, t in zip(order, rows)]
    return out + [out[3], out[15], (out[20][0], rows[40]), (None, rows[11]), (None, None)]


@pytest.mark.parametrize("chunk", [3000, 7])
def test_equals_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", chunk)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n int, digest string").repartition(4)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id)
                 for r in jaccard.join(docs).collect())
    assert got == brute(rows)


@pytest.mark.parametrize("chunk", [3000, 7])
def test_counts_every_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", chunk)
    words = [f"w{k}" for k in range(200)]
    group = [" ".join([*words, f"end{k}"]) for k in range(12)]  # all different, all similar
    rows = [*corpus(), *((10_000 + k, t) for k, t in enumerate([*group, group[0], group[0]]))]
    sets = [shingles(t) if i is not None else set() for i, t in rows]
    want = sorted((i if i is not None else -1, sum(a != b and bool(x and y) and 100 * len(x & y) >= 75 * len(x | y) for b, y in enumerate(sets)))
                  for a, ((i, _), x) in enumerate(zip(rows, sets)))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_links)
                 for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == want and dict(got)[10_005] == 13 and sum(n for _, n in got) > 1000


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_first(spark):
    rows = corpus()
    base = " ".join(f"only{k}" for k in range(40))
    rows += [(7000, base), (7000, "another text under the same id"), (None, base), (None, base + " more"), (None, "no other row has this text"),
             (None, "no other row has this text"), (None, "one near copy of two without id " * 2), (None, "one near copy of two without id " * 2 + "x")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    unique = list(dict.fromkeys(rows))
    assert len(set(got)) == len(got) and set(got) <= set(unique)
    # every row's component, ids apart: its smallest id stays, and one row of it
    sets = [shingles(t) for _, t in unique]
    up = list(range(len(unique)))

    def root(k):
        return k if up[k] == k else root(up[k])

    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and 100 * len(x & sets[b]) >= 75 * len(x | sets[b]):
                up[root(a)] = root(b)
    members = {}
    for k, row in enumerate(unique):
        members.setdefault(root(k), []).append(row)
    order = lambda i: (i is None, i or 0)
    for group in members.values():
        stayed = [row for row in got if row in group]
        assert len(stayed) == 1 and stayed[0][0] == min((i for i, _ in group), key=order)
    assert (7000, base) in got and (7000, "another text under the same id") in got and (None, base) not in got
    assert sum(i is None for i, _ in got) == 3  # an empty row, the lone text, one of the two near copies


def test_join_query_equals_sql(spark):
    from cohortcast.llm import queries
    from compare import compare, duck
    folder = "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), "op6_jaccard_join", folder, queries.op6_jaccard_join, queries.oracle_sql()["op6_jaccard_join"])
