"""Source divergence against brute force in Python's integers and SQL."""

import re
from collections import Counter

import numpy as np
import pytest

from cohortcast.llm import divergence, queries
from compare import compare, duck
from conftest import SF_SMALL

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string, term string, n long, docs long"


def expected(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    cut = [(Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))), lang, src) for t, lang, src in rows]
    out = []
    for lang in {r[1] for r in rows}:
        docs = Counter(w for c, g, _ in cut if g == lang for w in c)
        kept = [w for w, n in docs.items() if n >= min_docs]
        sources = sorted({s for _, g, s in rows if g == lang}, key=str.encode)

        def p_of(counts):
            total = sum(counts[w] for w in kept)
            return {w: 1 + 10 ** 9 * (counts[w] + 2) // (total + 2 * len(kept)) for w in kept}
        n = {s: sum((c for c, g, x in cut if (g, x) == (lang, s)), Counter()) for s in sources}
        p, q = {s: p_of(n[s]) for s in sources}, p_of(sum((c for c, g, _ in cut if g == lang), Counter()))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            parts = {"pair": [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in sources if o != s],
                     "term": [(w, f(p[s][w], q[w])) for w in kept if n[s][w] and p[s][w] > q[w]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def audit(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 7, 8) for r in rows], SCHEMA)
    got = divergence.audit(df.repartition(3), **kw)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(map(tuple, got.collect()))


def corpus(n=400, sources=9):
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta", "GAMMA", "été", "ÉTÉ", "naïve", "x", "данные", "語", "zeta_eta", "o'clock"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    rows = []
    for _ in range(n):
        s = int(rng.integers(sources)) if rng.random() < 0.6 else 0  # one source holds a third
        take = rng.choice(words, rng.integers(0, 30), p=None) if s % 2 else rng.choice(words[:20 + s], rng.integers(0, 30))
        rows.append((", ".join(take) + "7\t-", ["en", "de"][int(rng.integers(2))], f"s{s}"))
    return rows


EDGE = [(None, None, None), ("", "en", "empty"), (None, "en", None), ("alone in its language", "xx", "a"), ("other words", "xx", "b"),
        ("long " * 50_000, "en", "long"), ("beta beta", "en", "é"), ("beta beta", "en", "z")]


@pytest.mark.parametrize("min_docs, top", [(10, 10), (1, 3)])
def test_against_brute_force(spark, min_docs, top):
    rows = corpus() + EDGE + EDGE
    assert audit(spark, rows, min_docs=min_docs, top_terms=top) == expected(rows, min_docs, top)


def test_chunks_blocks_and_flushes(spark, monkeypatch):
    """Small blocks, chunks and task counters give the same rows."""
    for name, n in (("BLOCK_TERMS", 7), ("CHUNK_SOURCES", 4), ("HELD_TERMS", 20)):
        monkeypatch.setattr(divergence, name, n)
    rows = corpus() + EDGE
    assert audit(spark, rows, min_docs=3) == expected(rows, 3, 10)


def test_shares_are_exact_for_large_counts():
    rng = np.random.default_rng(1)
    total = rng.integers(10 ** 14, 9 * 10 ** 15, 1000)
    n = np.concatenate([rng.integers(0, 10 ** 6, 500), (total[500:] * 0.9).astype(np.int64)])
    assert divergence.shares(n, total).tolist() == [1 + 10 ** 9 * (int(a) + 2) // int(b) for a, b in zip(n, total)]


def test_native_share_is_exact(spark):
    got = spark.sql("select 8000000000000000000L as n, 9000000000000000000L as total, 17L as terms").select(
        divergence._share_sql("n", "total", "terms").alias("p")).first().p
    assert got == 1 + 10 ** 9 * (8 * 10 ** 18 + 2) // (9 * 10 ** 18 + 34)


def test_tokens():
    every = "".join(map(chr, range(1, 256))) + "Ünï"
    assert [t.decode() for t in divergence.tokens(every.encode())] == TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), every))


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql(spark):
    for folder in (SF_SMALL, "/root/testdata/sf0.01"):
        assert compare(spark, duck(folder), "op12_source_divergence", folder, queries.op12_source_divergence,
                       queries.oracle_sql()["op12_source_divergence"])
