"""Deleted interpolation against plain counting in Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortcast.llm import lm


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]  # None: the end


def fold(i):
    r = zlib.crc32(("" if i is None else str(i)).encode()) % 7
    return lm.HELD_OUT if r == 2 else lm.DELETED if r == 3 else lm.COUNTED


def pairs(toks):
    return zip([None, *toks], toks)


def plain_em(events, vocabulary, rounds=lm.EM_ROUNDS):
    """Weights by the textbook's loop over single tokens, a bucket at a time."""
    weights = {k: [1 / 3] * 3 for k in range(lm.BUCKETS)}
    for _ in range(rounds):
        sums = {k: [lm.PRIOR] * 3 for k in weights}
        for k, *estimates in events:
            joint = [l * p for l, p in zip(weights[k], [*estimates, 1 / (vocabulary + 1)])]
            for j in range(3):
                sums[k][j] += joint[j] / sum(joint)
        new = {k: [x / sum(s) for x in s] for k, s in sums.items()}
        moved = max(abs(x - y) for k in weights for x, y in zip(new[k], weights[k]))
        weights = new
        if moved <= lm.SETTLED:
            break
    return weights


def brute(rows):
    single, pair, s_del, p_del = Counter(), Counter(), Counter(), Counter()
    for i, t in rows:
        k = tokens(t)
        if fold(i) != lm.HELD_OUT:
            single.update(k)
            pair.update(pairs(k))
        if fold(i) == lm.DELETED:
            s_del.update(k)
            p_del.update(pairs(k))
    n, v, n_del = sum(single.values()), len(single), sum(s_del.values())
    bucket = lambda c: min(c.bit_length(), lm.BUCKETS - 1)
    events = []
    for i, t in rows:
        if fold(i) == lm.DELETED:
            for a, b in pairs(tokens(t)):
                c = single[a] - s_del[a]
                events.append((bucket(c), (pair[a, b] - p_del[a, b]) / max(c, 1), (single[b] - s_del[b]) / max(1, n - n_del)))
    w = plain_em(events, v)
    out = []
    for i, t in rows:
        k = tokens(t)
        base = sum(math.log10((single[x] + 1) / (n + v + 1)) for x in k)
        s = 0.0
        for a, b in pairs(k):
            l2, l1, l0 = w[bucket(single[a])]
            s += math.log10(l2 * pair[a, b] / max(single[a], 1) + l1 * single[b] / max(1, n) + l0 / (v + 1))
        out.append((-99 if i is None else i, fold(i), len(k), sum(single[x] > 0 for x in k), n, base, s))
    return sorted(out)


TEXTS = [None, "", "   ", "a", "The cat sat on the mat", "THE cat\tsat", "the dog\nsat on the cat", "é É ß x", "w " * 3000,
         "long" * 50, "the cat sat on the mat"]


@pytest.mark.parametrize("block_bytes", [8_000_000, 40])
def test_equals_plain_counts(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block_bytes)
    rows = [(k, TEXTS[k % len(TEXTS)] if k % 3 else f"the w{k % 7} cat w{k % 5} sat") for k in range(70)] + [(5, "a b"), (None, "the cat")]
    docs = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, n_tokens int, block double").repartition(3)
    got = sorted((-99 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in lm.score(docs, lm.fold_of()).collect())
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_em_raises_the_likelihood(spark):
    rng = np.random.default_rng(0)
    rows = [(int(k), float(p), float(q), int(n)) for k, p, q, n in
            zip(rng.integers(0, 5, 300), 2.0 ** -rng.uniform(0, 10, 300), 2.0 ** -rng.uniform(3, 12, 300), rng.integers(1, 9, 300))]
    events = spark.createDataFrame(rows, "bucket int, pair double, word double, n long").repartition(3).cache()

    def likelihood(w):
        return sum(n * math.log(w[k][0] * p + w[k][1] * q + w[k][2] / 1000) for k, p, q, n in rows)

    learned = [lm.learn_weights(events, 999, k) for k in (0, 1, 3, 10, 40)]
    values = [likelihood(w) for w in learned]
    assert values == sorted(values) and values[-1] > values[0]
    single = [(k, p, q) for k, p, q, n in rows for _ in range(n)]
    for rounds, w in ((3, learned[2]), (40, learned[4])):
        plain = plain_em(single, 999, rounds)
        assert np.allclose(w, [plain[k] for k in range(lm.BUCKETS)], rtol=1e-9)
    assert lm.learn_weights(events.limit(0), 999).tolist() == [[1 / 3] * 3] * lm.BUCKETS


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    from pyspark.sql import functions as F
    r = lm.score(docs, F.lit(lm.HELD_OUT)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)
    assert lm.score(docs.limit(0), F.lit(lm.COUNTED)).count() == 0
