"""Alignment of two tokenizers against whole-text encoding and brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortcast.llm import crosstoken, queries
from cohortcast.llm.common import table
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def files():
    return (open(public_tokenizers.path(queries.BYTE_LEVEL), encoding="utf-8").read(),
            open(public_tokenizers.path(queries.PIECE_MODEL), "rb").read())


@pytest.fixture(scope="module")
def sides(files):
    return crosstoken.sides_of(*files)


@pytest.fixture(scope="module")
def words(sides):
    width = max(len(sides.a_bytes), len(sides.b_bytes))
    return np.array([[f"{i}{end}" for i in range(width)] for end in ",|;"], object)


def whole(sides, text):
    """Groups [(ids of A, ids of B)] and overlaps of one text, encoded whole,
    byte by byte; None if a side does not spell it out."""
    if not text:
        return None
    full = (" " + text).encode()
    ids = sides.a.encode(" " + text, add_special_tokens=False).ids, sides.b.encode(text)
    spelled = [[t[i] for i in x] for t, x in zip((sides.a_bytes, sides.b_bytes), ids)]
    if any(b"".join(s) != full for s in spelled):
        return None
    owner = [[k for k, token in enumerate(s) for _ in token] for s in spelled]
    ends = [set(np.cumsum([len(x) for x in s]).tolist()) for s in spelled]
    groups, begin = [], 0
    for end in sorted(ends[0] & ends[1]):
        groups.append(tuple([x[k] for k in dict.fromkeys(o[begin:end])] for x, o in zip(ids, owner)))
        begin = end
    return groups, len(set(zip(*owner)))


def expected(sides, texts):
    found = [whole(sides, t) for t in texts]
    links = [Counter((a, b) for x, y in f[0] for a in x for b in y) if f else Counter() for f in found]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for f, c in zip(found, links):
        if not f:
            out.append((0,) * 7 + ("",))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in f[0])
        out.append((sum(len(a) for a, _ in f[0]), sum(len(b) for _, b in f[0]), len(f[0]), sum(c.values()), f[1],
                    sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out


ODD = [None, "", " ", "  ", "a", " a", "a ", "\n", "a\n b", "a \n b", "a  b", "don't we'll it's", "x' s", "<|endoftext|> <s> </s> <unk> <0x41>",
       "naïve  café x 　y", "日本語 のテキスト です", "😀 😀😀 👩‍👩‍👧", "a ▁ b", "▁", "x▁ y", "tab\t next\tone", "\r\n x \r\n", "1234 567,89 3.14 %%",
       "é ́x", "​ zero ​width", "nul\x00 and \x01 \x7f", "﻿ bom", "ﬁ ① Ⅷ", "a" * 3000, "ab " * 3000, "=" * 999 + " x", "𝔘𝔫𝔦 ℂ", "᠎ m   n  o"]


def of(texts, files):
    store = crosstoken.Pieces(crosstoken.sides_of(*files))
    return store


def check(texts, files, sides, words):
    got = crosstoken.align_texts(texts, of(texts, files), words, True)
    for t, (counts, digest, groups, pairs, links) in zip(texts, got):
        f = whole(sides, t)
        said = [tuple([int(i) for i in x.split(",")] for x in g.split("|")) for g in groups.split(";")] if groups else []
        assert said == [tuple(map(list, g)) for g in f[0]] if f else said == [], t
        assert counts[4] == (f[1] if f else 0), t
        assert digest == (hashlib.sha256(groups.encode()).hexdigest() if f else "")
        c = Counter(a * len(sides.b_bytes) + b for x, y in said for a in x for b in y)
        assert dict(zip(pairs.tolist(), links.tolist())) == c and counts[3] == sum(c.values())


def test_pieces_are_cut_where_both_tokenizers_cut(files, sides, words):
    assert sides.piece is crosstoken.PIECE
    check(ODD, files, sides, words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'ab.1é語▁ 　"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=5))
def test_any_text(files, sides, words, texts):
    check(texts, files, sides, words)


@pytest.mark.parametrize("run, listed, kept", [(16, 1, 3), (300, 4, 10_000), (1 << 20, 4096, 10_000)])
def test_runs_groups_and_store(files, sides, words, monkeypatch, run, listed, kept):
    """Documents over several runs, large groups by distinct ids, a store that is emptied."""
    for name, n in (("RUN_BYTES", run), ("LISTED", listed), ("KEPT_PIECES", kept)):
        monkeypatch.setattr(crosstoken, name, n)
    check(ODD[3:] + ["one two three  four\nfive sixseven " * 9], files, sides, words)


def test_score_against_brute_force(spark, files, sides):
    texts = ODD + [r.text for r in table(spark, SF_SMALL, "documents").limit(60).collect()]
    texts += texts[-5:]
    ids = [None if k % 9 == 0 else k // 2 for k in range(len(texts))]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in zip(ids, texts)], "doc_id long, text string, block int, pairs string")
    got = crosstoken.score(df.repartition(5), *files)
    assert got.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in crosstoken.COUNTS], ("n_best", "bigint"), ("count_sum", "bigint"), ("groups_sha256", "string")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((i, *x)) for i, x in zip(ids, expected(sides, texts)))
    assert crosstoken.score(df.limit(0), *files).count() == 0


def test_query_against_brute_force(spark, sides):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    got = queries.op13_cross_tokenizer(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, *x) for r, x in zip(docs, expected(sides, [r.text for r in docs])))
