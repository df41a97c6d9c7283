"""Byte-level BPE against the tiktoken library and an exact round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortcast.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TREE = bpe.Encoder(RANKS, leaf_bytes=1)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet="aehnortz ", min_size=1, max_size=80), st.text(min_size=1, max_size=40),
                 st.text(alphabet="a", min_size=1, max_size=700), st.text(alphabet="=-_", min_size=1, max_size=300)))
def test_tree_equals_merges(s):
    data = s.encode()
    plain = TREE.merge(data)
    assert TREE.tree(data) == plain
    assert bpe.Encoder(RANKS).tree(data) == plain


def test_long_merges_equal_the_library():
    rng = random.Random(3)
    for n in (65, 500, 5000):
        s = "".join(rng.choice("etaoinshrdlu") for _ in range(n))
        want = LIBRARY._core_bpe.encode_single_piece(s.encode())
        assert TREE.encode(s.encode()) == want
        assert bpe.Encoder(RANKS).encode(s.encode()) == want


TEXTS = [None, "", " ", "a", "Hello world", "  two  spaces\n\n\tand tabs ", "éèß ñ 漢字 🙂‍🙂", "x" * 30_000, "=" * 3_000,
         "<|endoftext|> is text", "don't we'll 12345 ½", " ".join(["thonre wherer"] * 2000), "a"]


def test_digests_equal_the_library(spark):
    rows = [(i if i != 3 else None, t, "clash", 7) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect())
    want = []
    for i, t, *_ in rows:
        ids = LIBRARY.encode_ordinary(t or "")
        want.append((-1 if i is None else i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_decode_keeps_columns_and_takes_nulls(spark):
    df = spark.createDataFrame([(1, [RANKS[b"a"]], "k"), (2, None, None), (3, [], "k")], "doc_id long, ids array<int>, decoded string")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, RANKS).collect()}
    assert got == {1: b"a", 2: b"", 3: b""}


@pytest.mark.parametrize("rows", [[]])
def test_empty_table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bpe.digests(docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_decodes_up_the_tree():
    bytes_of = {k: bytes([k % 251]) * (k % 4) for k in range(900)}
    for n in (0, 1, 255, 256, 257, 512, 900):
        assert bpe._joined(bytes_of, [*range(n)]) == b"".join(bytes_of[k] for k in range(n))
