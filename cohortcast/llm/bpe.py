"""Byte-level BPE as a monoid: encode halves, join neighbours, concatenate.

A text is cut by the tokenizer's pattern; every match is encoded for itself.
Within a match, the tokens of a byte string are a tree reduction over its
halves.  The join of two neighbours' tokens re-encodes a window around their
border and widens it until the tokens outside are proven final:

    a token sequence is the encoding of its bytes exactly when every two
    adjacent tokens, encoded together, come out as those two tokens.

(In a run of the merges, the picks inside a stretch that no merge crosses are
the picks of a run over that stretch alone.  So the first merge that crosses
the border of tokens t|u would also be picked in the run over t+u; if that run
leaves t and u apart, no merge crosses.)  Neighbours' inner pairs hold already
and so do the window's, so a join only checks the pairs at the window's ends.

Decoding maps tokens to bytes and concatenates up the tree: concatenation is
associative, so the bytes of any token range are those of its parts.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortcast.llm.common import give_back, sliced

#: Bytes up to which the merge loop runs directly (a leaf of the tree).  Short
#: leaves recur, so their tokens are kept.
LEAF_BYTES = 8
#: Tokens of a leaf of the tree that decodes.
LEAF_TOKENS = 256
#: Matches whose tokens a worker keeps, and leaves and pairs of tokens; a store
#: is emptied when full.
CACHE_ENTRIES, PART_ENTRIES = 250_000, 80_000
#: Text bytes a task encodes at a time.
SLICE_BYTES = 4_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Encoder:
    """Tokens of byte strings under one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], leaf_bytes: int = LEAF_BYTES):
        self.ranks = ranks
        self.leaf_bytes = max(1, leaf_bytes)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self._leaves: dict[bytes, list[int]] = {}
        self._pairs: dict[tuple[int, int], list[int]] = {}

    def encode(self, data: bytes) -> list[int]:
        """Tokens of one match; a match that is a token stays whole."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return self.tree(data) if data else []

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf_bytes:
            return self._kept(self._leaves, data, data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the concatenation of what ``left`` and ``right`` encode."""
        if not left or not right:
            return left or right
        i = j = 1
        while True:
            if i == j == 1:
                window = self.pair(left[-1], right[0])
            else:
                window = self.merge(b"".join([self.bytes_of[t] for t in left[-i:] + right[:j]]))
            left_holds = i == len(left) or self.stable(left[-i - 1], window[0])
            right_holds = j == len(right) or self.stable(window[-1], right[j])
            if left_holds and right_holds:
                return left[:-i] + window + right[j:]
            if not left_holds:
                i = min(2 * i, len(left))
            if not right_holds:
                j = min(2 * j, len(right))

    def pair(self, a: int, b: int) -> list[int]:
        """Tokens of the bytes of two tokens."""
        known = self._pairs.get((a, b))
        return known or self._kept(self._pairs, (a, b), self.bytes_of[a] + self.bytes_of[b])

    def stable(self, a: int, b: int) -> bool:
        """Do the two tokens, encoded together, stay these two tokens?"""
        return self.pair(a, b) == [a, b]

    def _kept(self, store: dict, key, data: bytes) -> list[int]:
        tokens = store.get(key)
        if tokens is None:
            if len(store) >= PART_ENTRIES:
                store.clear()
            tokens = store[key] = self.merge(data)
        return tokens

    def merge(self, data: bytes) -> list[int]:
        """The merges themselves: join the adjacent pair of lowest rank, the
        leftmost of equals, until no pair is a token."""
        if len(data) > 64:
            return self._merge_long(data)
        ranks, none = self.ranks, len(self.ranks) + 1
        cut = list(range(len(data) + 1))
        pair = [ranks.get(data[k:k + 2], none) for k in range(len(data) - 1)]
        while pair:
            low = min(pair)
            if low == none:
                break
            k = pair.index(low)
            del cut[k + 1], pair[k]
            if k < len(pair):
                pair[k] = ranks.get(data[cut[k]:cut[k + 2]], none)
            if k:
                pair[k - 1] = ranks.get(data[cut[k - 1]:cut[k + 1]], none)
        return [ranks[data[a:b]] for a, b in zip(cut, cut[1:])]

    def _merge_long(self, data: bytes) -> list[int]:
        """As :meth:`merge`, with a heap of pairs over a linked list."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # end[k]: end of the part that starts at k, 0 if none does
        before = list(range(-1, n - 1))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(data[k:k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, stop = heapq.heappop(heap)
            mid = end[k]
            if not mid or mid >= n or end[mid] != stop:
                continue  # one of the two parts has changed since
            end[k], end[mid] = stop, 0
            if stop < n:
                before[stop] = k
                if (r := ranks.get(data[k:end[stop]])) is not None:
                    heapq.heappush(heap, (r, k, end[stop]))
            if before[k] >= 0 and (r := ranks.get(data[before[k]:stop])) is not None:
                heapq.heappush(heap, (r, before[k], stop))
        out, k = [], 0
        while k < n:
            out.append(ranks[data[k:end[k]]])
            k = end[k]
        return out


class _Packed(dict):
    """Tokens of a match, packed as 32-bit integers; bounded."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, match: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        packed = array("i", self.encoder.encode(match.encode())).tobytes()
        if len(match) <= 64:
            self[match] = packed
        return packed


_WORKER: dict = {}


def _packed(ranks, leaf_bytes: int) -> _Packed:
    """This worker's encoder: kept from task to task, one vocabulary a time."""
    if _WORKER.get("of") is not ranks.value:
        _WORKER.update(of=ranks.value, packed=_Packed(Encoder(ranks.value, leaf_bytes)))
    return _WORKER["packed"]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text", leaf_bytes: int = LEAF_BYTES, decoded_col: str | None = None) -> DataFrame:
    """``(id_col, ids array<int>)`` of every row's whole text, and the bytes that
    the ids decode to where ``decoded_col`` names a column for them (as
    :func:`decode` gives them, in the same pass).

    No special tokens.  A null text counts as empty and has no tokens; a null
    id stays null; equal rows give equal rows; other columns are not read.
    Texts of any length are encoded whole, by the same tree.
    """
    held = docs.sparkSession.sparkContext.broadcast(ranks)  # as large as the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, cut = _packed(held, leaf_bytes), regex.compile(pattern)
        for whole in batches:
            for batch in sliced(whole, 1, SLICE_BYTES):
                parts = [b"".join(map(packed.__getitem__, cut.findall(t or ""))) for t in batch.column(1).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype("i4")
                ids = pa.array(np.frombuffer(b"".join(parts), "i4"), pa.int32())
                out = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), ids)]
                if decoded_col:
                    out.append(pa.array([_joined(packed.encoder.bytes_of, np.frombuffer(p, "i4").tolist()) for p in parts], pa.binary()))
                del parts
                yield pa.RecordBatch.from_arrays(out, names=names)
            give_back()

    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([narrow.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded_col, T.BinaryType())] if decoded_col else [])])
    names = schema.fieldNames()
    return narrow.mapInArrow(run, schema)


def _joined(bytes_of: dict[int, bytes], ids: list[int]) -> bytes:
    """The tokens' bytes, concatenated up a tree of ranges: the two halves of a
    range are decoded, then joined; a leaf is a run of ``LEAF_TOKENS``."""
    level = [b"".join(map(bytes_of.__getitem__, ids[k:k + LEAF_TOKENS])) for k in range(0, len(ids), LEAF_TOKENS)]
    while len(level) > 1:
        level = [b"".join(level[k:k + 2]) for k in range(0, len(level), 2)]
    return level[0] if level else b""


def decode(tokens: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``tokens`` with ``out_col``, the bytes of its tokens.

    Null or empty ids give empty bytes.  The bytes need not be valid UTF-8 for
    a part of a text; those of a whole text are its UTF-8 bytes.  A column
    already named ``out_col`` is replaced.
    """
    held = tokens.sparkSession.sparkContext.broadcast(ranks)
    kept = tokens.drop(out_col)
    names = [*kept.columns, out_col]
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _WORKER.get("decodes") is not held.value:
            _WORKER.update(decodes=held.value, bytes_of={rank: token for token, rank in held.value.items()})
        bytes_of = _WORKER["bytes_of"]
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                out = [_joined(bytes_of, ids or []) for ids in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=names)

    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField(out_col, T.BinaryType())]))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the bytes
    that the ids decode to."""
    both = encode(docs, ranks, pattern, id_col, decoded_col="decoded")
    return both.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
