"""Counts of 64-bit keys over a whole corpus, asked for by blocks of documents.

A block (a few MB of texts) sends each of its distinct keys once, with what it
counts for it, and gets the corpus totals back in the order it sent them.  Keys
are cut into parts by their value, so a part adds up what all blocks sent for
its keys: a key that a third of all documents hold arrives once per block.  Keys
of a block and part travel sorted, as differences, in one row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcast.llm.common import blocks_for, give_back, shuffle_width

REQUEST = "part int, block long, n int, keys binary, counts binary"
RESPONSE = "block long, part int, totals binary"


def in_blocks(rows: DataFrame, size: str, block_bytes: int, *key: str) -> tuple[DataFrame, int]:
    """``rows`` with a ``block``, dealt by a hash of ``key``, of about
    ``block_bytes`` of the expression ``size``; and the number of parts for
    their keys, one for twice that many bytes.  There are two blocks and one part
    a shuffle partition at least."""
    width = shuffle_width(rows.sparkSession)
    total = rows.agg(F.sum(F.expr(size))).first()[0]
    n = max(blocks_for(total, block_bytes), 2 * width)
    return rows.withColumn("block", F.pmod(F.xxhash64(*key), F.lit(n))), max(width, blocks_for(total, 2 * block_bytes))


def _planes(values: np.ndarray) -> bytes:
    """Fixed-width numbers byte by byte, so that the high zeros of small ones
    stand together, compressed."""
    return pa.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), "zstd", asbytes=True)


def _numbers(data: bytes, kind: str, count: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    plain = pa.decompress(data, width * count, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(width, count).T).view(kind).ravel()


def part_bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in ascending keys (and where the last ends)."""
    starts = np.array([-(-(p << 64) // parts) for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, starts), [len(keys)]])


def ask(block: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> pa.Table:
    """The request of a block: ascending keys and (keys, n) counts."""
    bounds = part_bounds(keys, parts)
    held = np.flatnonzero(np.diff(bounds))
    sent = [(keys[a:b], counts[a:b]) for a, b in zip(bounds[held], bounds[held + 1])]
    return pa.table([pa.array(held.astype("i4")), pa.array(np.full(len(held), block, "i8")),
                     pa.array([len(k) for k, _ in sent], pa.int32()),
                     pa.array([_planes(np.diff(k, prepend=np.uint64(0))) for k, _ in sent], pa.binary()),
                     pa.array([_planes(np.ascontiguousarray(c.T, "<u4").ravel()) for _, c in sent], pa.binary())],
                    names=["part", "block", "n", "keys", "counts"])


def answers(requests: DataFrame, n: int, say: Callable[[np.ndarray], np.ndarray], kind: str,
            note: Callable[[np.ndarray, np.ndarray], bytes] | None = None) -> DataFrame:
    """The responses: ``say`` makes of (keys, n) corpus totals what goes back
    for each key, numbers of type ``kind``.  ``note``, given a part's keys and
    totals, adds a row of the block -1 for it."""

    def add_up(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        keys = np.concatenate([np.cumsum(_numbers(k.as_py(), "<u8", s), dtype=np.uint64)
                               for k, s in zip(table.column("keys"), sizes)])
        counts = np.concatenate([_numbers(c.as_py(), "<u4", n * s).reshape(n, s)
                                 for c, s in zip(table.column("counts"), sizes)], 1)
        keys, of = np.unique(keys, return_inverse=True)
        totals = np.stack([np.bincount(of, c).astype(np.int64) for c in counts], 1)
        del counts
        out = say(totals)[of].astype(kind, copy=False)
        del of
        give_back()
        ends = np.cumsum(sizes)
        said = [_planes(out[e - s:e]) for s, e in zip(sizes, ends)]
        block, part = table.column("block").to_pylist(), table.column("part").to_pylist()
        if note is not None:
            said, block, part = [*said, note(keys, totals)], [*block, -1], [*part, part[0]]
        return pa.table([pa.array(block, pa.int64()), pa.array(part, pa.int32()), pa.array(said, pa.binary())],
                        names=["block", "part", "totals"])

    return requests.groupBy("part").applyInArrow(add_up, RESPONSE)


def answered(responses: pa.Table, keys: np.ndarray, parts: int, kind: str) -> np.ndarray:
    """A block's responses, in the order of its ascending keys."""
    sizes = np.diff(part_bounds(keys, parts))
    by_part = dict(zip(responses.column("part").to_pylist(), responses.column("totals")))
    got = [_numbers(by_part[p].as_py(), kind, sizes[p]) for p in np.flatnonzero(sizes)]
    return np.concatenate(got) if got else np.zeros(0, kind)
