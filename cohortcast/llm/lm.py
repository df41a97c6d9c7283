"""LM scoring by deleted interpolation.

A bigram model over the words of a corpus.  The probability of a word w after
v mixes maximum-likelihood estimates,

    l2 c(v w) / c(v)  +  l1 c(w) / N  +  l0 / (V + 1),

with weights l that depend on how often the context v was seen: one triple for
each bucket of c(v).  The weights are learned by expectation-maximisation on
documents deleted from the counts (one fold of the training documents); the
final counts are those of all training documents.  Every round of it is one
Spark aggregate over the distinct estimates of the deleted tokens, exact as
they are; a bucket's three sums are all that reaches the driver.

Counts are never gathered: a block of documents sends its distinct words and
pairs once and gets their corpus totals back (see ``exchange``), so what moves
grows with the corpus and no word, however frequent, meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortcast.llm import exchange
from cohortcast.llm.common import blocks_for, give_back, shuffle_width, staged
from cohortcast.llm.langid import remainder
from cohortcast.llm.words import mix, word_hashes

#: Text bytes of a block, and of the corpus for each part of its keys (a part a
#: shuffle partition at least): a task holds some 100 bytes for each distinct
#: word and pair of a block, or of all blocks in a part.
BLOCK_BYTES, PART_BYTES = 2_000_000, 4_000_000
#: Buckets of context counts: by powers of two, the last open.
BUCKETS = 24
#: Rounds of EM at most; it ends when no weight moves by more than ``SETTLED``.
EM_ROUNDS, SETTLED, PRIOR = 40, 1e-3, 1e-3
#: Folds of a training document: counted, or deleted from the counts for EM.
COUNTED, DELETED, HELD_OUT = 0, 1, 2

_END = np.array([0x9D39247E33776D41], np.uint64)
_TOTALS = np.dtype("<u8,<u8")


def blocks(docs: DataFrame, fold: Column, id_col: str, text_col: str) -> DataFrame:
    """``(block, deleted, ids, folds, sizes, texts)``: the documents as each task
    reads them, in runs of about ``BLOCK_BYTES``, deleted ones apart; texts
    compressed, one after the other, with their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, made = TaskContext.get().partitionId(), {}, 0

        def packed(kind):
            nonlocal made
            ids, folds, texts = zip(*held.pop(kind)[1])
            made += 1
            data = b"".join(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 24) + made], pa.int64()), pa.array([kind]), pa.array([list(ids)], pa.list_(id_type)),
                 pa.array([list(folds)], pa.list_(pa.int32())), pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                 pa.array([pa.Codec("zstd", compression_level=5).compress(data, asbytes=True) if data else b""], pa.binary())],
                names=["block", "deleted", "ids", "folds", "sizes", "texts"])

        id_type = None
        for b in batches:
            id_type = b.schema.field(0).type
            for i, t, f in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                t, kind = (t.as_py() or "").encode(), f == DELETED
                size, rows = held.setdefault(kind, (0, []))
                rows.append((i, f, t))
                held[kind] = size + len(t), rows
                if size + len(t) >= BLOCK_BYTES or len(rows) >= 50_000:
                    yield packed(kind)
        for kind in [*held]:
            yield packed(kind)

    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), fold.cast("int").alias("fold"))
    return named.mapInArrow(run, T.StructType([
        T.StructField("block", T.LongType()), T.StructField("deleted", T.BooleanType()),
        T.StructField("ids", T.ArrayType(named.schema[0].dataType)), T.StructField("folds", T.ArrayType(T.IntegerType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("texts", T.BinaryType())]))


class _Block:
    """Tokens of a block: every text's words and one end, and their keys."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        row = {c: table.column(c)[0].as_py() for c in table.schema.names}
        self.block, self.deleted, self.ids = row["block"], row["deleted"], row["ids"]
        self.folds = np.array(row["folds"], "i4")
        total = sum(row["sizes"])
        data = bytes(pa.decompress(row["texts"], total, "zstd", asbytes=True)) if total else b""
        ends = np.cumsum(row["sizes"])
        texts = [data[e - s:e].decode() for s, e in zip(row["sizes"], ends)]
        del data
        h, offsets = word_hashes(texts)
        self.tokens_of = np.diff(offsets) + 1
        self.last = np.cumsum(self.tokens_of) - 1  # where each text ends
        words = np.ones(len(h) + len(texts), bool)
        words[self.last] = False
        token = np.empty(len(words), np.uint64)
        token[words], token[~words] = h, _END[0]
        before = np.empty_like(token)
        before[1:], before[:1] = token[:-1], _END[0]
        # the low bit tells single words from pairs
        one = np.uint64(1)
        both = np.concatenate([mix(token) | one, mix(before * np.uint64(0x9E3779B97F4A7C15) + token) & ~one])
        self.n = len(token)
        del h, words, token, before, texts
        self.keys, of = np.unique(both, return_inverse=True)
        self.of_single, self.of_pair = of[:self.n], of[self.n:]
        del both, of
        give_back()

    def ask(self, parts: int) -> pa.Table:
        """Its keys with how often training documents and deleted ones hold them."""
        learns = np.repeat(self.folds != HELD_OUT, self.tokens_of)
        count = np.zeros((len(self.keys), 2), "u4")
        count[:, 0] = sum(np.bincount(of[learns], minlength=len(self.keys)) for of in (self.of_single, self.of_pair))
        if self.deleted:
            count[:, 1] = count[:, 0]
        return exchange.ask(self.block, self.keys, count, parts)

    def counts(self, responses: pa.Table, parts: int, deleted: bool):
        """Per token: counts of the word, of the pair, of the context; without
        the deleted documents if asked for."""
        got = exchange.answered(responses, self.keys, parts, _TOTALS)
        total = (got["f0"] - got["f1"] if deleted else got["f0"]).astype(np.int64)
        word, pair = total[self.of_single], total[self.of_pair]
        context = np.empty_like(word)
        context[1:], context[:1] = word[:-1], word[self.last[:1]]  # before a text stands an end
        return word, pair, context


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1)


def _note(keys: np.ndarray, totals: np.ndarray) -> bytes:
    """Of the single words of a part: how many there are, their tokens, and
    their tokens in deleted documents, highest byte first."""
    single = (keys & np.uint64(1)).astype(bool) & (totals[:, 0] > 0)
    return np.array([single.sum(), totals[single, 0].sum(), totals[single, 1].sum()], ">i8").tobytes()


def _noted(said: DataFrame) -> list[int]:
    """The sums of all notes: distinct words, tokens, deleted tokens."""
    number = lambda k: F.conv(F.hex(F.substring("totals", 1 + 8 * k, 8)), 16, 10).cast("long")
    return [n or 0 for n in said.where("block = -1").agg(*(F.sum(number(k)) for k in range(3))).first()]


def learn_weights(events: DataFrame, vocabulary: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """(BUCKETS, 3) mixture weights for pair, word and uniform estimate, by EM
    on ``events (bucket, pair, word, n)``: estimates and how many tokens have
    them.  A small prior keeps every weight above 0, and the weights of a
    bucket without events are even."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        own = F.array(*(F.array(*map(F.lit, row)) for row in weights.tolist()))[F.col("bucket")]
        parts = events.select("bucket", "n", (own[0] * F.col("pair")).alias("p0"), (own[1] * F.col("word")).alias("p1"),
                              (own[2] / F.lit(float(vocabulary + 1))).alias("p2"))
        share = [F.sum(F.col("n") * F.col(f"p{k}") / (F.col("p0") + F.col("p1") + F.col("p2"))) for k in range(3)]
        got = np.zeros((BUCKETS, 3))
        for bucket, *sums in parts.groupBy("bucket").agg(*share).collect():  # a row a bucket
            got[bucket] = sums
        new = (got + PRIOR) / (got + PRIOR).sum(1, keepdims=True)
        moved, weights = np.abs(new - weights).max(), new
        if moved <= SETTLED:
            break
    return weights


def score(docs: DataFrame, fold: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, fold, n_tokens, n_known, train_tokens, base_score, score)`` of
    every row, by a model of the rows whose ``fold`` is not ``HELD_OUT``.

    A token is a word in lower case (A-Z) or the one end of a text; a null text
    is empty and has the end alone.  ``n_known`` counts tokens that training
    documents hold, ``base_score`` sums log10 of add-one estimates and ``score``
    log10 of the mixture's, over all tokens.  Null ids stay null, repeated rows
    are counted and scored each; without training documents the uniform
    estimate remains.  Extra columns are not read.
    """
    spark = docs.sparkSession
    held = staged(blocks(docs, fold, id_col, text_col), "lm-blocks")
    total = held.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0]
    parts = max(shuffle_width(spark), blocks_for(total, PART_BYTES))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield from _Block(b.slice(k, 1)).ask(parts).to_batches()

    said = staged(exchange.answers(held.mapInArrow(ask, exchange.REQUEST), 2,
                                   lambda t: np.ascontiguousarray(t.astype("<u8")).view(_TOTALS).ravel(), _TOTALS, _note), "lm-totals")
    vocabulary, n_all, n_deleted = _noted(said)
    said = said.where("block >= 0")

    def observe(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left)
        word, pair, context = block.counts(right, parts, deleted=True)
        tokens = pa.table([pa.array(_bucket(context).astype("i4")), pa.array(pair / np.maximum(context, 1)),
                           pa.array(word / max(1, n_all - n_deleted))], names=["bucket", "pair", "word"])
        return tokens.group_by(tokens.schema.names, use_threads=False).aggregate([([], "count_all")]).rename_columns([*tokens.schema.names, "n"])

    # What EM needs of the deleted documents: distinct estimates, and how many tokens have them.
    deleted = held.where("deleted")
    theirs = said.join(deleted.select("block"), "block", "left_semi")
    events = (deleted.groupBy("block").cogroup(theirs.groupBy("block")).applyInArrow(observe, "bucket int, pair double, word double, n long")
              .groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")))
    weights = learn_weights(staged(events, "lm-events"), vocabulary)

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left)
        word, pair, context = block.counts(right, parts, deleted=False)
        w = weights[_bucket(context)]
        p = w[:, 0] * (pair / np.maximum(context, 1)) + w[:, 1] * (word / max(1, n_all)) + w[:, 2] / (vocabulary + 1)
        base = np.log10((word + 1) / (n_all + vocabulary + 1))
        ends = np.concatenate([[0], block.last + 1])
        per = lambda x: np.add.reduceat(x, ends[:-1]) if len(ends) > 1 else x[:0]
        return pa.table([pa.array(block.ids, left.schema.field("ids").type.value_type),
                         pa.array(block.folds), pa.array(block.tokens_of.astype(np.int64)),
                         pa.array(per((word > 0).astype(np.int64))), pa.array(np.full(len(block.ids), n_all, np.int64)),
                         pa.array(per(base)), pa.array(per(np.log10(p)))], names=[f.name for f in schema])

    schema = T.StructType([T.StructField(id_col, held.schema["ids"].dataType.elementType), T.StructField("fold", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
                           *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])
    return held.groupBy("block").cogroup(said.groupBy("block")).applyInArrow(rate, schema)


def fold_of(id_col: str = "doc_id", by: int = 7, held_out: int = 2, deleted: int = 3) -> Column:
    """Folds by the remainder of the id's crc32."""
    r = remainder(id_col, by)
    return F.when(r == held_out, HELD_OUT).when(r == deleted, DELETED).otherwise(COUNTED)
