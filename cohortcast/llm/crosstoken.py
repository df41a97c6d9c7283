"""Two tokenizers' tokens of the same texts, aligned by their bytes.

A batch's token starts meet by pandas ``merge_asof``, keyed by document: each
token finds the token of the other side that covers its first byte.  Both
directions together are all overlaps.  A token whose covering token starts where
it starts, so that both sides' tokens before it end there, opens a group.

How often a pair of ids is linked corpus-wide comes back to the documents in
blocks of some MB of text: a block sends each of its distinct pairs once, with
its number of documents, so rows grow with the blocks, and a pair that every
document holds is one row a block.

Texts are cut into pieces before they are tokenized, and a task tokenizes each
distinct piece once (:data:`PIECE`): before a blank between two characters that
are no white space, where both tokenizers always end a token.  The byte-level
one splits text by a pattern whose matches hold a blank only in front or among
white space, and joins nothing across matches; the piece one joins symbols
whose text is in its vocabulary, where no entry has a blank behind another
character (:func:`cuttable`; if that does not hold, texts stay whole).
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast.llm.common import give_back, sliced, staged

# ---------------------------------------------------------------------------
# The byte-level alphabet's rule, the piece sign of a blank.
# ---------------------------------------------------------------------------
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BLANK = "▁"
_NO_SPACE = rf"[^\s\u180e\u200b\ufeff{BLANK}]"
#: A piece: up to a blank between two characters that are no white space.
PIECE = re.compile(rf" {_NO_SPACE}++(?= {_NO_SPACE})|.+?(?:(?<={_NO_SPACE})(?= {_NO_SPACE})|\Z)", re.DOTALL)

#: A piece that can stand before and behind any other one.
PLAIN_PIECE = re.compile(rf" {_NO_SPACE}(?:.*{_NO_SPACE})?", re.DOTALL)

#: Bytes of a run that is aligned at once, and of a block of documents.
RUN_BYTES, BLOCK_BYTES = 1 << 19, 8 << 20
#: Pieces and tokens that a task keeps.
KEPT_PIECES, KEPT_TOKENS = 300_000, 3_000_000
#: Links of a group that are listed one by one; of larger ones, by distinct ids.
LISTED = 4096

COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]


def byte_table(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    odd = [b for b in range(256) if b not in PLAIN]
    of = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(odd)}
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        out[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
    return out


class Sides:
    """Both tokenizers, from their files' contents."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.a_bytes = byte_table(self.a.get_vocab(with_added_tokens=True))
        entries = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(entries)]
        self.piece = PIECE if cuttable(json.loads(byte_level), self.b, entries) else re.compile(".+", re.DOTALL)

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; pieces begin with a blank, which the second adds."""
        return ([e.ids for e in self.a.encode_batch(pieces, add_special_tokens=False)],
                self.b.encode([p[1:] for p in pieces], num_threads=1))


def cuttable(spec: dict, pieces, entries: list[str]) -> bool:
    """Whether the tokenizers are of the kind that :data:`PIECE` may cut."""
    split, kept = spec.get("pre_tokenizer") or {}, "".join(pieces.encode_as_pieces("a  b ")) == f"{BLANK}a{BLANK}{BLANK}b{BLANK}"
    bytewise = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    return bool(bytewise) and kept and not any(BLANK in e.lstrip(BLANK) for e in entries)


@functools.cache
def sides_of(byte_level: str, pieces: bytes) -> Sides:
    return Sides(byte_level, pieces)


class _Numbers(dict):
    """Numbers what it is asked for in the order in which it is first asked."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class Pieces:
    """Tokens of the pieces seen so far: per side flat ids, byte lengths and
    where a piece's begin; and which pieces both sides spell out."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.tables = sides.a_bytes, sides.b_bytes
        self.lengths = [np.fromiter(map(len, t), np.int64, len(t)) for t in self.tables]
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers()
        self.ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.begin = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.fine = np.zeros(0, bool)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > KEPT_PIECES or len(self.ids[0]) + len(self.ids[1]) > KEPT_TOKENS:
            self.clear()
        found = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if self.known.new:
            self._add(self.known.new)
            self.known.new = []
        return found

    def _add(self, new: list[str]) -> None:
        """Tokenizes new pieces: those that may be cut at both ends in one
        string, the others one by one."""
        plain = np.array([PLAIN_PIECE.fullmatch(p) is not None for p in new]) if self.sides.piece is PIECE else np.zeros(len(new), bool)
        together = np.flatnonzero(plain)
        joint = self._joint([new[k] for k in together]) if len(together) else None
        if joint is None:
            plain[:] = False
        alone = np.flatnonzero(~plain)
        single = self.sides.encode([new[k] for k in alone]) if len(alone) else ([], [])
        fine = np.ones(len(new), bool)
        for side, (ids, table) in enumerate(zip(single, self.tables)):
            fine[alone] &= np.array([b"".join([table[i] for i in own]) == new[k].encode() for own, k in zip(ids, alone)], bool)
            n = np.zeros(len(new), np.int64)
            n[alone] = [len(own) for own in ids]
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
            if joint is not None:
                n[together] = joint[side][1]
            ends = np.cumsum(n)
            both = np.empty(ends[-1], np.int64)
            of_alone = np.repeat(~plain, n)
            both[of_alone] = flat
            if joint is not None:
                both[~of_alone] = joint[side][0]
            ends += self.begin[side][-1]
            self.ids[side] = np.concatenate([self.ids[side], both])
            self.begin[side] = np.concatenate([self.begin[side], ends])
        self.fine = np.concatenate([self.fine, fine])

    def _joint(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Per side (ids of all, tokens of each); None where a side does not
        spell the string out or a token passes the end of a piece."""
        text = "".join(pieces)
        ends = np.cumsum([len(p.encode()) for p in pieces])
        out = []
        for (ids,), table, lengths in zip(self.sides.encode([text]), self.tables, self.lengths):
            if b"".join([table[i] for i in ids]) != text.encode():
                return None
            ids = np.array(ids, np.int64)
            at = np.cumsum(lengths[ids])
            last = np.searchsorted(at, ends)
            if (at[last] != ends).any():
                return None
            out.append((ids, np.diff(last, prepend=-1)))
        return out

    def tokens(self, side: int, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces' tokens in order, tokens of each piece)."""
        begin = self.begin[side]
        n = begin[pieces + 1] - begin[pieces]
        at = np.arange(n.sum()) + np.repeat(begin[pieces] - (np.cumsum(n) - n), n)
        return self.ids[side][at], n


def covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """For each token (doc, start) of ``left`` the row of the token of
    ``right`` that covers its first byte."""
    of = pd.merge_asof(left, right.assign(row=np.arange(len(right))), on="start", by="doc")
    return of["row"].to_numpy(np.int64)


class Run:
    """Aligned tokens of some documents, or of a part of one.

    ``docs``: document of each piece, ascending from 0; all pieces are spelled
    out by both sides, so that offsets of both sides agree.
    """

    def __init__(self, pieces: Pieces, numbers: np.ndarray, docs: np.ndarray, n_docs: int):
        self.n_docs = n_docs
        self.ids, self.doc, start = [], [], []
        for side in (0, 1):
            ids, n = pieces.tokens(side, numbers)
            length = pieces.lengths[side][ids]
            self.ids.append(ids)
            self.doc.append(np.repeat(docs, n))
            start.append(np.cumsum(length) - length)
        frames = [pd.DataFrame({"start": s, "doc": d}) for s, d in zip(start, self.doc)]
        cover = covering(*frames), covering(*frames[::-1])
        opens = [start[side] == start[1 - side][cover[side]] for side in (0, 1)]
        #: (token of A, token of B) of all overlaps: what covers A's starts, and what covers B's other starts.
        rest = np.flatnonzero(~opens[1])
        self.overlaps = np.concatenate([cover[1][rest], np.arange(len(cover[0]))]), np.concatenate([rest, cover[0]])
        self.group = [np.cumsum(o) - 1 for o in opens]
        self.size = [np.bincount(g, minlength=self.group[0][-1] + 1 if len(self.group[0]) else 0) for g in self.group]
        self.first = [np.cumsum(s) - s for s in self.size]
        self.group_doc = self.doc[0][self.first[0]]

    def per_doc(self) -> np.ndarray:
        """:data:`COUNTS` of each document."""
        n = lambda doc, weights=None: np.bincount(doc, weights, self.n_docs).astype(np.int64)
        links = np.zeros(self.n_docs, np.int64)
        np.add.at(links, self.group_doc, self.size[0] * self.size[1])
        return np.stack([n(self.doc[0]), n(self.doc[1]), n(self.group_doc), links, n(self.doc[0][self.overlaps[0]])], 1)

    def texts(self, words: np.ndarray) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3;``; ``words`` has
        every id with ``,``, ``|`` and ``;`` behind it."""
        out = np.empty(len(self.ids[0]) + len(self.ids[1]), object)
        doc = np.empty(len(out), np.int64)
        for side, other, close in ((0, self.first[1], 1), (1, self.first[0] + self.size[0], 2)):
            g, at = self.group[side], np.arange(len(self.ids[side]))
            last = at == (self.first[side] + self.size[side] - 1)[g]
            place = at + other[g]
            out[place] = words[np.where(last, close, 0), self.ids[side]]
            doc[place] = self.doc[side]
        ends = np.searchsorted(doc, np.arange(self.n_docs + 1))
        return ["".join(out[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]

    def links(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each document's pairs begin, pairs ``a * width + b``
        ascending, links of each)."""
        a, b = self.ids
        listed = self.size[0] * self.size[1] <= LISTED
        n = np.where(listed, self.size[1], 0)[self.group[0]]
        of = np.repeat(np.arange(len(a)), n)
        other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[1][self.group[0][of]]
        doc, pair, times = [self.doc[0][of]], [a[of] * width + b[other]], [np.ones(len(of), np.int64)]
        for g in np.flatnonzero(~listed):
            cut = [slice(f[g], f[g] + s[g]) for f, s in zip(self.first, self.size)]
            (ids_a, n_a), (ids_b, n_b) = (np.unique(x[c], return_counts=True) for x, c in zip((a, b), cut))
            pair.append((ids_a[:, None] * width + ids_b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
            doc.append(np.full(len(pair[-1]), self.group_doc[g]))
        doc, pair, times = map(np.concatenate, (doc, pair, times))
        return merged(doc, pair, times, self.n_docs)


def merged(doc: np.ndarray, pair: np.ndarray, times: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal pairs of a document added up, ascending; and where each begins."""
    span = int(pair.max()) + 1 if len(pair) else 1
    key = doc * span + pair
    order = np.argsort(key) if (times != 1).any() else None
    key = np.sort(key) if order is None else key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if order is None:
        times = np.diff(first, append=len(key))
    elif len(first):
        times = np.add.reduceat(times[order], first)
    doc, pair = np.divmod(key[first], span)
    return np.searchsorted(doc, np.arange(n_docs + 1)), pair, times


class _Document:
    """What the runs of one document add up to."""

    def __init__(self):
        self.counts, self.hash, self.parts, self.pairs, self.times, self.fine, self.open = np.zeros(5, np.int64), hashlib.sha256(), [], [], [], True, False

    def add(self, counts: np.ndarray, text: str, pairs: np.ndarray, times: np.ndarray, keep: bool) -> None:
        self.counts += counts
        self.hash.update((b";" if self.open else b"") + text[:-1].encode())  # the last ; is not part of the text
        self.open = True
        self.pairs.append(pairs)
        self.times.append(times)
        if keep:
            self.parts.append(text)

    def done(self) -> tuple:
        if not self.fine or not self.open:
            return np.zeros(5, np.int64), "", "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.pairs) > 1:
            _, pairs, times = merged(np.zeros(sum(map(len, self.pairs)), np.int64), np.concatenate(self.pairs), np.concatenate(self.times), 1)
        else:
            pairs, times = self.pairs[0], self.times[0]
        return self.counts, self.hash.hexdigest(), "".join(self.parts)[:-1], pairs, times


def _runs(texts: list[str | None], piece: re.Pattern) -> Iterator[tuple[list[int], list[list[str]]]]:
    """(documents, the pieces of each) of at most about RUN_BYTES; a longer
    document is spread over several."""
    docs, lists, size = [], [], 0
    for d, text in enumerate(texts):
        own, begin = piece.findall(" " + text) if text else [], 0
        if own and size + len(text) < RUN_BYTES:
            docs.append(d)
            lists.append(own)
            size += len(text)
            continue
        while begin < len(own):
            end = begin
            while end < len(own) and size < RUN_BYTES:
                size += len(own[end])
                end += 1
            docs.append(d)
            lists.append(own[begin:end])
            begin = end
            if size >= RUN_BYTES:
                yield docs, lists
                docs, lists, size = [], [], 0
    if docs:
        yield docs, lists


def align_texts(texts: list[str | None], pieces: Pieces, words: np.ndarray, keep: bool) -> list[tuple]:
    """(counts, digest, groups, pairs, links) of every text."""
    all_of = [_Document() for _ in texts]
    for docs, lists in _runs(texts, pieces.sides.piece):
        numbers = pieces.numbers(list(itertools.chain.from_iterable(lists)))
        of = np.repeat(np.arange(len(docs)), [len(x) for x in lists])
        for d in np.unique(of[~pieces.fine[numbers]]):
            all_of[docs[d]].fine = False
        good = np.array([all_of[d].fine for d in docs])
        held = good[of]
        if not held.any():
            continue
        place = np.cumsum(good) - 1
        run = Run(pieces, numbers[held], place[of[held]], int(good.sum()))
        counts, strings, (begin, pair, times) = run.per_doc(), run.texts(words), run.links(len(pieces.sides.b_bytes))
        for k, d in enumerate(np.flatnonzero(good)):
            cut = slice(begin[k], begin[k + 1])
            all_of[docs[d]].add(counts[k], strings[k], pair[cut], times[cut], keep)
    return [x.done() for x in all_of]


_COLUMNS = "block long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, groups string, pairs array<long>, links array<long>"


def align(docs: DataFrame, byte_level: str, pieces: bytes, id_col: str = "doc_id", text_col: str = "text", groups: bool = True) -> DataFrame:
    """Per document ``id``, its ``block``, the numbers of tokens, groups, links
    and overlaps, ``groups`` (if asked for) and their digest, ``pairs`` (ids
    ``a * vocabulary of B + b``, ascending) and how many ``links`` each has;
    and one row without ``n_a`` per block: its distinct pairs, and in ``links``
    how many of its documents hold each.

    ``byte_level`` and ``pieces`` are the contents of the tokenizers' files.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(byte_level, pieces)
        store = Pieces(sides)
        width = max(len(sides.a_bytes), len(sides.b_bytes))
        words = np.array([[f"{i}{end}" for i in range(width)] for end in ",|;"], object)
        block, size, held, schema = (TaskContext.get().partitionId() << 24), 0, [], None

        def summed() -> list:
            every, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            return [[None], [block], *[[None]] * 7, [every], [n]]

        def table(columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema([("id", batch.schema.field(0).type)] + [(n, pa.int64()) for n in ["block", *COUNTS]] + [
                    ("groups_sha256", pa.string()), ("groups", pa.string()), ("pairs", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])
            for part in sliced(batch, 1, RUN_BYTES):
                out = align_texts(part.column(1).to_pylist(), store, words, groups)
                counts, digests, texts, pairs, links = zip(*out)
                yield table([part.column(0).to_pylist(), [block] * len(out), *np.stack(counts, 1), digests,
                             texts if groups else [None] * len(out), pairs, links])
                held += pairs
                size += part.column(1).nbytes
                if size >= BLOCK_BYTES:
                    yield table(summed())
                    block, size, held = block + 1, 0, []
                    give_back()
        if held:
            yield table(summed())

    return rows.mapInArrow(aligned, f"id {id_type}, {_COLUMNS}")


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``(pair, n, best)``: documents that hold a pair linked, and whether no
    pair of its A id is in more."""
    sent = aligned.where(F.col("n_a").isNull()).select(F.explode(F.arrays_zip("pairs", "links")).alias("x")).select("x.pairs", "x.links")
    n = sent.groupBy(F.col("pairs").alias("pair")).agg(F.sum("links").alias("n"))
    of_a = W.partitionBy(F.expr(f"pair div {width}"))  # B's vocabulary bounds what one id can be linked with
    return n.withColumn("best", F.col("n") == F.max("n").over(of_a))


def _scored(key: tuple, docs: pa.Table, totals: pa.Table) -> pa.Table:
    """A block's documents with what its pairs' totals say of their links."""
    pair = totals.column("pair").to_numpy()
    order = np.argsort(pair)
    pair, n, best = pair[order], totals.column("n").to_numpy()[order], totals.column("best").to_numpy()[order]
    lists, links = docs.column("pairs").combine_chunks(), docs.column("links").combine_chunks()
    times = links.flatten().to_numpy()
    of = np.repeat(np.arange(docs.num_rows), pa.compute.list_value_length(lists).to_numpy())
    at = np.searchsorted(pair, lists.flatten().to_numpy())
    sums = [np.zeros(docs.num_rows, np.int64) for _ in range(2)]
    np.add.at(sums[0], of, times * best[at])
    np.add.at(sums[1], of, times * n[at])
    kept = docs.drop_columns(["block", "pairs", "links"])
    return kept.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


def score(docs: DataFrame, byte_level: str, pieces: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``(id_col, n_a, n_b, n_groups, n_links, n_overlaps,
    n_best, count_sum, groups_sha256)``.

    * A null or empty text, or one that a side's tokens do not spell out, has
      no tokens: zeros, and '' for the digest.
    * Rows are documents, repeated ones and those without an id too; other
      columns are not read.  An empty table gives no row.
    * A text of any length is aligned in runs of RUN_BYTES; a group of many
      tokens counts its links by distinct ids.
    """
    width = len(sides_of(byte_level, pieces).b_bytes)
    aligned = staged(align(docs, byte_level, pieces, id_col, text_col, groups=False).drop("groups"), "aligned-tokens")
    totals = staged(pair_counts(aligned, width), "pair-counts")
    asked = aligned.where(F.col("n_a").isNull()).select("block", F.explode("pairs").alias("pair"))
    told = asked.join(totals, "pair").select("block", "pair", "n", "best")
    own = aligned.where(F.col("n_a").isNotNull())
    id_type = aligned.schema["id"].dataType.simpleString()
    names = f"id {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, n_best long, count_sum long"
    own = own.select(F.col("block").alias("of"), *[c for c in own.columns if c != "block"]).withColumnRenamed("of", "block")
    scored = own.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_scored, names)
    return scored.select(F.col("id").alias(id_col), *COUNTS, "n_best", "count_sum", "groups_sha256")
