"""N-gram Jaccard join: T-occurrence search with DivideSkip.

Two documents link when the Jaccard similarity of their shingle sets reaches a
threshold.  Then the overlap is at least that share of the larger set, so a
partner of a set of s shingles shares at least T = ceil(0.75 s) of them: it
occurs on T of the s inverted lists.

1. Which documents can have a partner?  Shingles are in hash order.  In the
   first s - T + l of them stand at least l of any partner's (at most s - T are
   not shared), and the least l shared ones stand in both prefixes.  So a
   document whose prefix holds too few shingles of other prefixes is done.
2. The others are collapsed to one per equal set.  Of their shingles the corpus
   totals are the lengths of the inverted lists; a set with fewer than T lists
   longer than one is done.  Rarest first, any two partners share one of the
   first s - T + 1: sets that are connected through those form a shard.
3. Every shard is searched on its own with DivideSkip: the short lists are
   merged for sets on at least T - L of them, the L longest lists are only
   probed by binary search for those, and the exact overlap decides.  A shard
   of more sets than one task takes is searched by pairs of its chunks.
4. Every link counts for both of its sets, added up by task; those that join
   two trees of a task's forest are kept, and their components are found by
   label contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast.llm import exchange
from cohortcast.llm.common import OWN, give_back, split_join, staged
from cohortcast.llm.components import components
from cohortcast.llm.words import shingle_sets

#: Words of a shingle, similarity in percent.
WORDS, PERCENT = 5, 75
#: Text bytes of a block, sets that one task searches against each other.
BLOCK_BYTES, CHUNK_SETS = 4_000_000, 600
#: How DivideSkip weighs a probe of a long list against a merge of it.
MU = 0.0085


def least_overlap(size: int, percent: int) -> int:
    """Shingles that any partner of a set of this size shares."""
    return -(-percent * size // 100)


def _extra(size: int) -> int:
    """l of a set of this size: shared shingles that its prefix must hold."""
    return max(1, size // 4)


def _live(sets: list[np.ndarray], percent: int):
    """Prefixes in hash order, and how many repeated shingles each must hold."""
    prefix = [s[:len(s) - least_overlap(len(s), percent) + _extra(len(s))] for s in sets]
    # a partner may be smaller, down to the least overlap, and ask for less
    must = [_extra(least_overlap(len(s), percent)) for s in sets]
    return prefix, must


def shingled(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """``(id, n, digest, shingles)`` of every row; digest and shingles, packed,
    only for those that can have a partner."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows, parts = exchange.in_blocks(named, "octet_length(text)", BLOCK_BYTES, "id")

    def ask(table: pa.Table) -> pa.Table:
        prefix, _ = _live(shingle_sets(table.column("text").to_pylist(), words), percent)
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *prefix]), return_counts=True)
        give_back()
        return exchange.ask(table.column("block")[0].as_py(), keys, np.minimum(counts, 2)[:, None], parts)

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        sets = shingle_sets(left.column("text").to_pylist(), words)
        prefix, must = _live(sets, percent)
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *prefix]))
        shared = exchange.answered(right, keys, parts, "u1") > 0
        able = [len(p) > 0 and int(shared[np.searchsorted(keys, p)].sum()) >= m for p, m in zip(prefix, must)]
        # the id null has no place among ids: such a row links with nothing
        able = [a and i is not None for a, i in zip(able, left.column("id").to_pylist())]
        packed = [s.tobytes() if a else None for s, a in zip(sets, able)]
        give_back()
        return pa.table([left.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                         pa.array([p and hashlib.blake2b(p, digest_size=16).digest() for p in packed], pa.binary()),
                         pa.array(packed, pa.binary())], names=["id", "n", "digest", "shingles"])

    asked = rows.groupBy("block").applyInArrow(ask, exchange.REQUEST)
    said = exchange.answers(asked, 1, lambda totals: totals[:, 0] > 1, "u1")
    return (rows.groupBy("block").cogroup(said.groupBy("block"))
            .applyInArrow(keep, "id long, n long, digest binary, shingles binary"))


def _unpack(column) -> list[np.ndarray]:
    return [np.frombuffer(s, "<u8") for s in column.to_pylist()]


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """``(token, id)``: the rarest-first prefix of each set, as far as other
    sets hold its tokens; nothing of a set that too few of its tokens recur for."""
    rows, parts = exchange.in_blocks(sets, "octet_length(shingles)", BLOCK_BYTES, "id")

    def ask(table: pa.Table) -> pa.Table:
        keys, counts = np.unique(np.concatenate(_unpack(table.column("shingles"))), return_counts=True)
        return exchange.ask(table.column("block")[0].as_py(), keys, counts[:, None], parts)

    def take(left: pa.Table, right: pa.Table) -> pa.Table:
        sets = _unpack(left.column("shingles"))
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]))
        length = exchange.answered(right, keys, parts, "<u4")
        tokens, ids = [], []
        for i, s in zip(left.column("id").to_pylist(), sets):
            n, t = length[np.searchsorted(keys, s)], least_overlap(len(s), percent)
            if int((n > 1).sum()) >= t:
                first = np.lexsort((s, n))[:len(s) - t + 1]
                first = first[n[first] > 1]
                tokens.append(s[first])
                ids.append(np.full(len(first), i))
        flat = np.concatenate([np.zeros(0, np.uint64), *tokens])
        return pa.table([pa.array(flat.view(np.int64)), pa.array(np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64))],
                        names=["token", "id"])

    asked = rows.groupBy("block").applyInArrow(ask, exchange.REQUEST)
    said = exchange.answers(asked, 1, lambda totals: np.minimum(totals[:, 0], (1 << 32) - 1), "<u4")
    return rows.groupBy("block").cogroup(said.groupBy("block")).applyInArrow(take, "token long, id long")


class _Forest:
    """Which sets are connected already."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def roots(self, at: np.ndarray) -> np.ndarray:
        """Roots of many sets; their paths become short."""
        top = self.up[at]
        while True:
            over = self.up[top]
            if (over == top).all():
                self.up[at] = top
                return top
            top = over


def divide_skip(sets: list[np.ndarray], queries: range, index: range, percent: int, weights: np.ndarray | None = None,
                counts: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Links (positions) that connect what is connected among ``queries`` and
    ``index`` (a range with itself, or two apart): a search of the index for
    each query.  With ``counts`` every link is verified, and adds to either
    set's count the other's weight; without, only sets not connected yet are."""
    chosen = [*index]
    flat = np.concatenate([sets[i] for i in chosen])
    owner = np.repeat(np.array(chosen), [len(sets[i]) for i in chosen])
    order = np.argsort(flat, kind="stable")  # owners ascend along each list
    tokens, begin = np.unique(flat[order], return_index=True)
    owner, begin = owner[order], np.append(begin, len(flat))
    sizes = np.array([len(s) for s in sets])
    forest, within = _Forest(len(sets)), queries == index
    for q in queries:
        s = sets[q]
        need = least_overlap(len(s), percent)
        at = np.searchsorted(tokens, s)
        at = at[(at < len(tokens)) & (tokens[np.minimum(at, len(tokens) - 1)] == s)]
        length = begin[at + 1] - begin[at]
        if within:
            at, length = at[length > 1], length[length > 1]
        if len(at) < need:
            continue
        by = np.argsort(length, kind="stable")
        at, length = at[by], length[by]
        n_long = min(need - 1, int(need / (MU * np.log2(length[-1] + 1) + 1)))
        short, long = at[:len(at) - n_long], at[len(at) - n_long:]
        # merge of the short lists: sorted together, equal owners counted
        merged = np.concatenate([owner[begin[k]:begin[k + 1]] for k in short])
        cand, count = np.unique(merged, return_counts=True)
        fit = (count >= need - n_long) & (cand > q if within else True)
        fit &= (percent * sizes[cand] <= 100 * len(s)) & (percent * len(s) <= 100 * sizes[cand])
        cand, count = cand[fit], count[fit]
        if len(cand) and counts is None:
            apart = forest.roots(cand) != forest.root(q)
            cand, count = cand[apart], count[apart]
        left = len(long)
        for k in long:  # binary probes, as long as a candidate can reach T
            if not len(cand):
                break
            entries = owner[begin[k]:begin[k + 1]]
            spot = np.minimum(np.searchsorted(entries, cand), len(entries) - 1)
            count = count + (entries[spot] == cand)
            left -= 1
            able = count + left >= need
            cand, count = cand[able], count[able]
        links = 100 * count >= percent * (len(s) + sizes[cand] - count)
        cand = cand[links]
        if counts is not None and len(cand):
            counts[q] += weights[cand].sum()
            counts[cand] += weights[q]
            cand = cand[forest.roots(cand) != forest.root(q)]
        for c in cand:
            a, b = forest.root(q), forest.root(c)
            if a != b:
                forest.up[max(a, b)] = min(a, b)
                yield q, int(c)


def links(sets: DataFrame, percent: int, counted: bool) -> DataFrame:
    """Of ``sets (id, shingles, weight)``: ``(a, b, null)``, links that connect
    what is connected; if ``counted`` also ``(a, null, n)``, the weight of all
    sets that one task links with a, to be added up."""
    spark = sets.sparkSession
    lists = staged(postings(sets, percent), "jaccard-prefixes")
    heads = lists.groupBy("token").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    near = lists.join(heads, "token").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    shard = staged(components(near).withColumnRenamed("component", "shard"), "jaccard-shards")
    size = shard.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
    # Small shards share a task; a large one is cut into chunks, by hash, and
    # every pair of chunks is a task.
    packs = max(4 * exchange.shuffle_width(spark), 64)
    placed = (shard.join(size, "shard").join(sets, F.col("node") == F.col("id")).drop("node")
              .withColumn("chunks", F.ceil(F.col("size") / CHUNK_SETS).cast("int"))
              .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")))
    whole = placed.where("chunks = 1").select(F.pmod(F.xxhash64("shard"), F.lit(packs)).alias("task"),
                                              F.lit(-1).alias("i"), F.lit(-1).alias("j"), "shard", "chunk", "id", "weight", "shingles")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    cut = (placed.where("chunks > 1").select("*", other)
           .select(F.col("shard").alias("task"), F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                   "shard", "chunk", "id", "weight", "shingles"))

    def search(table: pa.Table) -> pa.Table:
        shard, chunk = table.column("shard").to_numpy(), table.column("chunk").to_numpy()
        ids, sets = table.column("id").to_numpy(), _unpack(table.column("shingles"))
        order = np.lexsort((ids, chunk, shard))
        ids, sets, shard, chunk = ids[order], [sets[k] for k in order], shard[order], chunk[order]
        weights, counts = table.column("weight").to_numpy()[order], np.zeros(len(ids), np.int64)
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        out = []
        edges = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
        for a, b in zip(edges, np.append(edges[1:], len(shard))):
            own, half = sets[a:b], int(np.searchsorted(chunk[a:b], j)) if i != j else 0
            found = divide_skip(own, range(half, b - a), range(half) if half else range(b - a), percent, weights[a:b],
                                counts[a:b] if counted else None) if b - a > 1 else ()
            out += [(ids[a + x], ids[a + y]) for x, y in found]
        some = np.flatnonzero(counts)
        return pa.table([pa.array([*(x for x, _ in out), *ids[some]], pa.int64()),
                         pa.array([*(y for _, y in out), *[None] * len(some)], pa.int64()),
                         pa.array([*[None] * len(out), *counts[some]], pa.int64())], names=["a", "b", "n"])

    return whole.unionByName(cut).groupBy("task", "i", "j").applyInArrow(search, "a long, b long, n long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
         percent: int = PERCENT, counted: bool = True) -> DataFrame:
    """``(id_col, n_shingles, component_id, n_links)`` of every row.

    A text's set holds its distinct shingles of ``words`` words; a shorter
    text's the whole sequence; a text that is null or without words has an
    empty set and links with nothing.  Rows link at a Jaccard similarity of
    ``percent`` or more; ``n_links`` is the number of other rows that a row
    links with, copies of its text and rows repeated included, and
    ``component_id`` the smallest id reachable by links, the own included.  Ids
    are integers; a row without id links with nothing and has no component.
    Rows of one id and different sets link on their own.

    Rows with equal sets are one in the search, weighted by their number, so
    repeated rows and groups of copies of any size cost what one does.  Every
    pair of different sets that can link is verified.  Not ``counted``,
    ``n_links`` is left out, and of links between sets that are connected
    already none is verified; components are the same.  Extra columns are not
    read.
    """
    rows = staged(shingled(docs, id_col, text_col, words, percent), "jaccard-sets")
    able = rows.where("digest IS NOT NULL")
    first = staged(able.groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
                   .withColumn("node", F.xxhash64("digest")), "jaccard-classes")
    sets = staged(able.select("id", "digest", "shingles").join(first, ["id", "digest"]).dropDuplicates(["digest"])
                  .select(F.col("node").alias("id"), "weight", "shingles"), "jaccard-classes")
    found = staged(links(sets, percent, counted), "jaccard-links")
    named = first.join(components(found.where("b IS NOT NULL").select("a", "b")), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    number = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    classes = named.join(least, "component").join(number, "node", "left").select(
        "digest", "component_id", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    linked = able.select("id", "n", "digest").join(classes, "digest").select("id", "n", "component_id", "n_links")
    alone = rows.where("digest IS NULL").select("id", "n", F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    out = linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "n_links")
    return out if counted else out.drop("n_links")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of near copies: the smallest id,
    null last; of one id's texts that are near copies the first by a hash.

    A row is known by its id and text.  Rows of one id whose texts are not near
    copies stay, rows without id are held against all others, of rows equal in
    id and text one stays (whichever), and different rows without words stay.
    Only what goes and what is repeated is looked up, no text is sorted.
    """
    key, nth = f"{OWN}key", f"{OWN}nth"
    text = F.col(text_col).cast("string")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("string"), text.isNull(), text))
    rows = staged(keyed.groupBy(key).agg(F.min(id_col).alias("id"), F.count(F.lit(1)).alias("n")), "jaccard-rows")
    near = join(keyed.select(key, text.alias("text")), key, "text", counted=False).select(key, "component_id").distinct()
    found = staged(near.join(rows.select(key, "id"), key), "jaccard-members")
    best = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", key)).alias("best"), F.count(F.lit(1)).alias("n"))
    gone = (split_join(found, best.where("n > 1").drop("n"), "component_id", key).where(F.col(key) != F.col(f"best.{key}")).select(key))
    stay = keyed.join(gone, key, "left_anti")
    again = rows.where("n > 1").select(key)
    one = (stay.join(again, key, "left_semi").withColumn(nth, F.row_number().over(W.partitionBy(key).orderBy(key)))
           .where(F.col(nth) == 1).drop(nth))
    return stay.join(again, key, "left_anti").unionByName(one).drop(key)


#: DuckDB twin of :func:`join` on ``documents``: every pair that shares a
#: shingle is counted, components by walking the links.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (
  SELECT doc_id, unnest(CASE WHEN len(words) >= 5 THEN [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]
                             WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w)),
n AS (SELECT doc_id, count(shingle) AS n_shingles FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)),
reach AS (SELECT doc_id AS node, doc_id AS found FROM documents
          UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.found)
SELECT n.doc_id, n.n_shingles, least_id AS component_id, coalesce(n_links, 0) AS n_links
FROM n JOIN (SELECT node, min(found) AS least_id FROM reach GROUP BY node) ON node = n.doc_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) ON a = n.doc_id"""
