"""How far the sources of a language differ in their words.

Words are counted where the texts lie: a translate table lowers letters and
blanks separators in one pass, ``split`` cuts, one Counter a document gives its
frequencies, and a task adds them up per language and source before anything is
shuffled.  What follows works on these sparse counts: a word that a source
lacks has no row there.

Distances of sources take, for each word, the shares of both sources.  Words of
a language are dealt to blocks and its sources to chunks; a task sums the
distances of all pairs of two chunks over the words of one block, as arrays, so
a pair is one row per block, never one per word.  Words that neither chunk has
add the same amount each and are added at the end.

All arithmetic is exact: shares are integers in billionths, divided digit group
by digit group in 64 bits (:func:`shares`, sums of counts up to 9e15) or as
decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast.llm.common import staged

# ---------------------------------------------------------------------------
# The tokenizer's table, shares in billionths, smoothing.
# ---------------------------------------------------------------------------
#: A-Z in lower case; every other byte below 0x80 but a-z is a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
UNIT, ADD = 1_000_000_000, 2

#: Documents of a language that a kept term occurs in, and ranks of part ``term``.
MIN_DOCS, TOP_TERMS = 10, 10
#: Entries that a task counts before it hands them on.
HELD_TERMS = 400_000
#: Terms of a block and sources of a chunk.
BLOCK_TERMS, CHUNK_SOURCES = 2048, 128

COUNTED = "lang string, source string, term binary, n long, docs long"
PARTIAL = "lang string, a int, b int, total long, n_terms long"


def tokens(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    freq, docs, held = defaultdict(Counter), defaultdict(Counter), 0

    def out() -> pa.RecordBatch:
        rows = [(lang, source, term, n, docs[lang, source][term]) for (lang, source), c in freq.items() for term, n in c.items()]
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()))],
                                          ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for text, lang, source in zip(batch.column(0), *(batch.column(k).to_pylist() for k in (1, 2))):
            own = Counter(tokens(text.as_py()))
            all_of, docs_of = freq[lang, source], docs[lang, source]
            held -= len(docs_of)
            all_of.update(own)
            docs_of.update(own.keys())
            held += len(docs_of)
            if held >= HELD_TERMS:
                yield out()
                freq.clear()
                docs.clear()
                held = 0
    yield out()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of every term in every
    group, and documents that hold it."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                          for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    counted = texts.select(F.col("text").cast("binary").alias("text"), "lang", "source").mapInArrow(_count, COUNTED)
    return (counted.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share_sql(n: str, total: str, terms: str) -> Column:
    """``1 + floor(UNIT * (n + ADD) / (total + ADD * terms))``, in decimals; null if
    there are no terms."""
    return F.expr(f"1 + (cast({n} + {ADD} as decimal(20,0)) * cast({UNIT} as decimal(10,0))) div nullif(cast({total} + {ADD} * {terms} as decimal(20,0)), 0)")


def _distance_sql(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """As :func:`_share_sql` for arrays, ``total`` with the smoothing in it:
    long division by three groups of three digits, which fits 64 bits."""
    rest, out = n.astype(np.int64) + ADD, np.zeros(np.broadcast_shapes(n.shape, total.shape), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return 1 + out


def _pairs(key: tuple, counts: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over one block's terms of the distances of all pairs (a < b) of the
    sources of one or two chunks."""
    at, chunk = groups.column("at").to_numpy(), groups.column("chunk").to_numpy()
    order = np.argsort(at)
    at, chunk = at[order], chunk[order]
    total = (groups.column("total").to_numpy() + ADD * groups.column("terms").to_numpy())[order]
    row, column = np.unique(counts.column("term").to_numpy(), return_inverse=True) if counts.num_rows else (np.zeros(0, object), np.zeros(0, np.int64))
    dense = np.zeros((len(at), len(row)), np.int64)
    if counts.num_rows:
        dense[np.searchsorted(at, counts.column("of").to_numpy()), column] = counts.column("n").to_numpy()
    p = shares(dense, total[:, None])
    left, right = chunk.min(), chunk.max()
    rows = ([], [], [])
    for i in np.flatnonzero(chunk == left):
        others = np.flatnonzero((chunk == right) & (at > at[i]))
        if len(others):
            d = p[others] - p[i]
            rows[0].append(np.full(len(others), at[i]))
            rows[1].append(at[others])
            rows[2].append((d * d // (p[others] + p[i])).sum(1))
    a, b, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in rows)
    return pa.table([pa.array([key[0].as_py()] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                     pa.array(s, pa.int64()), pa.array(np.full(len(a), len(row)), pa.int64())], names=["lang", "a", "b", "total", "n_terms"])


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source lies
    from the others of its language (part ``pair``), and the terms that it has
    more of than its language (part ``term``).

    * A null or empty text has no term, its group still occurs; a null language
      or source is ''.
    * Ties of a value go by the item's UTF-8 bytes; repeated rows count each;
      an empty table gives no row; further columns are not read.
    * A language without kept terms has pairs of distance 0 and no terms.
    """
    counts = staged(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).where(F.col("docs") >= min_docs)
    kept = staged(kept.select("lang", "term", "all"), "kept-terms")
    sparse = staged(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"), "kept-counts")

    text = lambda c, n: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
    occurring = docs.select(text(lang_col, "lang"), text(source_col, "source")).distinct()
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_total"))
    totals = sparse.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    # one row a group, numbered within its language
    groups = (occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
              .withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("chunk", F.floor(F.col("at") / F.lit(CHUNK_SOURCES)).cast("int"))
              .withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("terms") / F.lit(BLOCK_TERMS)))))
    groups = staged(groups.withColumn("chunks", F.max("chunk").over(W.partitionBy("lang")) + 1), "audit-groups")
    return _terms(sparse, groups, top_terms).unionByName(_distances(sparse, groups))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    w = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(w))
    if most is not None:
        out = out.where(F.col("rank") <= most)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(sparse: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """Each group's terms above its language; only the first ranks are shuffled."""
    of = sparse.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    pq = of.withColumn("p", _share_sql("n", "total", "terms")).withColumn("q", _share_sql("all", "lang_total", "terms"))
    above = pq.where(F.col("p") > F.col("q")).withColumn("value", _distance_sql("p", "q")).withColumnRenamed("term", "item")
    return _ranked(above, "term", most)


def _tiles(rows: DataFrame) -> DataFrame:
    """Each row to the tiles (left, right) of chunks that its chunk is part of:
    one where a language has one chunk of sources."""
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return rows.select("*", other).withColumn("left", F.least("chunk", "other")).withColumn("right", F.greatest("chunk", "other"))


def _distances(sparse: DataFrame, groups: DataFrame) -> DataFrame:
    key = ["lang", "block", "left", "right"]
    counts = (_tiles(sparse.join(groups.select("lang", "source", "at", "chunk", "chunks", "blocks"), ["lang", "source"]))
              .select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "left", "right", F.col("at").alias("of"),
                      F.xxhash64(F.col("term"), F.lit(1)).alias("term"), "n"))
    sides = (_tiles(groups).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
             .select(*key, "at", "chunk", "total", "terms"))
    sums = counts.groupBy(*key).cogroup(sides.groupBy(*key)).applyInArrow(_pairs, PARTIAL)
    of_pair = sums.groupBy("lang", "a", "b").agg(F.sum("total").alias("total"), F.sum("n_terms").alias("n_terms"))
    both = of_pair.unionByName(of_pair.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "total", "n_terms"))
    side = lambda at, name, total: groups.select("lang", F.col("at").alias(at), F.col("source").alias(name), F.col("total").alias(total), *(["terms"] if at == "a" else []))
    named = both.join(side("a", "source", "n_a"), ["lang", "a"]).join(side("b", "item", "n_b"), ["lang", "b"])
    absent = named.withColumn("p", _share_sql("0L", "n_a", "terms")).withColumn("q", _share_sql("0L", "n_b", "terms"))
    nothing = F.coalesce(_distance_sql("p", "q"), F.lit(0).cast("long"))  # no kept term: no share
    return _ranked(absent.withColumn("value", F.col("total") + (F.col("terms") - F.col("n_terms")) * nothing), "pair")


_TEXT = r"[A-Za-z\x{80}-\x{10FFFF}]+"
#: DuckDB twin: every kept term of a language in every one of its groups.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
           FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TEXT}')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {MIN_DOCS}),
l AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(f.n, 0)::HUGEINT AS n, k.n::HUGEINT AS n_lang
      FROM groups g JOIN kept k USING (lang) LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
t AS (SELECT *, sum(n) OVER (PARTITION BY lang, source)::HUGEINT AS total FROM c),
p AS (SELECT t.lang, t.source, t.term, t.n, 1 + {UNIT}::HUGEINT * (t.n + {ADD}) // (t.total + {ADD} * l.v) AS p,
             1 + {UNIT}::HUGEINT * (t.n_lang + {ADD}) // (l.total + {ADD} * l.v) AS q
      FROM t JOIN l USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
above AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM every UNION ALL SELECT * FROM above))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""
