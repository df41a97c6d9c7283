"""Line dedup: repeated windows of consecutive lines lose their later copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortcast.llm.common import OWN, row_key

#: Consecutive lines that make up a window.
WINDOW_LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """One row per window: two 64-bit hashes of its lines, where it starts."""
    lines = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row"),
                        _lines(F.col(text_col)).alias("lines")).where(F.size("lines") >= k)
    of = lambda i: [F.get("lines", i + j) for j in range(k)]
    hashes = F.transform(F.sequence(F.lit(0), F.size("lines") - k), lambda i: F.struct(
        F.xxhash64(F.lit(1), *of(i)).alias("h1"), F.xxhash64(F.lit(2), *of(i)).alias("h2"), i.alias("pos"),
        (F.length(F.trim(F.concat(*of(i)))) > 0).alias("says")))
    return (lines.select("id", "row", F.explode(hashes).alias("w")).select("id", "row", "w.*")
            .where("says").drop("says"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW_LINES,
                removed_col: str = "removed_lines") -> DataFrame:
    """All columns of ``docs`` with later copies of repeated windows cut out of
    ``text_col``, and the number of lines that went in ``removed_col``.

    Every ``k`` consecutive lines are a window, at every offset.  Of all equal
    windows the first by (id, line) stays; the lines that the others cover are
    removed, overlapping covers merged.  So each removed window is still there
    earlier, or its lines were themselves copies of something earlier.

    * Windows of blank lines only are never copies; texts of fewer than ``k``
      lines have no window and stay as they are.
    * A null text stays null and an empty one empty; a text whose every line
      is a copy becomes empty, its row stays.
    * A null id counts as the first.  Rows with equal ids share their place in
      the order, so equal rows get equal results, and neither is the other's
      copy.
    * Other columns pass through; one named ``removed_col`` is replaced.

    Windows travel as hashes.  The counts are combined before they move, and
    only repeated windows are joined back, an equi-join whose hot keys (a
    passage that a third of all texts hold) are split like any skewed join's.
    """
    w = _windows(docs, id_col, text_col, k)
    first = (w.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "pos")).alias("first"))
             .where("n > 1").drop("n"))
    later = w.join(first, ["h1", "h2"]).where(F.struct("id", "pos") > F.col("first"))
    covered = (later.groupBy("id", "row").agg(F.array_sort(F.collect_set("pos")).alias(f"{OWN}at"))
               .withColumnsRenamed({"id": f"{OWN}id", "row": f"{OWN}row"}))
    at = F.col(f"{OWN}at")
    joined = docs.drop(removed_col).withColumn(f"{OWN}of", row_key(id_col, text_col)).join(
        covered, F.col(id_col).eqNullSafe(F.col(f"{OWN}id")) & (F.col(f"{OWN}of") == F.col(f"{OWN}row")), "left")
    # Covers that touch merge: one begins where the window before ends earlier.
    begins = F.filter(at, lambda p, i: (i == 0) | (p > F.get(at, i - 1) + k))
    ends = F.transform(F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) > p + k)),
                       lambda p: p + k)
    cuts = joined.withColumns({f"{OWN}begins": begins, f"{OWN}ends": ends,
                               f"{OWN}lines": F.when(at.isNotNull(), _lines(F.col(text_col)))})
    begins, ends, lines = (F.col(f"{OWN}{c}") for c in ("begins", "ends", "lines"))
    stays = lambda i: F.struct(  # noqa: E731  the lines between two covers
        F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("a"), F.coalesce(F.get(begins, i), F.size(lines)).alias("b"))
    kept = F.flatten(F.transform(F.transform(F.sequence(F.lit(0), F.size(begins)), stays),
                                 lambda s: F.slice(lines, s["a"] + 1, s["b"] - s["a"])))
    out = cuts.withColumn(f"{OWN}kept", F.when(at.isNotNull(), kept))
    gone = F.when(at.isNotNull(), F.size(lines) - F.size(f"{OWN}kept")).otherwise(0)
    text = F.when(at.isNotNull(), F.array_join(f"{OWN}kept", "\n")).otherwise(F.col(text_col))
    return out.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != removed_col],
                      gone.cast("long").alias(removed_col))


ORACLE = """
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
win AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c
  FROM line WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
nth AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS n
  FROM win WHERE c IS NOT NULL AND length(trim(a || b || c)) > 0),
gone AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS pos FROM nth WHERE n > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text,
         count(g.pos) AS removed_lines
  FROM line l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
  GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
