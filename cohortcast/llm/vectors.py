"""What the vector searches share: the rows that take part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vec_col: str, zero_too: bool, each: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(id long, vec array, copies long, row long)`` of the rows that can be
    searched; ``each`` makes of a component what counts for it.

    Null ids and vectors that are null, empty or hold null or non-finite
    components take no part (zero vectors only with ``zero_too``).  A vector
    shorter than the longest has zeros for what it lacks, so that an inner
    product adds up the components that both have.  Rows equal in id and
    vector are one here, ``copies`` of them; ``row`` tells the vectors of one
    id apart.
    """
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    big = float("inf")
    fine = F.forall("vec", lambda x: F.coalesce((x > -big) & (x < big), F.lit(False)))
    v = v.where(F.col("id").isNotNull() & (F.size("vec") > 0) & fine)
    if not zero_too:
        v = v.where(F.exists("vec", lambda x: x != 0))
    length = v.agg(F.max(F.size("vec"))).first()[0] or 0
    lacks = F.array_repeat(F.lit(0.0), F.lit(length) - F.size("vec"))
    v = v.withColumn("vec", F.when(F.size("vec") < length, F.concat("vec", lacks)).otherwise(F.col("vec")))
    if each is not None:
        v = v.withColumn("vec", F.transform("vec", each))
    return v.groupBy("id", "vec").agg(F.count(F.lit(1)).alias("copies")).withColumn("row", F.xxhash64("vec"))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``, the k best for each query row, of
    ``(query_id, row, vec_id, copies, score)``: repeated rows stand side by side."""
    rank = F.row_number().over(W.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id"))
    each = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))).alias("copy")
    return (found.select("query_id", "row", "vec_id", "score", each).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def divisible(by: int) -> Column:
    return F.col("id") % by == 0
