"""A written order with row numbers: the distributed form of sort + reset_index.

A global ``row_number()`` needs all rows in one task.  Here rows are dealt to
ranges of the order, sorted within them and written once; a row's number is its
place in its range plus the rows of the ranges before, which are prefix sums of
one count per range.

* :func:`sorted_with_position` -- sort, then number;
* :func:`with_row_index` -- number the rows in the order in which they lie;
* :func:`positions_between` -- the rows of a range of numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART, PLACE, BEFORE = "_cc_part", "_cc_place", "_cc_before"

#: How a caller stages a DataFrame under a name (plans.stages.Stages.put).
Stage = Callable[[DataFrame, str], DataFrame]


def _numbered(df: DataFrame, stage: Stage, position: str, start: int) -> DataFrame:
    """Numbers rows by (partition, place in it)."""
    if position in df.columns:
        raise ValueError(f"there is a column {position!r} already")
    # the id of a row is its partition, then its place in it (33 bits)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    cut = stage(df.select("*", F.spark_partition_id().alias(PART), place.alias(PLACE)), "ordered")
    # One row a partition: bounded by the number of shuffle partitions, so one
    # task may take it, and it is broadcast.
    counts = cut.groupBy(PART).count()
    ahead = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(PART, F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias(BEFORE))
    return (cut.join(F.broadcast(before), PART)
            .select(*df.columns, (F.col(BEFORE) + F.col(PLACE) + start).alias(position)))


def order_keys(df: DataFrame, cols: tuple[str, ...] | list[str]) -> list[Column]:
    """``cols`` ascending with NULLs last, then all other columns that can be
    ordered: ties have one order, and a value that a third of all rows share is
    split over ranges by what else the rows hold (equal rows stay together)."""
    rest = [f.name for f in df.schema.fields if f.name not in cols and f.dataType.typeName() not in ("map", "variant")]
    return [F.col(c).asc_nulls_last() for c in (*cols, *rest)]


def sorted_with_position(df: DataFrame, *cols: str, stage: Stage, position: str = "position", start: int = 0,
                         parts: int | None = None) -> DataFrame:
    """``df`` with each row's number in the order of ``cols`` (NULLs last, ties
    by the other columns), counted from ``start``.

    One range shuffle; the rows are staged between sorting and counting, so
    counts and numbers are of the same partitions whatever is retried.  Read
    the rows in order by sorting on ``position``, or a part of them by
    :func:`positions_between`.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = order_keys(df, cols)
    return _numbered(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), stage, position, start)


def with_row_index(df: DataFrame, *, stage: Stage, position: str = "position", start: int = 0) -> DataFrame:
    """``df`` with row numbers in its present order, by partition: no shuffle.
    The present order of an unsorted DataFrame is that of its files."""
    return _numbered(df, stage, position, start)


def positions_between(df: DataFrame, first: int, end: int, position: str = "position") -> DataFrame:
    """Rows ``first`` up to, not including, ``end``."""
    return df.where((F.col(position) >= first) & (F.col(position) < end))
