"""Schema-level column helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cast_by_name(df: DataFrame, pattern: str = "month", to: T.DataType = T.DateType()) -> DataFrame:
    """Cast every column whose name contains ``pattern`` (any case) to ``to``.

    Works on the schema only: one projection, no data pass.
    """
    p = pattern.lower()
    return df.select([F.col(c).cast(to).alias(c) if p in c.lower() else F.col(c)
                      for c in df.columns])


def sort_nulls_last(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending sort with NULLs last (SQL warehouses' and pandas' default;
    Spark's ascending default puts NULLs first).  A global sort: use it only on
    small final tables."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])
