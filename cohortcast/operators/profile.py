"""Whole-column profiles: every value of every column of a table is read.

One aggregation serves all columns of all tables: rows become (table, column,
value) with the value as text, equal ones are counted before the shuffle, and
the counts give rows, values, distinct values and a checksum that any changed,
lost or repeated value moves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A value's digest: twelve hexadecimal digits of its MD5; sums are kept below this prime.
DIGEST_DIGITS, CHECK_MODULUS = 12, 1_000_000_000_000_037
COLUMNS = ["input", "col_name", "n_rows", "n_values", "n_distinct", "checksum"]


def as_text(field: T.StructField) -> Column:
    """A column's values as text: doubles to six places, times to the second."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        # what a decimal cannot hold (NaN, infinities, very large) as it prints
        return F.coalesce(F.expr(f"try_cast(`{field.name}` as decimal(28,6))").cast("string"), c.cast("string"))
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``(input, col_name, n_rows, n_values, n_distinct, checksum)``, a row for
    each column of each table; one without rows has no line."""
    def long(name: str, df: DataFrame) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(f.name).alias("col_name"), as_text(f).alias("v")) for f in df.schema.fields])
        return df.select(F.lit(name).alias("input"), F.explode(cells).alias("cell")).select("input", "cell.col_name", "cell.v")

    cells = reduce(DataFrame.unionByName, [long(name, df) for name, df in tables.items()])
    counted = cells.groupBy("input", "col_name", "v").agg(F.count(F.lit(1)).alias("n"))
    digest = F.conv(F.substring(F.md5(F.col("v").cast("binary")), 1, DIGEST_DIGITS), 16, 10).cast("decimal(15,0)")
    weighted = F.sum((digest * F.col("n").cast("decimal(19,0)")).cast("decimal(38,0)"))
    return (counted.groupBy("input", "col_name")
            .agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("n_values"),
                 F.count("v").alias("n_distinct"),
                 F.coalesce(weighted % F.lit(CHECK_MODULUS).cast("decimal(38,0)"), F.lit(0)).cast("long").alias("checksum"))
            .select(*COLUMNS))
