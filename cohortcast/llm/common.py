"""Small helpers the text operators share."""

from __future__ import annotations

import ctypes
import functools
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast.operators.joins import hot_keys, split_hot_join
from cohortcast.session import fresh_path

#: Prefix of every helper column, so that no column of the input clashes.
OWN = "__cc_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage on storage every executor sees: what reads it never
    recomputes it, and a lost executor loses none of it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Shuffle partitions this session is sized for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def split_join(big: DataFrame, small: DataFrame, key: str, row_id: str) -> DataFrame:
    """Inner join of ``big`` with ``small``, which has one row per key.  A key
    with more than its part of the rows, one of four a shuffle partition, is
    split by a hash of ``row_id``; at most that many keys can have more, which
    bounds their list."""
    limit = max(1, math.ceil(big.count() / (4 * shuffle_width(big.sparkSession))))
    return split_hot_join(big, small, key, hot_keys(big, key, limit), row_id)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row: equal only for rows with the same id and the same text."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def blocks_for(total_bytes: int | None, block_bytes: int) -> int:
    """Number of blocks of about ``block_bytes`` that hold ``total_bytes``."""
    return max(1, math.ceil((total_bytes or 0) / block_bytes))


@functools.cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not glibc
        return lambda n: None


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on for other tasks,
    whose memory adds to what it keeps."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def sliced(batch: pa.RecordBatch, column: int, max_bytes: int):
    """Cuts a batch where its texts in ``column`` pass ``max_bytes``, so that
    what a task makes of one slice stays small; a longer text stands alone."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + (n or 0) > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if start < len(lengths):
        yield batch.slice(start)
