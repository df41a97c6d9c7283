"""A many-to-one equi-join that cannot be skewed by a hot key.

``big ⋈ small ON key`` where ``small`` holds one row per key (a lookup).  If
one key holds a large share of ``big`` -- one driver with a third of all
reservations -- a plain shuffle join sends all of it to one task.  AQE's skew
join does not help when ``small`` arrives already partitioned by an upstream
operator (here the de-duplication window), so hot keys are split explicitly:

* :func:`hot_keys` counts rows per key (map-side partial aggregation) and
  keeps keys above ``max_rows``, each with ``ceil(rows / max_rows)`` buckets.
  At most ``rows(big) / max_rows`` keys qualify: with a million rows a key, a
  trillion rows have a million keys of 16 bytes at most, so the table is
  broadcast at any size.
* :func:`split_hot_join` gives every row of a hot key a deterministic bucket
  (hash of a row id, so retries reproduce it) and repeats the key's single
  ``small`` row once per bucket; cold keys use bucket 0.  The join runs on
  (key, bucket), so no task receives more than about ``max_rows`` rows of
  one key, and no row is dropped or duplicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = "_buckets"
SALT = "_salt"


def hot_keys(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows and the buckets each needs.

    NULL keys never match an inner join (Spark drops them before the shuffle),
    so they are never hot.
    """
    return (df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > max_rows)
            .select(key, F.ceil(F.col("count") / F.lit(max_rows)).cast("long").alias(BUCKETS)))


def split_hot_join(big: DataFrame, small: DataFrame, key: str, hot: DataFrame, row_id: str) -> DataFrame:
    """Inner join of ``big`` with the one-row-per-key ``small`` on ``key``."""
    h = F.broadcast(hot.select(key, BUCKETS))
    salted = (big.join(h, key, "left")
              .withColumn(SALT, F.when(F.col(BUCKETS).isNull(), F.lit(0).cast("long"))
                          .otherwise(F.pmod(F.xxhash64(F.col(row_id)), F.col(BUCKETS))))
              .drop(BUCKETS))
    spread = (small.join(h, key, "left")
              .select("*", F.explode(F.sequence(F.lit(0).cast("long"),
                                                F.coalesce(F.col(BUCKETS), F.lit(1).cast("long")) - 1))
                      .alias(SALT))
              .drop(BUCKETS))
    return salted.join(spread, [key, SALT]).drop(SALT)
