"""Channel and increment indexes and the forecast that applies them.

All inputs here are aggregates (forecast months x channels x increments), so
the joins are small; the planner broadcasts them at run time (AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.conditional import safe_div

FINAL_COLUMNS = ["scenario", "forecast_month", "month", "increments_from_signup", "channels",
                 "nrpd", "final_index", "data_volume", "forecast_nrpd_by_incre_channel"]


def increment_ratio(rates: DataFrame, max_increment: int = P.MAX_INCREMENT,
                    base: str | int = "first") -> DataFrame:
    """Increment index and its ratio to the base increment of the same month.

    ``base='first'``: the first non-null index in increment order (increment 0
    comes before 1 when present); an int: that increment's index.
    """
    inc = (rates.withColumn("increment_index", safe_div("nrpd_increment", "nrpd_all"))
           .where(F.col("increments_from_signup") <= max_increment))
    # Partitions hold at most max_increment + 1 rows: increments 0..max_increment
    # (the sign-up-month guard keeps every day difference >= -30).
    w = (W.partitionBy("forecast_month")
         .orderBy(F.col("increments_from_signup").asc_nulls_last())
         .rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    if base == "first":
        pick = F.col("increment_index")
    else:
        pick = F.when(F.col("increments_from_signup") == int(base), F.col("increment_index"))
    return (inc.withColumn("increment_index_1", F.first(pick, ignorenulls=True).over(w))
            .withColumn("ratio_increment_index", safe_div("increment_index", "increment_index_1")))


def index_table(channel_rates: DataFrame, ratios: DataFrame) -> DataFrame:
    """Every channel of a month with every increment ratio of that month."""
    ch = channel_rates.withColumn("channel_index", safe_div("nrpd_channel", "nrpd_all"))
    r = ratios.select("forecast_month", "increments_from_signup", "ratio_increment_index")
    # Ratios: increments 0..max_increment, so at most max_increment + 1 rows per
    # forecast month -> broadcast.
    return (ch.join(F.broadcast(r), "forecast_month", "left")
            .withColumn("final_index", F.col("channel_index") * F.col("ratio_increment_index")))


def final_forecast(forecast: DataFrame, index: DataFrame,
                   max_increment: int = P.MAX_INCREMENT) -> DataFrame:
    """Snapshot rate x channel-increment index, for increments up to the horizon."""
    ix = index.select("forecast_month", "increments_from_signup", "channels",
                      "final_index", "data_volume")
    return (forecast.where(F.col("increments_from_signup") <= max_increment)
            .join(ix, ["forecast_month", "increments_from_signup"], "left")
            .withColumn("forecast_nrpd_by_incre_channel", F.col("nrpd") * F.col("final_index"))
            .select(*FINAL_COLUMNS))
