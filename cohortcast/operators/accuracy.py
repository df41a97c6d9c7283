"""Actuals and the paid-day-weighted back-test of forecasts against them.

Everything after :func:`actuals` works on aggregates (scenario x month x
channel), so joins are small and window partitions are bounded: a
(scenario, forecast_month, channel) group holds one row per forecast month of
the horizon, i.e. at most ``max_increment`` rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.conditional import safe_div
from cohortcast.functions.dates import signup_month_of
from cohortcast.functions.numeric import exact_sum, value

GROUP_KEYS = ["scenario", "forecast_month", "channels"]
WEIGHTED = ["w_rate_new", "w_rate_old", "w_rate_actual"]


def maturity_cutoff(as_of: dt.date | None) -> Column:
    """First month not yet mature: one month before the month of ``as_of``."""
    today = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
    return F.add_months(F.trunc(today, "MM"), -1)


def actuals(cube: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Sums and rate per channel, cohort month and increment, mature months only.

    ``cube`` is already at this grain (see ``facts.cohort_cube``), so this is a
    filter and a projection, not another aggregation.
    """
    return (cube.where(F.col("trip_month") < maturity_cutoff(as_of))
            .select("channels", F.col("trip_month").alias("month"), "increments_from_signup",
                    "paid_days", value("net_revenue").alias("net_revenue"), value("trips").alias("data_volume"))
            .withColumn("nrpd", safe_div("net_revenue", "paid_days")))


def actual_signup_month(act: DataFrame) -> DataFrame:
    """Add each actual row's sign-up month (month - (increment - 1) months)."""
    return act.withColumn("signup_month", signup_month_of("month", "increments_from_signup"))


def accuracy_join(forecast: DataFrame, legacy: DataFrame, act: DataFrame) -> DataFrame:
    """New forecast ⟕ legacy forecast ⟕ actuals, per channel, month and increment.

    Channels are matched null-safely (a NULL channel meets a NULL channel).
    """
    v2 = forecast.withColumnRenamed("forecast_nrpd_by_incre_channel", "rate_new")
    v1 = legacy.select(F.col("channels").alias("_v1_channels"),
                       F.col("signup_month").alias("_v1_month"),
                       F.col("increments_from_signup").alias("_v1_inc"),
                       F.col("net_revenue_per_paid_day").alias("rate_old"))
    a = act.select(F.col("channels").alias("_a_channels"), F.col("month").alias("_a_month"),
                   F.col("increments_from_signup").alias("_a_inc"),
                   F.col("data_volume").alias("data_volume_actual"), "paid_days",
                   F.col("nrpd").alias("rate_actual"))
    inc = F.col("increments_from_signup")
    j = (v2.join(v1, F.col("channels").eqNullSafe(F.col("_v1_channels"))
                 & (F.col("forecast_month") == F.col("_v1_month")) & (inc == F.col("_v1_inc")), "left")
         .join(a, F.col("channels").eqNullSafe(F.col("_a_channels"))
               & (F.col("month") == F.col("_a_month")) & (inc == F.col("_a_inc")), "left"))
    return j.select("scenario", "forecast_month", "channels", "month", "data_volume_actual",
                    "paid_days", "rate_new", "rate_old", "rate_actual")


def payback_filter(acc: DataFrame, channels=P.PRODUCTION_PAYBACK_CHANNELS) -> DataFrame:
    """Keep the back-tested channels only."""
    return acc.where(F.col("channels").isin(*channels))


def paid_days_weight(acc: DataFrame) -> DataFrame:
    """Each row's share of its group's paid days (NULL when the group has none)."""
    w = W.partitionBy(*GROUP_KEYS)
    return acc.withColumn("paid_days_weight", safe_div("paid_days", F.sum("paid_days").over(w)))


def weighted_accuracy(acc: DataFrame) -> DataFrame:
    """Paid-day-weighted forecast and actual rates per (scenario, month, channel).

    A weighted sum that is zero or has no inputs is NULL; volume is 0 then.
    """
    wt = paid_days_weight(acc)
    return (wt.groupBy(*GROUP_KEYS)
            .agg(*[F.nullif(exact_sum(F.col(src) * F.col("paid_days_weight")), F.lit(0.0)).alias(dst)
                   for src, dst in zip(["rate_new", "rate_old", "rate_actual"], WEIGHTED)],
                 F.coalesce(exact_sum("data_volume_actual"), F.lit(0.0)).alias("data_volume_actual")))
