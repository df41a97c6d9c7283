"""Finance forecast snapshots (long-format budget ledger) as monthly rates.

The ledger is reduced by one partial aggregation per (snapshot, month) before
anything else, so a snapshot holding most of the ledger does not skew a task;
everything after works on at most (snapshots x months) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.conditional import safe_div
from cohortcast.functions.numeric import sum_parts, sum_terms, value
from cohortcast.functions.dates import (months_between_inclusive, parse_month,
                                        scenario_actual_month)


def ledger_last_modified(ledger: DataFrame) -> DataFrame:
    """Latest edit time per snapshot, over all countries."""
    return ledger.groupBy("scenario").agg(F.max("modified_at").alias("last_modified_at"))


def scenario_months(ledger: DataFrame) -> DataFrame:
    """Per snapshot: latest edit and the last month of actuals it declares."""
    return (ledger_last_modified(ledger)
            .withColumn("last_actual_month", scenario_actual_month("scenario", "last_modified_at")))


def ledger_months(ledger: DataFrame) -> DataFrame:
    """Distinct month labels with their parsed first-of-month date."""
    return (ledger.select(F.col("month").alias("month_label")).distinct()
            .withColumn("month", parse_month("month_label")))


def ledger_snapshots(ledger: DataFrame, params: P.Params = P.PRODUCTION) -> DataFrame:
    """Net revenue, trip days and their ratio per snapshot and month.

    One pass over the ledger: an aggregation per (snapshot, month label) takes
    the latest edit over every country and the sums over the chosen country
    (other rows add NULL, which sums ignore).  Labels are parsed on that small
    result, where those of one month (letter case) are added up, and a window
    spreads each snapshot's latest edit to its months.
    """
    allowed = ledger.where(F.col("scenario").isin(*params.scenarios))
    in_country = F.col("country") == params.country
    is_rev = ((F.col("metric") == P.NET_REVENUE_METRIC)
              & (F.col("revenue_category") != P.EXCLUDED_REVENUE_CATEGORY))
    is_days = F.col("metric") == P.TRIP_DAYS_METRIC
    value_of = lambda rows: F.when(in_country & rows, F.col("value"))
    per_label = (allowed.groupBy("scenario", "month")
                 .agg(F.max("modified_at").alias("_latest"), F.count(F.when(in_country, 1)).alias("_rows"),
                      *sum_terms(value_of(is_rev), "net_revenue"), *sum_terms(value_of(is_days), "trip_days")))
    # A month without a matching row sums to zero.
    per_month = (per_label.groupBy("scenario", parse_month("month").alias("month"))
                 .agg(F.max("_latest").alias("_latest"), F.sum("_rows").alias("_rows"),
                      *sum_parts("net_revenue"), *sum_parts("trip_days"))
                 .select("scenario", "month", "_latest", "_rows",
                         *[F.coalesce(value(m), F.lit(0.0)).alias(m) for m in ("net_revenue", "trip_days")]))
    # A snapshot has one row per month of its horizon: bounded partitions.
    stamp = F.max("_latest").over(W.partitionBy("scenario"))
    return (per_month.withColumn("last_modified_at", stamp)
            .where(F.col("_rows") > 0)
            .select("scenario", "last_modified_at",
                    scenario_actual_month("scenario", "last_modified_at").alias("last_actual_month"),
                    "month", "net_revenue", "trip_days",
                    safe_div("net_revenue", "trip_days").alias("nrpd")))


def forecast_only(snapshots: DataFrame) -> DataFrame:
    """Keep each snapshot's forecast months; number them from the first one."""
    return (snapshots.where(F.col("month") > F.col("last_actual_month"))
            .withColumn("forecast_month", F.add_months("last_actual_month", 1))
            .withColumn("increments_from_signup", months_between_inclusive("month", "forecast_month")))
