"""Trailing-window sums over a forecast-month spine, and the rates from them.

The window for forecast month ``fm`` is cohort months ``[fm - N, fm - 1]``.
Because both months are first-of-month dates, that is the same as
``fm in {tm + 1, ..., tm + N}``: each pre-aggregated (trip_month, key) row
is fanned out to its N forecast months with ``explode(sequence(1, N))`` and
the spine is left-joined by equality.  No theta or nested-loop join, and the
fan-out runs on the cohort cube (months x channels x increments rows), never
on the facts.  The spine (one row per month) is broadcast.
Spine months without facts keep one row with NULL key and NULL sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.conditional import safe_div
from cohortcast.functions.dates import since_literal
from cohortcast.functions.numeric import parts, sum_parts, value


def forecast_spine(base: DataFrame, since=P.PRODUCTION_SINCE) -> DataFrame:
    """Distinct sign-up months from ``since`` on, as ``forecast_month``."""
    return (base.select(F.col("signup_month").alias("forecast_month"))
            .where(F.col("forecast_month") >= since_literal(since))
            .distinct())


# Measures carried as the parts of an exact sum.
EXACT = ("net_revenue", "trips")


def trailing_sums(spine: DataFrame, monthly: DataFrame, keys: list[str], measures: list[str],
                  months: int = P.WINDOW_MONTHS, bounded_keys: bool = True) -> DataFrame:
    """Sum ``measures`` of ``monthly`` (rows keyed by ``trip_month`` + ``keys``,
    several rows per key allowed) over the ``months`` cohort months before each
    spine month.  One exchange: fan-out, spine semi-join and partial sums all
    run in the map stage.

    ``bounded_keys``: the keys have a known bound (increments: at most one per
    month of history; no keys: one row per month), so the sums are broadcast
    into the spine's join.  Otherwise (channel labels, free text) the planner
    decides from the runtime size (AQE), with a sort-merge join beyond it.
    """
    carried = [c for m in measures for c in (parts(m) if m in EXACT else [m])]
    fan = (monthly.select("trip_month", *keys, *carried,
                          F.explode(F.sequence(F.lit(1), F.lit(months))).alias("_k"))
           .select(F.add_months("trip_month", F.col("_k")).alias("forecast_month"), *keys, *carried)
           .join(F.broadcast(spine), "forecast_month", "left_semi"))
    sums = [c for m in measures for c in (sum_parts(m) if m in EXACT else [F.sum(m).alias(m)])]
    agg = fan.groupBy("forecast_month", *keys).agg(*sums)
    # Sums: at most (spine months x distinct keys) rows.
    return spine.join(F.broadcast(agg) if bounded_keys else agg, "forecast_month", "left")


def _to_units(df: DataFrame, keys: list[str], with_trips: bool) -> DataFrame:
    cols = ["forecast_month", *keys, "paid_days",
            value("net_revenue").alias("net_revenue_usd")]
    if with_trips:
        cols.append(value("trips").alias("trips"))
    return df.select(*cols)


# The cube is fanned out as is: its measures are exact sums, so summing
# cube rows directly equals summing a per-month pre-aggregate, bit for bit.
def channel_sums(spine: DataFrame, cube: DataFrame, months: int = P.WINDOW_MONTHS) -> DataFrame:
    """Trailing sums per forecast month and channel, increment 1 only."""
    m = ["paid_days", "net_revenue", "trips"]
    inc1 = cube.where(F.col("increments_from_signup") == 1)
    return _to_units(trailing_sums(spine, inc1, ["channels"], m, months, bounded_keys=False),
                     ["channels"], True)


def increment_sums(spine: DataFrame, cube: DataFrame, months: int = P.WINDOW_MONTHS) -> DataFrame:
    """Trailing sums per forecast month and increment."""
    k, m = ["increments_from_signup"], ["paid_days", "net_revenue"]
    return _to_units(trailing_sums(spine, cube, k, m, months), k, False)


def total_sums(spine: DataFrame, cube: DataFrame, months: int = P.WINDOW_MONTHS) -> DataFrame:
    """Trailing sums per forecast month over everything (the denominator)."""
    m = ["paid_days", "net_revenue"]
    return _to_units(trailing_sums(spine, cube, [], m, months), [], False)


def _all_rate(total: DataFrame) -> DataFrame:
    return total.select("forecast_month", safe_div("net_revenue_usd", "paid_days").alias("nrpd_all"))


# ``total`` has one row per spine month, so its rate is broadcast.
def channel_rates(channel: DataFrame, total: DataFrame) -> DataFrame:
    """Revenue per paid day per channel and overall; volume = trips."""
    return (channel.join(F.broadcast(_all_rate(total)), "forecast_month", "left")
            .select("forecast_month", "channels", F.col("trips").alias("data_volume"),
                    safe_div("net_revenue_usd", "paid_days").alias("nrpd_channel"), "nrpd_all"))


def increment_rates(increment: DataFrame, total: DataFrame) -> DataFrame:
    """Revenue per paid day per increment and overall."""
    return (increment.join(F.broadcast(_all_rate(total)), "forecast_month", "left")
            .select("forecast_month", "increments_from_signup",
                    safe_div("net_revenue_usd", "paid_days").alias("nrpd_increment"), "nrpd_all"))
