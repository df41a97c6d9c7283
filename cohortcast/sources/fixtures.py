"""Stand-ins for the pipeline's warehouse inputs, derived from the driver's
TPC-H-like parquet tables (definitions in FIXTURES.md, part B).

Everything here is a Spark transformation of the given tables, so the
stand-ins grow with the scale factor.  Dimension tables of fixed size
(nation, region) are broadcast; everything else is left to the planner.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.sources.tables import Sources

# Fixed values of the stand-in ledger: snapshot names and their edit dates.
# The draft is not in the fixture allow-list and must be filtered out.
FIXTURE_SNAPSHOTS = (
    ("Feb-96 BOD Forecast (1+11)", dt.date(1996, 2, 12)),
    ("May-96 Forecast (4+8)", dt.date(1996, 5, 9)),
    ("Sep-96 Forecast (8+4)", dt.date(1996, 9, 10)),
    ("Feb-97 BOD Forecast (1+11)", dt.date(1997, 2, 11)),
    ("Oct-96 Draft (9+3)", dt.date(1996, 10, 8)),
    # Its forecast starts before the spine: no index, so no channel.
    ("Mar-95 BOD Forecast (2+10)", dt.date(1995, 3, 10)),
)
# Segments of customers outside the US that play the regrouped labels.
OVERSEAS_LABELS = (("AUTOMOBILE", "Google_Desktop"), ("BUILDING", "Google_Mobile_Brand"))
CALENDAR_START = dt.date(1995, 1, 1)
CALENDAR_END = dt.date(2001, 12, 31)
# Days that the calendar with gaps holds: no Sundays, and not the April of 1997.
GAP_SQL = "dayofweek(date) <> {sunday} AND NOT date BETWEEN DATE '1997-04-01' AND DATE '1997-04-30'"
LEDGER_HORIZON_MONTHS = 24
LEGACY_FACTOR = 0.9


#: Columns of the driver's tables that the stand-ins use, as they are stored.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
}


class Tables:
    """The driver's tables of one folder, each opened once and on first use.

    The schemas are declared, so that opening a table reads no footer."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.folder = spark, sf_dir.rstrip("/")

    def _open(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self._open("orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self._open("customer")

    @cached_property
    def locations(self) -> DataFrame:
        return location_dim(self._open("nation"), self._open("region"))

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.customer, self.locations)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar(self.spark)


def _key(n: int) -> Column:
    return F.col("o_orderkey") % n


def _order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def location_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """nation ⋈ region; AFRICA plays 'AU', everything else 'US' (25 rows)."""
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("long").alias("location_key"),
                    F.when(F.col("r_name") == "AFRICA", "AU").otherwise("US").alias("country_code")))


def customers(customer: DataFrame, locations: DataFrame) -> DataFrame:
    """customer with its country (c_custkey, c_nationkey, c_mktsegment, country)."""
    return (customer.join(F.broadcast(locations), customer.c_nationkey == locations.location_key)
            .select("c_custkey", "c_nationkey", "c_mktsegment", F.col("country_code").alias("country")))


def attribution(t: Tables) -> DataFrame:
    first = (t.orders.groupBy("o_custkey")
             .agg(F.min("o_orderdate").cast("date").alias("d")))
    cust = t.customers
    k = F.col("c_custkey")
    signup = (F.when(k % 11 == 0, F.last_day("d"))
              .otherwise(F.date_add("d", (k % 31).cast("int"))))
    label = F.col("c_mktsegment")
    for segment, name in OVERSEAS_LABELS:
        label = F.when((F.col("country") == "AU") & (F.col("c_mktsegment") == segment), F.lit(name)).otherwise(label)
    label = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(P.UNKNOWN_CHANNEL)).otherwise(label)
    return (cust.join(first, cust.c_custkey == first.o_custkey)
            .select(k.alias("driver_id"), signup.alias("signup_date"),
                    F.col("country"), label.alias("channel_lvl_5"),
                    F.lit("web").alias("platform"))
            .withColumn("signup_month", F.trunc("signup_date", "MM")))


def _channel_key(c: str = "o_orderpriority") -> Column:
    return F.substring(F.col(c), 1, 1).cast("long")


def session_fact(t: Tables) -> DataFrame:
    o, cust = t.orders, t.customers
    return (o.join(cust, o.o_custkey == cust.c_custkey)
            .select(F.col("o_orderkey").alias("session_key"),
                    _order_day().alias("session_date_pdt"),
                    F.col("c_nationkey").cast("long").alias("source_location_key"),
                    _channel_key().alias("channel_key"),
                    F.lit("app").alias("platform")))


def channel_dim(t: Tables) -> DataFrame:
    return (t.orders.select("o_orderpriority").distinct()
            .select(_channel_key().alias("channel_key"), F.col("o_orderpriority").alias("channel_name")))


def conversion_mart(t: Tables) -> DataFrame:
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select(
        F.col("o_orderkey").alias("session_key"),
        F.col("o_custkey").alias("driver_key"),
        F.row_number().over(w).alias("rank_desc_paid_90_days"))


def driver_dim(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("driver_key"), F.col("c_custkey").alias("driver_id"))


def calendar(spark: SparkSession, start: dt.date = CALENDAR_START,
             end: dt.date = CALENDAR_END) -> DataFrame:
    """One row per day; the same table plays both date dimensions."""
    n = (end - start).days + 1
    return spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def gapped_calendar(spark: SparkSession) -> DataFrame:
    return calendar(spark).where(GAP_SQL.format(sunday=1))


def res_profit(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("reservation_id"), F.col("o_totalprice").alias("gaap_net_revenue"))


def res_summary(t: Tables) -> DataFrame:
    month_start = F.trunc(_order_day(), "MM").cast("timestamp_ntz")
    trip_start = (F.when(_key(7) == 0, F.lit(None).cast("timestamp_ntz"))
                  .when(_key(5) == 0, month_start)
                  .otherwise(F.col("o_orderdate")))
    return t.orders.select(
        F.col("o_orderkey").alias("reservation_id"),
        F.col("o_custkey").alias("driver_id"),
        (F.col("o_orderstatus") != "P").cast("int").alias("is_ever_booked"),
        F.when(_key(110) != 23, _key(13)).cast("int").alias("current_status"),
        trip_start.alias("trip_start_ts"),
        F.when(_key(21) != 0, F.timestamp_add("DAY", 1 + _key(3), F.col("o_orderdate"))).alias("current_start_ts"))


def res_dim(t: Tables) -> DataFrame:
    risk_score = F.when(_key(50) == 0, F.lit(None)).otherwise(_key(2000).cast("double") / 10000.0)
    paid = F.when(_key(70) == 10, F.lit(0)).when(_key(90) != 17, 1 + _key(9))
    return t.orders.select(
        F.col("o_orderkey").alias("reservation_id"),
        F.col("o_orderdate").alias("created"),
        risk_score.cast("double").alias("risk_score"),
        F.when(_key(35) != 0, F.timestamp_add("DAY", F.lit(1), F.col("o_orderdate"))).alias("current_start_ts"),
        paid.cast("double").alias("paid_days"))


def ledger(t: Tables) -> DataFrame:
    """Long-format budget ledger: every order, for each snapshot whose two-year
    window holds it, as one revenue row and one trip-days row.

    The fan-out is a bounded ``explode`` (6 snapshots x 2 metrics), not a join.
    """
    o = t.orders
    cust = t.customers.select("c_custkey", "country")
    snaps = F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(d).alias("m"))
                      for s, d in FIXTURE_SNAPSHOTS])
    metrics = F.array(F.lit(P.NET_REVENUE_METRIC), F.lit(P.TRIP_DAYS_METRIC))
    year0 = F.trunc(F.col("snap.m"), "year")
    day = _order_day()
    category = (F.when(_key(40) == 3, F.lit(None).cast("string"))
                .when(F.col("o_orderpriority") == "5-LOW", F.lit(P.EXCLUDED_REVENUE_CATEGORY))
                .otherwise(F.col("o_orderpriority")))
    return (o.join(cust, o.o_custkey == cust.c_custkey)
            .select("*", F.explode(snaps).alias("snap"))
            .where((day >= year0) & (day < F.add_months(year0, LEDGER_HORIZON_MONTHS)))
            .select("*", F.explode(metrics).alias("metric"))
            .select(F.col("snap.scenario").alias("scenario"),
                    F.date_format("o_orderdate", "MMM-yyyy").alias("month"),
                    "country", "metric",
                    category.alias("revenue_category"),
                    F.when(F.col("metric") == P.TRIP_DAYS_METRIC, (1 + _key(9)).cast("double"))
                    .otherwise(F.col("o_totalprice")).alias("value"),
                    F.date_sub(F.col("snap.m"), _key(5).cast("int")).cast("timestamp_ntz")
                    .alias("modified_at")))


def legacy_forecast(actuals: DataFrame) -> DataFrame:
    """The older forecast table, stood in by 0.9 x actual rates at 1..12."""
    inc = F.col("increments_from_signup")
    return (actuals.where((inc >= 1) & (inc <= P.MAX_INCREMENT))
            .select("channels",
                    F.add_months("month", (1 - inc).cast("int")).alias("signup_month"),
                    inc.alias("increments_from_signup"),
                    (F.col("nrpd") * LEGACY_FACTOR).alias("net_revenue_per_paid_day")))


#: Day up to which the stand-in's earlier state knew reservations.
EARLIER_DAY = dt.date(1997, 9, 1)


def earlier_sources(src: Sources) -> tuple[Sources, DataFrame]:
    """The inputs as an earlier run saw them, and the reservations that have
    changed since: later and late ones were not there, some had one paid day
    less, some (negative ids) have gone; some drivers had another channel."""
    known = (F.col("created") < F.lit(EARLIER_DAY)) & (F.col("reservation_id") % 19 != 0)
    ids = src.res_dim.where(known).select("reservation_id")
    was = F.when(F.col("reservation_id") % 17 == 0, F.col("paid_days") - 1).otherwise(F.col("paid_days"))

    def then(df: DataFrame) -> DataFrame:
        old = df.join(ids, "reservation_id", "left_semi")
        gone = old.where(F.col("reservation_id") % 29 == 0).withColumn("reservation_id", -F.col("reservation_id"))
        return old.unionByName(gone)
    label = F.when(F.col("driver_id") % 23 == 0, F.lit("Google_Desktop")).otherwise(F.col("channel_lvl_5"))
    earlier = replace(src, res_profit=then(src.res_profit), res_summary=then(src.res_summary),
                      res_dim=then(src.res_dim).withColumn("paid_days", was),
                      attribution=src.attribution.withColumn("channel_lvl_5", label))
    fresh = src.res_dim.where(~known | (F.col("reservation_id") % 17 == 0)).select("reservation_id")
    gone = earlier.res_dim.where((F.col("reservation_id") < 0) | (F.col("reservation_id") % 17 == 0)).select("reservation_id")
    return earlier, fresh.unionByName(gone)


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """All stand-ins for ``sf_dir``: each is made when it is first used."""
    t = Tables(spark, sf_dir)
    return Sources(
        calendar_span=(CALENDAR_START, CALENDAR_END),
        attribution=lambda: attribution(t),
        session_fact=lambda: session_fact(t),
        date_dim=lambda: t.calendar,
        location_dim=lambda: t.locations,
        channel_dim=lambda: channel_dim(t),
        conversion_mart=lambda: conversion_mart(t),
        driver_dim=lambda: driver_dim(t),
        res_profit=lambda: res_profit(t),
        res_summary=lambda: res_summary(t),
        res_dim=lambda: res_dim(t),
        calendar=lambda: t.calendar,
        ledger=lambda: ledger(t),
    )
