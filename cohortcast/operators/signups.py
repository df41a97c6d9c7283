"""Sign-up base: one row per driver from two attribution sources.

Grain and shuffles: the star join broadcasts the calendar (one row per day);
location and channel have no known bound, so the planner decides from their
size; the rest shuffles on ``session_key`` and ``driver_key``.  The priority merge shuffles once on ``driver_id``, after a
map-side top-1 per driver, so a driver holding many rows cannot skew a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.conditional import regroup_channel
from cohortcast.functions.dates import month_start

BASE_COLUMNS = ["driver_id", "signup_date", "signup_month", "channels", "platform", "country"]


def signup_attribution(attribution: DataFrame, params: P.Params = P.PRODUCTION,
                       countries: tuple[str, ...] | None = None) -> DataFrame:
    """Marketing attribution sign-ups of the run's country (or of several),
    'Unknown' dropped, channels regrouped, tagged with the attribution priority."""
    return (attribution
            .where(F.col("country").isin(*(countries or (params.country,)))
                   & (F.col("channel_lvl_5") != P.UNKNOWN_CHANNEL))
            .select("driver_id", "signup_date", "signup_month",
                    regroup_channel().alias("channels"), "platform", "country",
                    F.lit(P.ATTRIBUTION_PICK_RANK).alias("pick_rank")))


def star_signup(session_fact: DataFrame, date_dim: DataFrame, location_dim: DataFrame,
                channel_dim: DataFrame, conversion_mart: DataFrame, driver_dim: DataFrame) -> DataFrame:
    """Warehouse sign-ups: sessions joined to their best paid conversion."""
    best = conversion_mart.where(F.col("rank_desc_paid_90_days") == 1)
    sf = session_fact.alias("sf")
    return (sf
            .join(F.broadcast(date_dim.alias("dd")), F.col("sf.session_date_pdt") == F.col("dd.date"))
            .join(location_dim.alias("ld"), F.col("sf.source_location_key") == F.col("ld.location_key"))
            .join(channel_dim.alias("cd"), F.col("sf.channel_key") == F.col("cd.channel_key"))
            .join(best.alias("cv"), F.col("sf.session_key") == F.col("cv.session_key"))
            .join(driver_dim.alias("dr"), F.col("cv.driver_key") == F.col("dr.driver_key"))
            .select(F.col("dr.driver_id").alias("driver_id"),
                    F.col("dd.date").alias("signup_date"),
                    month_start(F.col("dd.date")).alias("signup_month"),
                    F.col("cd.channel_name").alias("channels"),
                    F.col("sf.platform").alias("platform"),
                    F.col("ld.country_code").alias("country")))


def override_signups(star: DataFrame, params: P.Params = P.PRODUCTION) -> DataFrame:
    """Warehouse sign-ups that override attribution (one country, one channel)."""
    return (star.where((F.col("country") == params.country)
                       & (F.col("channels") == params.override_channel))
            .select(*BASE_COLUMNS, F.lit(P.OVERRIDE_PICK_RANK).alias("pick_rank")))


def signup_union(attribution_rows: DataFrame, override_rows: DataFrame) -> DataFrame:
    """Both sources stacked, duplicates kept (UNION ALL, by column name)."""
    cols = BASE_COLUMNS + ["pick_rank"]
    return attribution_rows.select(*cols).unionByName(override_rows.select(*cols))


def signup_base(rows: DataFrame) -> DataFrame:
    """Keep one row per driver: the lowest ``pick_rank`` wins; ties go to the
    earliest sign-up date, then channel, platform, country (deterministic)."""
    w = W.partitionBy("driver_id").orderBy(
        "pick_rank", "signup_date", "channels", "platform", "country")
    return (rows.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .drop("_rn"))



#: What decides between a driver's rows, in order.
_ORDER = ["pick_rank", "signup_date", "channels", "platform", "country"]


def ranked_base(rows: DataFrame) -> DataFrame:
    """:func:`signup_base` as an aggregate: the least struct of a driver's
    rows.  A minimum of minima is the minimum, so bases of parts of the rows
    can be merged (:func:`merge_bases`); a window has to see all rows again."""
    least = F.min(F.struct(*_ORDER, "signup_month"))
    return rows.groupBy("driver_id").agg(least.alias("_least")).select("driver_id", *[F.col(f"_least.{c}") for c in _BASE_AND_RANK[1:]])


_BASE_AND_RANK = BASE_COLUMNS + ["pick_rank"]


def merge_bases(*bases: DataFrame) -> DataFrame:
    """The base of all rows that the given bases were made of: one row per
    driver and base is shuffled, not the rows behind them."""
    first, *others = [b.select(*_BASE_AND_RANK) for b in bases]
    for other in others:
        first = first.unionByName(other)
    return ranked_base(first)
