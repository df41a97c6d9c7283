"""Reservations spread over their paid days, by cohort age bucket.

Two physical forms of the same facts:

* :func:`trip_day_facts` -- one row per reservation and paid day
  (``explode(sequence(lo, hi))`` behind a ``lo <= hi`` guard; a literal
  BETWEEN join to a calendar would plan as a nested-loop join).
* :func:`cohort_cube` -- the same facts already summed per
  (channel, cohort month, increment), revenue and trips as exact decimal sums.  It explodes each reservation into the
  age buckets it touches (at most ``days / 30 + 2`` rows instead of one row per
  day) and weighs each row by its number of days, then aggregates with a
  map-side partial sum.  Every trailing sum and the actuals are re-aggregations
  of this small table, so the large inputs are scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.conditional import paid_day_flag, safe_div
from cohortcast.functions.dates import cohort_month, increment_bucket
from cohortcast.functions.numeric import parts, sum_terms
from cohortcast.operators.joins import split_hot_join

CUBE_KEYS = ["channels", "trip_month", "increments_from_signup"]
# Cube measures: paid days, and the parts of the exact revenue and trip sums.
CUBE_MEASURES = ["paid_days", *parts("net_revenue"), *parts("trips")]


def reservation_join(res_profit: DataFrame, res_summary: DataFrame, res_dim: DataFrame) -> DataFrame:
    """Profit ⋈ summary ⋈ dimensions on ``reservation_id`` (shuffle joins on a
    unique key; AQE picks broadcast when one side turns out small)."""
    rs = res_summary.select("reservation_id", "driver_id", "is_ever_booked", "current_status",
                            "trip_start_ts", F.col("current_start_ts").alias("summary_start_ts"))
    rd = res_dim.select("reservation_id", "created", "risk_score",
                        F.col("current_start_ts").alias("dim_start_ts"), "paid_days")
    return res_profit.join(rs, "reservation_id").join(rd, "reservation_id")


def trip_span(res: DataFrame) -> DataFrame:
    """Add the first and last trip day of each reservation.

    The first day falls back to the dimensions' start, the last day to the
    summary's start plus paid_days - 1: two different fallbacks, kept as is.
    """
    lo = F.coalesce("trip_start_ts", "dim_start_ts").cast("date")
    hi = F.date_add(F.coalesce("trip_start_ts", "summary_start_ts").cast("date"),
                    F.col("paid_days").cast("int") - 1)
    return res.withColumn("first_day", lo).withColumn("last_day", hi)


def _clip_to_calendar(lo: Column, hi: Column, calendar: DataFrame,
                      span=None) -> tuple[Column, Column, Column]:
    """Clip a day range to the calendar's first and last date (and that first date): literals when
    the span is known, else two scalar subqueries (tiny aggregates, no join)."""
    if span is not None:
        first, last = F.lit(span[0]), F.lit(span[1])
    else:
        first, last = calendar.agg(F.min("date")).scalar(), calendar.agg(F.max("date")).scalar()
    return F.greatest(lo, first), F.least(hi, last), first


def _bounded(signed: DataFrame) -> DataFrame:
    """Rows whose span and sign-up month are known.  BETWEEN with a NULL bound
    holds for no day, while greatest() and least() would pass a NULL over."""
    return signed.dropna(subset=["first_day", "last_day", "signup_month"])


def _per_day_measures(params: P.Params) -> list[Column]:
    flag = paid_day_flag(excluded=params.excluded_status)
    return [flag.alias("paid_day"),
            safe_div(flag, "paid_days").alias("trip"),
            safe_div("gaap_net_revenue", "paid_days").alias("net_revenue_usd")]


_BASE_COLS = ["driver_id", "signup_date", "signup_month", "channels"]


def _base_join(left: DataFrame, base: DataFrame, hot: DataFrame | None) -> DataFrame:
    b = base.select(*_BASE_COLS)
    if hot is None:  # a caller without a hot list: the planner's own skew join
        return left.join(b, "driver_id")
    return split_hot_join(left, b, "driver_id", hot, "reservation_id")


def with_signups(res: DataFrame, base: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Joined reservations (:func:`reservation_join`) with their driver's
    sign-up and trip span.  ``hot`` (``joins.hot_keys``) lists drivers with so
    many reservations that they are spread over several tasks."""
    return trip_span(_base_join(res, base, hot))


def signed_reservations(res_profit: DataFrame, res_summary: DataFrame, res_dim: DataFrame,
                        base: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Same rows as ``with_signups(reservation_join(...), base)``, joined in
    the order that is cheaper at scale: the narrow summary meets the sign-up
    base first (the only ``driver_id`` shuffle, and it drops reservations of
    drivers outside the base), then profit and dimensions on reservation_id."""
    rs = res_summary.select("reservation_id", "driver_id", "is_ever_booked", "current_status",
                            "trip_start_ts", F.col("current_start_ts").alias("summary_start_ts"))
    rd = res_dim.select("reservation_id", "created", "risk_score",
                        F.col("current_start_ts").alias("dim_start_ts"), "paid_days")
    signed = _base_join(rs, base, hot)
    return trip_span(signed.join(res_profit, "reservation_id").join(rd, "reservation_id"))


def trip_day_facts(signed: DataFrame, calendar: DataFrame | None = None,
                   params: P.Params = P.PRODUCTION, calendar_span=None) -> DataFrame:
    """One row per reservation and trip day on or after the sign-up month.

    ``signed`` is :func:`signed_reservations` (or :func:`with_signups`).
    A calendar, when given, clips days it does not hold.  ``calendar_span``
    (first, last) says the calendar has no gaps: clipping to it is then
    enough.  Without it the days are also semi-joined to the calendar
    (broadcast: one row per day, bounded by the years it spans).
    """
    j = _bounded(signed)
    lo, hi = F.col("first_day"), F.col("last_day")
    if calendar is not None:
        # Clip to the calendar's span first so no single reservation can
        # expand past it (bounds the array one task materialises).
        lo, hi, _ = _clip_to_calendar(lo, hi, calendar, calendar_span)
    j = j.withColumn("_lo", lo).withColumn("_hi", hi).where(F.col("_lo") <= F.col("_hi"))
    days = j.select("*", F.explode(F.sequence("_lo", "_hi")).alias("trip_date"))
    if calendar is not None and calendar_span is None:
        cal = calendar.select(F.col("date").alias("trip_date"))
        days = days.join(F.broadcast(cal), "trip_date", "left_semi")
    inc = increment_bucket("trip_date", "signup_date", params.increment_days)
    return (days.where(F.col("signup_month") <= F.col("trip_date"))
            .select("reservation_id", "driver_id", "trip_date", "signup_month", "channels",
                    inc.alias("increments_from_signup"), *_per_day_measures(params))
            .withColumn("trip_month", cohort_month("signup_month", "increments_from_signup")))


def cube_from_days(days: DataFrame) -> DataFrame:
    """Sum day-level facts per (channel, cohort month, increment)."""
    return days.groupBy(*CUBE_KEYS).agg(
        F.sum("paid_day").alias("paid_days"),
        *sum_terms("net_revenue_usd", "net_revenue"), *sum_terms("trip", "trips"))


def calendar_ranks(calendar: DataFrame) -> Column:
    """Days of the calendar up to each day of its span, as one array (a scalar
    subquery): its first entry belongs to the day before the span.  One entry a
    day, so one task can sum them and every task hold them."""
    span = calendar.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    every = span.select(F.explode(F.sequence(F.date_sub("first", 1), "last")).alias("day"))
    held = calendar.select(F.col("date").alias("day"), F.lit(1).alias("held"))
    ahead = W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = every.join(held, "day", "left").select("day", F.count("held").over(ahead).alias("rank"))
    in_order = F.sort_array(F.collect_list(F.struct("day", "rank")))
    return ranked.agg(F.transform(in_order, lambda x: x["rank"]).alias("ranks")).scalar()


def bucket_rows(signed: DataFrame, calendar: DataFrame | None = None, params: P.Params = P.PRODUCTION,
                calendar_span=None, gaps: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per reservation and age bucket that it has days in: the cube's
    keys, the number of ``days``, the paid-day ``flag`` and what a day brings
    (``net_revenue``, ``trips``), with the columns ``keep`` of ``signed``.

    With a calendar, days outside its first and last date are clipped (its
    bounds are two scalar subqueries, not a join).  With ``gaps``, a bucket's
    days are those that the calendar holds: the difference of two ranks, so
    gaps cost no row per day.  Otherwise the calendar is taken to have none.
    """
    width = params.increment_days
    j = _bounded(signed)
    lo = F.greatest("first_day", "signup_month")
    hi = F.col("last_day")
    first = None
    if calendar is not None:
        lo, hi, first = _clip_to_calendar(lo, hi, calendar, calendar_span)
    j = j.withColumn("_lo", lo).withColumn("_hi", hi).where(F.col("_lo") <= F.col("_hi"))
    # Day offsets from sign-up; bucket q = offset div width (toward zero).
    j = j.withColumn("_a", F.datediff("_lo", "signup_date")).withColumn("_b", F.datediff("_hi", "signup_date"))
    qa = (F.col("_a") / F.lit(width)).cast("long")
    qb = (F.col("_b") / F.lit(width)).cast("long")
    q = F.col("_q")
    # Offsets covered by bucket q: [-(w-1), w-1] for q = 0, [q*w, q*w + w-1]
    # above it and [q*w - (w-1), q*w] below it.
    q_lo = F.when(q > 0, q * width).otherwise(q * width - (width - 1))
    q_hi = F.when(q < 0, q * width).otherwise(q * width + (width - 1))
    from_day, to_day = F.greatest(F.col("_a"), q_lo), F.least(F.col("_b"), q_hi)
    days = to_day - from_day + 1
    if gaps:
        # the array's first entry is the day before the calendar's first
        ranks, day0 = calendar_ranks(calendar), F.date_sub(first, 2)
        rank = lambda offset: F.element_at(ranks, F.datediff(F.date_add("signup_date", offset.cast("int")), day0))
        days = rank(to_day) - rank(from_day - 1)
    flag = paid_day_flag(excluded=params.excluded_status)
    kept = dict.fromkeys((*keep, "channels", "signup_date", "signup_month", "paid_days", "gaap_net_revenue"))
    rows = (j.select(*kept, flag.alias("flag"), "_a", "_b", F.explode(F.sequence(qa, qb)).alias("_q"))
            .select(*keep, "channels", (q + 1).alias("increments_from_signup"),
                    F.add_months("signup_month", q.cast("int")).alias("trip_month"), days.cast("long").alias("days"), "flag",
                    safe_div("gaap_net_revenue", "paid_days").alias("net_revenue"), safe_div("flag", "paid_days").alias("trips")))
    return rows.where(F.col("days") > 0) if gaps else rows  # a bucket may lie in a gap


def bucket_sums(rows: DataFrame, *more: Column, keys: list[str] = CUBE_KEYS) -> DataFrame:
    """:func:`bucket_rows` summed.  Each day of a bucket carries the same
    values, so a row adds ``days`` times the day's decimal: exactly what that
    many day rows would add."""
    return rows.groupBy(*keys).agg(F.sum(F.col("flag") * F.col("days")).alias("paid_days"),
                                   *sum_terms("net_revenue", "net_revenue", F.col("days")),
                                   *sum_terms("trips", "trips", F.col("days")), *more)


def cohort_cube(signed: DataFrame, calendar: DataFrame | None = None,
                params: P.Params = P.PRODUCTION, calendar_span=None, gaps: bool = False) -> DataFrame:
    """Facts summed per (channels, trip_month, increments_from_signup).

    Equal to ``cube_from_days(trip_day_facts(...))`` but explodes to age
    buckets instead of days (:func:`bucket_rows`).
    """
    return bucket_sums(bucket_rows(signed, calendar, params, calendar_span, gaps))


def booked_day_flags(res: DataFrame, params: P.Params = P.PRODUCTION) -> DataFrame:
    """Per reservation: paid-day flag and the per-day revenue and trip share."""
    return res.select("reservation_id", "is_ever_booked", "current_status", "paid_days",
                      *_per_day_measures(params))


def increment_buckets(signed: DataFrame, params: P.Params = P.PRODUCTION) -> DataFrame:
    """Age bucket and cohort month of each reservation's first trip day."""
    j = signed
    inc = increment_bucket("first_day", "signup_date", params.increment_days)
    return j.select("reservation_id", "driver_id", "signup_date", "signup_month", "first_day",
                    F.datediff("first_day", "signup_date").cast("long").alias("day_diff"),
                    inc.alias("increments_from_signup"),
                    cohort_month("signup_month", inc).alias("trip_month"))
