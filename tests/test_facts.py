"""Trip-day expansion traps and the bucket rewrite."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.operators import facts
from cohortcast.plans.queries import pipeline
from conftest import D, SF_SMALL, TS, mk

RES = ("reservation_id long, driver_id long, gaap_net_revenue double, is_ever_booked int, "
       "current_status int, trip_start_ts timestamp_ntz, summary_start_ts timestamp_ntz, "
       "created timestamp_ntz, risk_score double, dim_start_ts timestamp_ntz, paid_days double")
BASE = "driver_id long, signup_date date, signup_month date, channels string"
d0 = TS(2024, 3, 10)


def _res(spark, rows):
    return mk(spark, RES, rows)


def _base(spark, signup=D(2024, 3, 1)):
    return mk(spark, BASE, [(1, signup, signup.replace(day=1), "Apple")])


def _row(rid=1, rev=100.0, booked=1, status=3, trip=None, summary=None, dim=None, paid=4.0):
    return (rid, 1, rev, booked, status, trip, summary, d0, 0.01, dim, paid)


def _signed(res, base):
    return facts.with_signups(res, base)


def _days(spark, rows, signup=D(2024, 3, 1)):
    return facts.trip_day_facts(_signed(_res(spark, rows), _base(spark, signup))).orderBy("trip_date").collect()


def test_q6_cancelled_keeps_revenue(spark):
    rows = _days(spark, [_row(status=2, trip=d0, paid=4.0)])
    assert len(rows) == 4
    assert {r.paid_day for r in rows} == {0} and {r.net_revenue_usd for r in rows} == {25.0}
    assert {r.trip for r in rows} == {0.0}


def test_q7_two_fallbacks(spark):
    rows = _days(spark, [_row(trip=None, dim=d0, summary=d0 + dt.timedelta(days=2), paid=3.0)])
    assert [r.trip_date for r in rows] == [D(2024, 3, 10) + dt.timedelta(days=k) for k in range(5)]
    assert {r.net_revenue_usd for r in rows} == {100.0 / 3}


def test_q7_q8_zero_paid_days(spark):
    rows = _days(spark, [_row(trip=None, dim=d0, summary=d0 + dt.timedelta(days=2), paid=0.0)])
    assert [r.trip_date for r in rows] == [D(2024, 3, 10), D(2024, 3, 11)]
    assert all(r.net_revenue_usd is None and r.trip is None for r in rows)


def test_j4_guard_no_rows_for_empty_range(spark):
    assert _days(spark, [_row(trip=d0, paid=0.0)]) == []


def test_q2_guard_uses_signup_month(spark):
    # sign-up on the 20th; trip days from the 10th survive (same month), bucket 1
    rows = _days(spark, [_row(trip=d0, paid=2.0)], signup=D(2024, 3, 20))
    assert len(rows) == 2 and {r.increments_from_signup for r in rows} == {1}
    # a trip in the previous month is dropped
    assert _days(spark, [_row(trip=TS(2024, 2, 27), paid=2.0)], signup=D(2024, 3, 20)) == []


def test_calendar_clips_days(spark):
    cal = spark.range(3).select(F.date_add(F.lit(D(2024, 3, 11)), F.col("id").cast("int")).alias("date"))
    res = _res(spark, [_row(trip=d0, paid=6.0)])
    days = facts.trip_day_facts(_signed(res, _base(spark)), cal).collect()
    assert sorted(r.trip_date for r in days) == [D(2024, 3, 11), D(2024, 3, 12), D(2024, 3, 13)]
    cube = facts.cohort_cube(_signed(res, _base(spark)), cal).collect()
    assert [r.paid_days for r in cube] == [3]


def _cube_rows(df):
    """Rows without the plain double sums, whose last bits depend on the order."""
    return sorted(tuple(r) for r in df.select(*[c for c in df.columns if not c.endswith("_plain")]).collect())


@pytest.mark.parametrize("signup", [D(2024, 3, 31), D(2024, 1, 31), D(2024, 3, 1), D(2023, 12, 15)])
def test_bucket_cube_equals_day_cube_inline(spark, signup):
    rows = [_row(rid=i, trip=d0 + dt.timedelta(days=7 * i), paid=float(1 + 13 * i % 97),
                 status=i % 13, rev=1000.0 + i) for i in range(40)]
    rows += [_row(rid=100, trip=None, dim=d0, summary=d0 + dt.timedelta(days=2), paid=0.0),
             _row(rid=101, trip=TS(2024, 3, 1), paid=200.0)]
    signed = _signed(_res(spark, rows), _base(spark, signup))
    a = facts.cube_from_days(facts.trip_day_facts(signed))
    b = facts.cohort_cube(signed)
    assert _cube_rows(a) == _cube_rows(b)


def test_bucket_cube_equals_day_cube_fixture(spark):
    p = pipeline(spark, SF_SMALL)
    a = facts.cube_from_days(p.trip_day_facts)
    b = facts.cohort_cube(p.signed_reservations, p.src.calendar, P.FIXTURE)
    assert _cube_rows(a) == _cube_rows(b)


def test_join_orders_agree(spark):
    """signed_reservations (summary ⋈ base first) == with_signups(reservation_join)."""
    p = pipeline(spark, SF_SMALL)
    a = facts.with_signups(p.reservations, p.signup_base)
    b = p.signed_reservations.select(*a.columns)
    assert _cube_rows(a) == _cube_rows(b)


def test_guarded_explode_equals_range_join(spark):
    """J4: explode(sequence) behind the guard == the literal BETWEEN join."""
    p = pipeline(spark, SF_SMALL)
    signed, cal = p.signed_reservations, p.src.calendar
    literal = (signed.join(cal, cal.date.between(F.col("first_day"), F.col("last_day")))
               .where(F.col("signup_month") <= F.col("date")).select("reservation_id", F.col("date").alias("trip_date")))
    for got in (facts.trip_day_facts(signed, cal, P.FIXTURE, p.calendar_span), facts.trip_day_facts(signed, cal, P.FIXTURE)):
        assert _cube_rows(literal) == _cube_rows(got.select("reservation_id", "trip_date"))


@pytest.mark.parametrize("calendar", ["none", "span", "scalar"])
def test_null_bounds_give_no_rows(spark, calendar):
    """BETWEEN with a NULL bound holds for no day: in every calendar mode, in
    the day form and in both cubes."""
    rows = [_row(rid=1, trip=d0, paid=3.0), _row(rid=2, trip=d0, paid=None),
            _row(rid=3, trip=None, dim=None, summary=d0, paid=3.0), _row(rid=4, trip=None, dim=d0, summary=None, paid=3.0),
            _row(rid=5, trip=d0, paid=3.0, status=None), _row(rid=6, trip=None, dim=None, summary=None, paid=None)]
    signed = _signed(_res(spark, rows), _base(spark))
    signed = signed.unionByName(signed.where("reservation_id = 1").withColumn("reservation_id", F.lit(7).cast("long"))
                                .withColumn("signup_month", F.lit(None).cast("date")))
    cal = spark.range(366).select(F.date_add(F.lit(D(2024, 1, 1)), F.col("id").cast("int")).alias("date"))
    args = {"none": (), "span": (cal, P.FIXTURE, (D(2024, 1, 1), D(2024, 12, 31))), "scalar": (cal,)}[calendar]
    days = facts.trip_day_facts(signed, *args)
    assert {(r.reservation_id, r["count"]) for r in days.groupBy("reservation_id").count().collect()} == {(1, 3), (5, 3)}
    for cube in (facts.cube_from_days(days), facts.cohort_cube(signed, *args)):
        r = cube.agg(F.sum("paid_days").alias("d"), F.sum("net_revenue_exact").cast("double").alias("v")).first()
        assert (r.d, r.v) == (3, pytest.approx(200.0))  # a NULL status is unpaid but keeps its revenue


def test_fixture_traps_occur(spark):
    """The stand-in data exercises the quirks the tests rely on."""
    days = pipeline(spark, SF_SMALL).trip_day_facts
    agg = days.agg(F.sum((F.col("increments_from_signup") == 0).cast("int")).alias("inc0"),
                   F.sum((F.col("paid_day") == 0).cast("int")).alias("unpaid"),
                   F.sum((F.col("trip_date") < F.col("signup_month")).cast("int")).alias("before")).first()
    assert agg.inc0 >= 1 and agg.unpaid > 0 and agg.before == 0
