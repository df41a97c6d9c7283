"""Coverage assertions: the stand-in data exercises every trap (FIXTURES.md part C,
sf0.001 column).  These are counts of situations, not golden values."""

import pytest
from pyspark.sql import functions as F

from cohortcast.plans.queries import pipeline
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def p(spark):
    return pipeline(spark, SF_SMALL)


def _n(df, cond=None):
    return (df.where(cond) if cond is not None else df).count()


def test_signups(p):
    assert _n(p.signup_base) == 96
    assert _n(p.signup_base, F.col("pick_rank") == 1) == 23
    assert _n(p.star_signups) == 150
    us_override = (F.col("country") == "US") & (F.col("channels") == "1-URGENT")
    assert _n(p.star_signups, us_override) == 23


def test_trip_days(p):
    days = p.trip_day_facts.join(p.signup_base.select("driver_id", "signup_date"), "driver_id")
    assert _n(days) == 4275
    assert _n(days, F.col("trip_date") < F.col("signup_date")) == 152       # negative day difference
    assert _n(days, F.col("increments_from_signup") == 0) == 1              # Q3
    assert _n(days, F.col("paid_day") == 0) == 1911


def test_day_count_vs_paid_days(p):
    per_res = p.trip_day_facts.groupBy("reservation_id").agg(F.count("*").alias("n"))
    paid = p.src.res_dim.select("reservation_id", "paid_days")
    j = per_res.join(paid, "reservation_id")
    assert _n(j) == 851
    assert _n(j, F.col("n") != F.col("paid_days")) == 71                    # Q7 / Q2
    assert _n(j, F.col("n") > F.col("paid_days")) == 66


def test_trailing(p):
    assert _n(p.spine) == 10
    assert _n(p.channel_sums) == 44
    assert _n(p.channel_sums, F.col("channels").isNull()) == 0
    assert _n(p.channel_sums, F.col("paid_days") == 0) == 4                 # Q9
    assert _n(p.increment_sums) == 195
    assert _n(p.increment_sums, F.col("increments_from_signup") == 0) == 8  # Q4 base case


def test_index_and_forecast(p):
    assert _n(p.index_table) == 563
    assert _n(p.index_table, F.col("final_index").isNotNull()) == 480
    ff = p.final_forecast
    assert _n(ff) == 180
    assert _n(ff, F.col("channels").isNotNull()) == 156                     # Q10: 1996-05 not in spine
    assert _n(ff, F.col("forecast_nrpd_by_incre_channel").isNotNull()) == 144
    assert _n(p.ledger_snapshots) == 120


def test_back_test(p):
    assert _n(p.actuals) == 808
    assert _n(p.legacy) == 170
    acc = p.accuracy
    assert _n(acc) == 180
    assert _n(acc, F.col("paid_days").isNotNull()) == 6
    assert _n(acc, F.col("rate_actual").isNotNull()) == 4
    pay = p.payback
    assert _n(pay) == 96
    assert _n(pay, F.col("rate_old").isNotNull()) == 2
    assert _n(pay, F.col("paid_days").isNotNull()) == 2
    w = p.weighted_accuracy
    assert _n(w) == 8
    all_three = (F.col("w_rate_new").isNotNull() & F.col("w_rate_old").isNotNull()
                 & F.col("w_rate_actual").isNotNull())
    assert _n(w, all_three) == 2
    assert _n(w, F.col("data_volume_actual") == 0) == 6


def test_risk_bands_both_regimes(spark):
    p = pipeline(spark, "/root/testdata/sf0.01")
    from cohortcast.functions.conditional import risk_band
    cut = F.lit(p.params.risk_cutover.isoformat(sep=" ")).cast("timestamp_ntz")
    bands = (p.src.res_dim.select((F.col("created") < cut).alias("before"),
                                  risk_band(cutover=p.params.risk_cutover).alias("b"))
             .groupBy("before").agg(F.countDistinct("b").alias("n")).collect())
    assert sorted(r.n for r in bands) == [9, 9]
