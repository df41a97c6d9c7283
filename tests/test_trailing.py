"""Trailing-window rewrite, spine semantics and the index identities."""

from pyspark.sql import functions as F

from cohortcast.operators import index, trailing
from cohortcast.operators.facts import cube_from_days
from cohortcast.plans.queries import pipeline
from conftest import CUBE_SUMS, cube_sum, D, SF_SMALL, mk


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_j5_fanout_equals_theta_join(spark):
    p = pipeline(spark, SF_SMALL)
    spine, days = p.spine, p.trip_day_facts
    theta = (spine.alias("a").join(
        days.alias("b"),
        (F.col("b.trip_month") < F.col("a.forecast_month"))
        & (F.col("b.trip_month") >= F.add_months(F.col("a.forecast_month"), -12)), "left")
        .groupBy("a.forecast_month", "b.increments_from_signup")
        .agg(F.sum("b.paid_day").alias("paid_days")))
    fan = trailing.increment_sums(spine, cube_from_days(days)).select(
        "forecast_month", "increments_from_signup", "paid_days")
    assert _sorted(theta) == _sorted(fan)


def test_q11_empty_spine_month_keeps_one_null_row(spark):
    spine = mk(spark, "forecast_month date", [(D(2024, 1, 1),), (D(2030, 1, 1),)])
    cube = mk(spark, "channels string, trip_month date, increments_from_signup long, paid_days long, "
                     + CUBE_SUMS,
              [("A", D(2023, 6, 1), 1, 10, *cube_sum(1.0), *cube_sum(0.5)),
               ("A", D(2022, 12, 1), 1, 5, *cube_sum(1.0), *cube_sum(0.0)),   # 13 months back: outside
               ("B", D(2023, 12, 1), 1, 0, *cube_sum(3.0), *cube_sum(0.0))])
    rows = {(r.forecast_month, r.channels): r for r in trailing.channel_sums(spine, cube).collect()}
    assert rows[(D(2024, 1, 1), "A")].paid_days == 10
    assert rows[(D(2024, 1, 1), "A")].net_revenue_usd == 1.0
    assert rows[(D(2030, 1, 1), None)].paid_days is None
    rates = {r.channels: r for r in trailing.channel_rates(
        trailing.channel_sums(spine, cube), trailing.total_sums(spine, cube)).collect()}
    assert rates["B"].nrpd_channel is None                    # Q9: zero paid days -> NULL
    assert rates["A"].nrpd_all == 4.0 / 10


def _rates(spark, values):
    return mk(spark, "forecast_month date, increments_from_signup long, nrpd_increment double, "
                     "nrpd_all double", [(D(2024, 1, 1), i, v, 1.0) for i, v in values])


def test_q4_ratio_base_first_and_fixed(spark):
    r = _rates(spark, [(0, 2.0), (1, 4.0), (2, 8.0), (13, 1.0)])
    first = index.increment_ratio(r).orderBy("increments_from_signup").collect()
    assert [x.ratio_increment_index for x in first] == [1.0, 2.0, 4.0]   # 13 is past the horizon
    one = index.increment_ratio(r, base=1).orderBy("increments_from_signup").collect()
    assert [x.ratio_increment_index for x in one] == [0.5, 1.0, 2.0]


def test_q4_null_base_skipped(spark):
    r = _rates(spark, [(0, None), (1, 4.0), (2, 8.0)])
    got = index.increment_ratio(r).orderBy("increments_from_signup").collect()
    assert [x.ratio_increment_index for x in got] == [None, 1.0, 2.0]


def test_ratio_identity_on_fixture(spark):
    """ratio = nrpd_x / nrpd_base: nrpd_all cancels."""
    p = pipeline(spark, SF_SMALL)
    rows = p.increment_ratio.where(F.col("ratio_increment_index").isNotNull()).collect()
    assert rows
    for r in rows:
        base = r.increment_index_1 * r.nrpd_all
        assert abs(r.ratio_increment_index - r.nrpd_increment / base) < 1e-9 * max(1.0, r.ratio_increment_index)


def test_q10_forecast_month_missing_from_index(spark):
    fc = mk(spark, "scenario string, forecast_month date, month date, increments_from_signup long, nrpd double",
            [("s", D(1996, 5, 1), D(1996, 6, 1), 2, 10.0)])
    ix = mk(spark, "forecast_month date, increments_from_signup long, channels string, final_index double, "
                   "data_volume double", [(D(1996, 4, 1), 2, "A", 1.5, 1.0)])
    rows = index.final_forecast(fc, ix).collect()
    assert len(rows) == 1 and rows[0].channels is None and rows[0].forecast_nrpd_by_incre_channel is None


def test_signup_base_one_row_per_driver(spark):
    base = pipeline(spark, SF_SMALL).signup_base
    assert base.count() == base.select("driver_id").distinct().count() == 96


def test_ratio_is_one_at_the_base_increment(spark):
    from pyspark.sql import Window as W
    p = pipeline(spark, SF_SMALL)
    r = p.increment_ratio.where(F.col("increment_index").isNotNull())
    first = (r.withColumn("_rn", F.row_number().over(
        W.partitionBy("forecast_month").orderBy("increments_from_signup"))).where(F.col("_rn") == 1))
    ratios = [row.ratio_increment_index for row in first.collect()]
    assert ratios and all(x == 1.0 for x in ratios)
