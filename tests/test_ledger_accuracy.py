"""Ledger snapshots and the back-test traps (Q12, Q13, Q15, Q16)."""

from cohortcast import params as P
from cohortcast.operators import accuracy as acc
from cohortcast.operators import ledger
from conftest import CUBE_SUMS, cube_sum, D, TS, mk

LEDGER = ("scenario string, month string, country string, metric string, revenue_category string, "
          "value double, modified_at timestamp_ntz")
SC = "Sep-96 Forecast (8+4)"
PR = P.FIXTURE


def test_q12_q13_ledger(spark):
    rows = [(SC, "Oct-1996", "US", P.NET_REVENUE_METRIC, "1-URGENT", 100.0, TS(1996, 9, 1)),
            (SC, "Oct-1996", "US", P.NET_REVENUE_METRIC, None, 5.0, TS(1996, 9, 1)),          # Q12
            (SC, "Oct-1996", "US", P.NET_REVENUE_METRIC, P.EXCLUDED_REVENUE_CATEGORY, 7.0, TS(1996, 9, 1)),
            (SC, "Oct-1996", "US", P.TRIP_DAYS_METRIC, None, 4.0, TS(1996, 9, 1)),
            (SC, "Oct-1996", "AU", P.TRIP_DAYS_METRIC, None, 4.0, TS(1997, 1, 3)),           # Q13
            ("Oct-96 Draft (9+3)", "Oct-1996", "US", P.TRIP_DAYS_METRIC, None, 4.0, TS(1996, 9, 1))]
    out = ledger.ledger_snapshots(mk(spark, LEDGER, rows), PR).collect()
    assert len(out) == 1
    r = out[0]
    assert r.net_revenue == 100.0 and r.trip_days == 4.0 and r.nrpd == 25.0
    assert r.last_modified_at == TS(1997, 1, 3)
    assert r.last_actual_month == D(1997, 8, 1)        # Q14: year from the edit time
    assert r.month == D(1996, 10, 1)


def test_forecast_only_numbering(spark):
    snaps = mk(spark, "scenario string, last_actual_month date, month date, nrpd double",
               [("s", D(2024, 4, 1), m, 1.0) for m in (D(2024, 3, 1), D(2024, 4, 1), D(2024, 5, 1),
                                                       D(2025, 1, 1))])
    rows = ledger.forecast_only(snaps).orderBy("month").collect()
    assert [(r.forecast_month, r.increments_from_signup) for r in rows] == [
        (D(2024, 5, 1), 1), (D(2024, 5, 1), 9)]


ACC = ("scenario string, forecast_month date, channels string, month date, data_volume_actual double, "
       "paid_days long, rate_new double, rate_old double, rate_actual double")


def test_q15_weighted_nulls_and_zeros(spark):
    k = ("s", D(2024, 1, 1))
    rows = [(*k, "A", D(2024, 1, 1), 2.0, 3, 10.0, None, 4.0),
            (*k, "A", D(2024, 2, 1), 1.0, 1, 20.0, None, None),
            (*k, "B", D(2024, 1, 1), None, None, 5.0, 5.0, 5.0),   # no paid days: weight NULL
            (*k, "C", D(2024, 1, 1), 0.0, 2, 0.0, 1.0, -1.0),
            (*k, "C", D(2024, 2, 1), 0.0, 2, 0.0, -1.0, 1.0)]
    out = {r.channels: r for r in acc.weighted_accuracy(mk(spark, ACC, rows)).collect()}
    a = out["A"]
    assert a.w_rate_new == 10.0 * 0.75 + 20.0 * 0.25
    assert a.w_rate_old is None and a.w_rate_actual == 3.0 and a.data_volume_actual == 3.0
    b = out["B"]
    assert b.w_rate_new is None and b.data_volume_actual == 0.0
    c = out["C"]   # true zeros become NULL
    assert c.w_rate_new is None and c.w_rate_old is None and c.w_rate_actual is None


def test_weights_sum_to_one(spark):
    k = ("s", D(2024, 1, 1), "A")
    rows = [(*k, D(2024, m, 1), 1.0, m, 1.0, 1.0, 1.0) for m in range(1, 6)]
    w = acc.paid_days_weight(mk(spark, ACC, rows)).collect()
    assert abs(sum(r.paid_days_weight for r in w) - 1.0) < 1e-12


def test_q16_null_channel_matches(spark):
    v2 = mk(spark, "scenario string, forecast_month date, month date, increments_from_signup long, "
                   "channels string, forecast_nrpd_by_incre_channel double",
            [("s", D(2024, 1, 1), D(2024, 1, 1), 1, None, 9.0)])
    v1 = mk(spark, "channels string, signup_month date, increments_from_signup long, "
                   "net_revenue_per_paid_day double", [(None, D(2024, 1, 1), 1, 7.0)])
    act = mk(spark, "channels string, month date, increments_from_signup long, paid_days long, "
                    "data_volume double, nrpd double", [(None, D(2024, 1, 1), 1, 2, 1.0, 8.0)])
    r = acc.accuracy_join(v2, v1, act).collect()
    assert len(r) == 1 and r[0].rate_old == 7.0 and r[0].rate_actual == 8.0


def test_maturity_cutoff(spark):
    cube = mk(spark, "channels string, trip_month date, increments_from_signup long, paid_days long, "
                     + CUBE_SUMS,
              [("A", D(2001, 8, 1), 1, 2, *cube_sum(3.0), *cube_sum(1.0)),
               ("A", D(2001, 9, 1), 1, 2, *cube_sum(3.0), *cube_sum(1.0))])
    rows = acc.actuals(cube, D(2001, 10, 17)).collect()
    assert [r.month for r in rows] == [D(2001, 8, 1)] and rows[0].nrpd == 1.5


def test_actuals_from_days_equals_cube_path(spark):
    from cohortcast.operators.facts import cube_from_days
    from cohortcast.plans.queries import pipeline
    from conftest import SF_SMALL
    p = pipeline(spark, SF_SMALL)
    a = sorted(map(tuple, acc.actuals(cube_from_days(p.trip_day_facts), PR.as_of).collect()), key=str)
    b = sorted(map(tuple, p.actuals.collect()), key=str)
    assert a == b and len(a) == 808
