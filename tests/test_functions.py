"""Trap tests for single expressions."""

import datetime as dt
import math

import pytest

from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.columns import cast_by_name
from cohortcast.functions.conditional import paid_day_flag, regroup_channel, risk_band, safe_div
from cohortcast.functions.dates import (cohort_month, increment_bucket, months_between_inclusive,
                                        parse_month, scenario_actual_month, signup_month_of)
from cohortcast.functions.numeric import exact_sum, sum_parts, sum_terms, value
from conftest import D, TS, mk


def test_q1_truncating_bucket(spark):
    # day difference -1, -29, 0, 29, 30 -> 1, 1, 1, 1, 2 (truncation, not floor)
    s = D(2024, 3, 15)
    days = [s + dt.timedelta(days=k) for k in (-1, -29, 0, 29, 30, -30, -59, -60)]
    df = mk(spark, "d date, s date", [(d, s) for d in days])
    got = [r[0] for r in df.select(increment_bucket("d", "s")).collect()]
    assert got == [1, 1, 1, 1, 2, 0, 0, -1]


def test_q3_increment_zero_month(spark):
    df = mk(spark, "d date, s date, m date", [(D(2024, 1, 1), D(2024, 1, 31), D(2024, 1, 1))])
    r = df.select(increment_bucket("d", "s").alias("i")).select(
        "i", cohort_month(F.lit(D(2024, 1, 1)), F.col("i")).alias("tm")).first()
    assert r.i == 0 and r.tm == D(2023, 12, 1)


def test_month_arithmetic(spark):
    df = mk(spark, "a date, b date, i long", [(D(2024, 3, 1), D(2023, 12, 1), 4)])
    r = df.select(months_between_inclusive("a", "b").alias("n"),
                  signup_month_of("a", "i").alias("s")).first()
    assert r.n == 4 and r.s == D(2023, 12, 1)


def test_d7_d8_parsing(spark):
    df = mk(spark, "m string, sc string, ts timestamp_ntz",
            [("Sep-2023", "Sep-23 Forecast (8+4)", TS(2023, 9, 3)),
             ("sep-2023", "Feb-24 BOD Forecast (1+11)", TS(2024, 2, 1)),
             ("junk", "no parens", TS(2024, 2, 1))])
    rows = df.select(parse_month("m").alias("m"), scenario_actual_month("sc", "ts").alias("l")).collect()
    assert [r.m for r in rows] == [D(2023, 9, 1), D(2023, 9, 1), None]
    assert [r.l for r in rows] == [D(2023, 8, 1), D(2024, 1, 1), None]


def test_q20_risk_bands(spark):
    cut = P.FIXTURE.risk_cutover
    before = cut - dt.timedelta(seconds=1)
    df = mk(spark, "created timestamp_ntz, risk_score double",
            [(before, 0.01), (cut, 0.01), (before, None), (None, 0.01), (before, 0.5), (cut, 0.1),
             (cut, 0.1000001), (before, 0.0)])
    got = [r[0] for r in df.select(risk_band(cutover=cut)).collect()]
    assert got == ["A2", "A3", "NA", "NA", "F", "E", "F", "A1"]


def test_f2_null_status_is_not_paid(spark):
    df = mk(spark, "is_ever_booked int, current_status int",
            [(1, None), (1, 2), (1, 11), (1, 3), (0, 3), (None, 3)])
    assert [r[0] for r in df.select(paid_day_flag()).collect()] == [0, 0, 0, 1, 0, 0]


def test_q8_safe_div(spark):
    df = mk(spark, "a double, b double", [(1.0, 0.0), (1.0, None), (3.0, 2.0), (None, 1.0)])
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, None, 1.5, None]


def test_channel_regroup_first_match(spark):
    df = mk(spark, "country string, channel_lvl_5 string",
            [("AU", "Google_Mobile"), ("AU", "Google_Mobile_Brand"), ("US", "Google_Mobile"),
             ("AU", "Apple"), ("AU", None)])
    got = [r[0] for r in df.select(regroup_channel()).collect()]
    assert got == ["Google", "Google_Brand", "Google_Mobile", "Apple", None]


def test_p9_cast_by_name(spark):
    df = mk(spark, "Forecast_MONTH string, month string, value string", [("2024-01-01", "2024-02-01", "3")])
    out = cast_by_name(df)
    assert [t for _, t in out.dtypes] == ["date", "date", "string"]


def test_exact_sum_is_order_independent(spark):
    vals = [(i % 7, 12345.67 / (1 + i % 9)) for i in range(5000)]
    df = mk(spark, "k int, x double", vals)
    a = {r.k: r.s for r in df.repartition(1).groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    b = {r.k: r.s for r in df.repartition(13).groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert a == b
    assert all(r.s is None for r in
               mk(spark, "x double", [(None,)]).agg(exact_sum("x").alias("s")).collect())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_sum_has_no_cap_clamp_or_cut(spark, ansi):
    nan, inf = float("nan"), float("inf")
    cases = {"large total": ([1e11] * 1000, 1e14), "large value": ([2e13, 1.0], 2e13 + 1), "tiny": ([3e-7], 3e-7),
             "cancels": ([1e17, 0.1, -1e17], 0.1), "nan": ([1.0, nan], nan), "inf": ([1.0, inf], inf), "none": ([None, None], None),
             "huge": ([1e30, 1.0], 1e30), "some null": ([None, 2.5], 2.5)}
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = mk(spark, "k string, x double", [(k, x) for k, (xs, _) in cases.items() for x in xs])
        got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
        carried = df.groupBy("k", F.rand(1) < 0.5).agg(*sum_terms("x", "m")).groupBy("k").agg(*sum_parts("m"))
        again = {r.k: r.s for r in carried.select("k", value("m").alias("s")).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    for k, (_, want) in cases.items():
        for v in (got[k], again[k]):
            assert v == want or (want is not None and math.isnan(want) and math.isnan(v)), (k, v)


def test_session_needs_a_shared_folder_off_local_mode(spark, monkeypatch):
    from cohortcast import session

    class Elsewhere:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Elsewhere()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
    assert session.shared_dir(spark)  # local mode


def test_risk_cutover_ignores_session_zone(spark):
    cut = P.FIXTURE.risk_cutover
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = mk(spark, "created timestamp_ntz, risk_score double",
                [(cut - dt.timedelta(seconds=1), 0.01), (cut, 0.01)])
        assert [r[0] for r in df.select(risk_band(cutover=cut)).collect()] == ["A2", "A3"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_q19_nulls_sort_last(spark):
    from cohortcast.functions.columns import sort_nulls_last
    df = mk(spark, "k long, v string", [(None, "n"), (2, "b"), (1, "a")])
    assert [r.v for r in sort_nulls_last(df, "k").collect()] == ["a", "b", "n"]


def test_s6_run_output_path():
    from cohortcast.plans.pipeline import run_output_path
    assert run_output_path("s3://bucket/runs/", dt.datetime(2024, 10, 11, 11, 10, 24)) == \
        "s3://bucket/runs/2024-10-11-11-10-24/rate_forecast"
