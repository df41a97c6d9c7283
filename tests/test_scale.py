"""Scale behaviour: a hot driver is spread over tasks, the production entry reads
catalog/parquet inputs, and run() cuts lineage with a reliable checkpoint."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.operators import facts, joins
from cohortcast.plans import oracle
from cohortcast.plans.pipeline import Pipeline, run
from cohortcast.plans.queries import pipeline
from cohortcast.session import fresh_path
from cohortcast.sources.csv_io import read_csv
from cohortcast.schemas import INPUTS
from cohortcast.sources.tables import from_catalog
from compare import duck
from conftest import SF_SMALL
from test_facts import _cube_rows as cube_rows


def _skewed_inputs(spark, n=60000):
    """Reservations where driver 0 holds a third of all rows."""
    res = (spark.range(n)
           .select(F.col("id").alias("reservation_id"),
                   F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
                   .cast("long").alias("driver_id"),
                   (F.col("id") % 1000 + 10).cast("double").alias("gaap_net_revenue"),
                   F.lit(1).alias("is_ever_booked"), (F.col("id") % 13).cast("int").alias("current_status"),
                   F.timestamp_add("DAY", (F.col("id") % 400).cast("int"), F.lit(dt.datetime(2023, 1, 1)))
                   .cast("timestamp_ntz").alias("trip_start_ts"),
                   F.lit(None).cast("timestamp_ntz").alias("summary_start_ts"),
                   F.lit(None).cast("timestamp_ntz").alias("created"),
                   F.lit(0.01).alias("risk_score"),
                   F.lit(None).cast("timestamp_ntz").alias("dim_start_ts"),
                   (F.col("id") % 5 + 1).cast("double").alias("paid_days")))
    base = (spark.range(998)
            .select(F.col("id").alias("driver_id"),
                    F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 28).cast("int")).alias("signup_date"),
                    F.lit(dt.date(2023, 1, 1)).alias("signup_month"),
                    F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("channels")))
    return res, base


def test_hot_driver_is_split_over_tasks(spark):
    res, base = _skewed_inputs(spark)
    hot = joins.hot_keys(res.select("driver_id"), "driver_id", 2000)
    assert [(r.driver_id, r._buckets) for r in hot.collect()] == [(0, 10)]
    plain = cube_rows(facts.cohort_cube(facts.with_signups(res, base)))
    split = cube_rows(facts.cohort_cube(facts.with_signups(res, base, hot)))
    assert plain == split
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        def biggest_task(df):
            return max(r["count"] for r in
                       df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
        unsplit = biggest_task(facts.trip_span(res).join(base, "driver_id"))
        spread = biggest_task(joins.split_hot_join(facts.trip_span(res), base, "driver_id", hot,
                                                   "reservation_id"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert unsplit >= 20000                 # the hot driver lands in one task
    assert spread < 20000 / 2               # ... and is spread once split


def test_aqe_also_splits_the_hot_partition(spark):
    """With split disabled, AQE's skew join splits the same join (tiny thresholds
    stand in for the 256 MB default a third of 100 TB far exceeds)."""
    from cohortcast.operators import signups
    res, base = _skewed_inputs(spark)
    rows = base.select("*", F.lit("web").alias("platform"), F.lit("US").alias("country"),
                       F.lit(2).alias("pick_rank"))
    windowed = signups.signup_base(rows)           # base partitioned by the de-dup window
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = facts.cohort_cube(facts.with_signups(res, windowed))
        keep = [k for k, c in enumerate(df.columns) if not c.endswith("_plain")]
        got = sorted(tuple(r[k] for k in keep) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert got == cube_rows(facts.cohort_cube(facts.with_signups(res, base)))


def test_from_catalog_matches_fixture(spark):
    """Write the stand-ins as parquet tables and run the production entry on them."""
    p = pipeline(spark, SF_SMALL)
    root = fresh_path(spark, "catalog")
    paths = {}
    for name in INPUTS:
        path = f"{root}/{name}.parquet"
        getattr(p.src, name).write.parquet(path)
        paths[name] = path
    src = from_catalog(spark, paths)
    q = Pipeline(src, P.FIXTURE)
    a = sorted(map(tuple, p.final_forecast.collect()), key=str)
    b = sorted(map(tuple, q.final_forecast.collect()), key=str)
    assert a == b and len(a) == 180


def test_run_checkpoints_and_writes_csv(spark):
    p = pipeline(spark, SF_SMALL)
    out = fresh_path(spark, f"run-{uuid.uuid4().hex[:8]}")
    result = run(spark, p.src, P.FIXTURE, out=out)
    # the cube was cut from its lineage: the plan reads no reservation table
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "is_ever_booked" not in plan
    back = read_csv(spark, out)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, p.final_forecast.collect()), key=str)


def test_calendar_with_gap_uses_day_path(spark):
    """A calendar missing a day must drop that day's facts: the pipeline sees
    the gap and builds the cube from day rows instead of buckets."""
    import dataclasses
    p = pipeline(spark, SF_SMALL)
    gap_day = dt.date(1997, 3, 15)
    cal = p.src.calendar.where(F.col("date") != F.lit(gap_day))
    src = dataclasses.replace(p.src, calendar=cal, date_dim=cal, calendar_span=None)
    q = Pipeline(src, P.FIXTURE)
    assert q.calendar_span is None
    expected = facts.cube_from_days(q.trip_day_facts)
    assert cube_rows(q.cube) == cube_rows(expected)
    assert q.trip_day_facts.where(F.col("trip_date") == F.lit(gap_day)).count() == 0
    full = Pipeline(dataclasses.replace(p.src, calendar_span=None), P.FIXTURE)
    assert full.calendar_span == (dt.date(1995, 1, 1), dt.date(2001, 12, 31))


def test_catalog_columns_are_renamed_and_tables_must_be_named(spark):
    p = pipeline(spark, SF_SMALL)
    root = fresh_path(spark, "catalog")
    for name in INPUTS:
        df = getattr(p.src, name)
        (df.withColumnRenamed("risk_score", "score") if name == "res_dim" else df).write.parquet(f"{root}/{name}.parquet")
    paths = {name: f"{root}/{name}.parquet" for name in INPUTS}
    src = from_catalog(spark, paths, {"res_dim": {"score": "risk_score"}})
    assert src.res_dim.where("risk_score IS NOT NULL").count() > 0
    with pytest.raises(ValueError, match="ledger"):
        from_catalog(spark, {k: v for k, v in paths.items() if k != "ledger"})


def test_calendar_with_a_repeated_day_is_rejected(spark):
    import dataclasses
    p = pipeline(spark, SF_SMALL)
    src = dataclasses.replace(p.src, calendar=p.src.calendar.unionByName(p.src.calendar.limit(1)), calendar_span=None)
    with pytest.raises(ValueError, match="repeats"):
        Pipeline(src, P.FIXTURE).cube


def test_hot_drivers_through_the_pipeline(spark):
    """The one join plan gives the same cube whatever counts as hot."""
    p = pipeline(spark, SF_SMALL)
    q = Pipeline(p.src, P.FIXTURE.with_(hot_key_rows=5))
    assert q.hot_drivers.count() > 10 and p.hot_drivers.count() == 0
    assert cube_rows(p.cube) == cube_rows(q.cube)


def test_back_test_from_the_csv_hand_off(spark):
    from cohortcast.__main__ import main
    p = pipeline(spark, SF_SMALL)
    base = fresh_path(spark, "cli")
    csv = main(["--out", base, "--fixture", SF_SMALL, "--shuffle-partitions", "8"])
    out = main(["backtest", "--forecast", csv, "--out", base, "--fixture", SF_SMALL, "--shuffle-partitions", "8"])
    assert out.endswith("/weighted_accuracy")
    assert spark.read.csv(out, header=True).count() == p.weighted_accuracy.count() > 0


def test_bucketed_reservations_join_without_shuffle(spark):
    """Reservation tables bucketed by reservation_id join with no Exchange."""
    from cohortcast.sources.layout import bucket_reservations
    p = pipeline(spark, SF_SMALL)
    tag = uuid.uuid4().hex[:6]
    src = bucket_reservations(spark, p.src, 4, prefix=f"cc_{tag}_")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        joined = facts.reservation_join(src.res_profit, src.res_summary, src.res_dim)
        rows = sorted(map(tuple, joined.collect()))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows == sorted(map(tuple, p.reservations.collect()))


def test_pipeline_join_order_uses_buckets(spark):
    """With bucketed profit and dims, only the signed summary shuffles by reservation_id."""
    import re
    from cohortcast.sources.layout import bucket_reservations
    p = pipeline(spark, SF_SMALL, materialize=False)
    src = bucket_reservations(spark, p.src, 8, prefix=f"cc_{uuid.uuid4().hex[:6]}_")
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    counts = {}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for name, pl in [("plain", p), ("bucketed", Pipeline(src, P.FIXTURE, materialize=False))]:
            df = pl.signed_reservations
            df.collect()  # runs this plan; a write would run a copy of it
            final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            counts[name] = len(re.findall(r"Exchange hashpartitioning\(reservation_id", final))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert counts["plain"] == 3 and counts["bucketed"] == 1, counts


def test_split_join_with_several_hot_keys_and_null_keys(spark):
    big = (spark.range(30000)
           .select(F.col("id").alias("reservation_id"),
                   F.when(F.col("id") % 10 == 0, F.lit(None).cast("long"))      # NULL keys never match
                   .when(F.col("id") % 10 < 4, F.lit(1).cast("long"))            # hot key 1
                   .when(F.col("id") % 10 < 7, F.lit(2).cast("long"))            # hot key 2
                   .otherwise(F.col("id") % 50 + 3).alias("driver_id"),
                   F.col("id").alias("v")))
    small = spark.range(60).select(F.col("id").alias("driver_id"), (F.col("id") * 10).alias("w"))
    hot = joins.hot_keys(big.select("driver_id"), "driver_id", 1000)
    assert sorted(r.driver_id for r in hot.collect()) == [1, 2]
    plain = sorted(map(tuple, big.join(small, "driver_id").collect()))
    split = sorted(map(tuple, joins.split_hot_join(big, small, "driver_id", hot, "reservation_id").collect()))
    assert plain == split and len(plain) == 27000


def test_command_line_run(spark):
    from cohortcast.__main__ import main
    from cohortcast.session import shared_dir
    base = fresh_path(spark, "cli")
    out = main(["--out", base, "--fixture", SF_SMALL, "--shuffle-partitions", "8", "--as-of", "2001-10-01"])
    assert out.startswith(base) and out.endswith("/rate_forecast")
    assert read_csv(spark, out).count() == 180
    assert shared_dir(spark)


def test_read_legacy_conforms(spark):
    from cohortcast.sources.tables import read_legacy
    p = pipeline(spark, SF_SMALL)
    path = fresh_path(spark, "legacy") + "/t.parquet"
    p.legacy.write.parquet(path)
    back = read_legacy(spark, path)
    assert back.dtypes == [("channels", "string"), ("signup_month", "date"),
                           ("increments_from_signup", "bigint"), ("net_revenue_per_paid_day", "double")]
    twin = oracle.ORACLE["legacy_scan"]
    assert back.count() == duck(SF_SMALL).execute(f"SELECT count(*) FROM ({twin})").fetchone()[0] > 0
