"""Benchmark the headline queries.

Runs each query to completion (``noop`` sink: every column computed, nothing
collected) on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints one JSON
line.  Each query is warmed once, then timed ``$BENCH_RUNS`` times; the
median is reported.  ``BENCH_VARIANTS=1`` also times the literal plans
(BETWEEN range join, trailing theta join) the rewrites replace.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cohortcast.operators import facts, trailing  # noqa: E402
from cohortcast.plans.queries import build, pipeline  # noqa: E402
from cohortcast.session import build_session  # noqa: E402

HEADLINE = ["trip_day_facts", "trailing_channel", "trailing_increment", "trailing_total",
            "channel_rates", "increment_ratio", "ledger_snapshots", "final_forecast", "actuals",
            "weighted_accuracy"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(make, runs: int) -> float:
    _run(make())  # warm-up: JIT, file listing, broadcast of small dims
    ts = []
    for _ in range(runs):
        t = time.perf_counter()
        _run(make())
        ts.append(time.perf_counter() - t)
    return statistics.median(ts)


def _literal_days(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    spans = facts.trip_span(p.reservations).join(
        p.signup_base.select("driver_id", "signup_date", "signup_month", "channels"), "driver_id")
    cal = p.src.calendar
    return (spans.join(cal, cal.date.between(F.col("first_day"), F.col("last_day")))
            .where(F.col("signup_month") <= F.col("date")))


def _literal_trailing(spark, sf_dir):
    p = pipeline(spark, sf_dir, cube_method="days")
    d = p.trip_day_facts
    s = p.spine
    return (s.join(d, (d.trip_month < s.forecast_month)
                   & (d.trip_month >= F.add_months(s.forecast_month, -12)), "left")
            .groupBy(s.forecast_month, d.increments_from_signup)
            .agg(F.sum("paid_day").alias("paid_days"), F.sum("net_revenue_usd").alias("net")))


def _time_pipeline(spark, sf_dir: str, runs: int) -> float:
    """One user run: build the pipeline once, compute every output."""
    def once():
        p = pipeline(spark, sf_dir)
        for df in (p.final_forecast, p.actuals, p.weighted_accuracy, p.chart_seasonality, p.chart_accuracy):
            _run(df)
    once()
    ts = []
    for _ in range(runs):
        t = time.perf_counter()
        once()
        ts.append(time.perf_counter() - t)
    return statistics.median(ts)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(2, cpus),
                          app="cohortcast-bench", extra={"spark.driver.memory": "8g"})
    times, errors = {}, {}
    for key in HEADLINE:
        try:
            times[key] = round(_time(lambda k=key: build(k, spark, sf_dir), runs), 3)
        except Exception as e:  # keep benchmarking the rest; report the failure
            times[key], errors[key] = None, f"{type(e).__name__}: {str(e)[:200]}"
    done = [v for v in times.values() if v is not None]
    out = {"metric": "headline_total_sec", "value": round(sum(done), 3), "unit": "sec",
           "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""),
           "cpus": cpus, "runs": runs}
    try:
        out["pipeline_end_to_end_sec"] = round(_time_pipeline(spark, sf_dir, runs), 3)
    except Exception as e:
        errors["pipeline_end_to_end"] = f"{type(e).__name__}: {str(e)[:200]}"
    if errors:
        out["errors"] = errors
    if os.environ.get("BENCH_VARIANTS") == "1":
        out["variants"] = {
            "trip_day_facts_literal_range_join": round(_time(lambda: _literal_days(spark, sf_dir), runs), 3),
            "trailing_increment_literal_theta_join": round(
                _time(lambda: _literal_trailing(spark, sf_dir), runs), 3),
            "trailing_increment_fanout_from_days": round(_time(
                lambda: trailing.increment_sums(pipeline(spark, sf_dir, cube_method="days").spine,
                                                pipeline(spark, sf_dir, cube_method="days", materialize=False).cube), runs), 3),
        }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
