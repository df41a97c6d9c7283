"""Registered queries: one per operator key of the survey, each a function
``(spark, sf_dir) -> DataFrame`` over the stand-ins built from the driver's
tables, with the column names and order of its DuckDB twin (``oracle.SPECS``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.columns import cast_by_name
from cohortcast.functions.conditional import risk_band
from cohortcast.functions.numeric import value
from cohortcast.operators import accuracy as acc
from cohortcast.operators import facts, ledger, signups
from cohortcast.operators.profile import profile
from cohortcast.plans.incremental import CubeStore
from cohortcast.plans.oracle import LIFT, SCANNED, SCRIPT_NOTE, SPECS, rounded
from cohortcast.plans.pipeline import Pipeline, backtest
from cohortcast.session import fresh_path
from cohortcast.sources.csv_io import read_csv, write_csv
from cohortcast.sources.fixtures import EARLIER_DAY, earlier_sources, fixture_sources, gapped_calendar
from cohortcast.sources.tables import load_sql, run_script


def pipeline(spark: SparkSession, sf_dir: str, **kw) -> Pipeline:
    return Pipeline(fixture_sources(spark, sf_dir), P.FIXTURE, **kw)


def finish(key: str, df: DataFrame) -> DataFrame:
    """Project onto the key's output columns, in the oracle's order, sums to
    nine digits (see ``oracle.SUMMED``)."""
    nine = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.8e", F.col(c) * LIFT)).cast("double").alias(c)
    return df.select(*[nine(c) if rounded(key, c) else c for c in SPECS[key][1]])


def _spark(p: Pipeline) -> SparkSession:
    return p.src.res_profit.sparkSession


def _risk_band(p: Pipeline) -> DataFrame:
    return p.src.res_dim.select("reservation_id", "created", "risk_score",
                                risk_band(cutover=p.params.risk_cutover).alias("risk_band"))


def _cast_by_name(p: Pipeline) -> DataFrame:
    """Snapshot keys as a text loader returns them, re-typed by column name."""
    text = p.ledger_snapshots.select(*[F.col(c).cast("string").alias(c) for c in
                                       ["scenario", "last_modified_at", "last_actual_month", "month"]],
                                     "nrpd")
    return cast_by_name(text)


LATERAL_ALIAS_SQL = """
SELECT channels, increments_from_signup, sum(paid_day) AS paid_days,
       sum(net_revenue_usd) AS net_revenue, try_divide(net_revenue, paid_days) AS nrpd
FROM cc_trip_day_facts
GROUP BY channels, increments_from_signup
"""


def _lateral_alias_rate(p: Pipeline) -> DataFrame:
    """Spark SQL where a select item reuses aliases defined before it."""
    p.trip_day_facts.createOrReplaceTempView("cc_trip_day_facts")
    return _spark(p).sql(LATERAL_ALIAS_SQL)


def _legacy_scan(p: Pipeline) -> DataFrame:
    p.legacy.createOrReplaceTempView("cc_rates_by_channel")
    return load_sql(_spark(p), "select *\nfrom cc_rates_by_channel")


def _scan_table(p: Pipeline) -> DataFrame:
    """Every value of every input, through views, as SQL sees them."""
    p.src.register_views("cc_")
    return profile({name: load_sql(_spark(p), f"SELECT * FROM cc_{name};") for name in SCANNED})


# A script that reads a session variable: Spark parses and runs it.
ACTUALS_SCRIPT = f"""
BEGIN
  CREATE OR REPLACE TEMPORARY VIEW cc_mature AS
    SELECT * FROM cc_cube WHERE trip_month < add_months(trunc(session.as_of, 'MM'), -1);
  CREATE OR REPLACE TEMPORARY VIEW cc_scripted AS
    SELECT channels, '{SCRIPT_NOTE}' AS note, count(*) AS n_rows, sum(paid_days) AS paid_days
    FROM cc_mature GROUP BY channels;
END
"""


def _scripted_actuals(p: Pipeline) -> DataFrame:
    p.cube.createOrReplaceTempView("cc_cube")
    return run_script(_spark(p), ACTUALS_SCRIPT, "cc_scripted", as_of=p.params.as_of)


def _signup_base_merged(p: Pipeline) -> DataFrame:
    """The sign-up base of an earlier run merged with the rows that came since."""
    late = F.col("signup_date") >= F.lit(EARLIER_DAY)
    earlier = signups.ranked_base(p.signup_rows.where(~late | late.isNull()))
    return signups.merge_bases(earlier, signups.ranked_base(p.signup_rows.where(late)))


def _signup_regions(p: Pipeline) -> DataFrame:
    """Attribution sign-ups of both countries: the labels regroup overseas."""
    rows = signups.signup_attribution(p.src.attribution, p.params, countries=("US", "AU"))
    return rows.join(p.src.attribution.select("driver_id", F.col("channel_lvl_5").alias("label")), "driver_id")


def _backtest_csv(p: Pipeline) -> DataFrame:
    """Back-test of a run's CSV hand-off, as a later run does it."""
    path = write_csv(p.final_forecast, fresh_path(_spark(p), "forecast-csv"))
    return backtest(_spark(p), p.src, read_csv(_spark(p), path), p.legacy, p.params)


def _csv_roundtrip(p: Pipeline) -> DataFrame:
    """Forecast written as CSV to a fresh shared path and read back typed."""
    path = write_csv(p.final_forecast, fresh_path(_spark(p), "forecast-csv"))
    return read_csv(_spark(p), path)


def cube_values(cube: DataFrame) -> DataFrame:
    """The cube with its carried sums as doubles."""
    return cube.select(*facts.CUBE_KEYS, "paid_days", value("net_revenue").alias("net_revenue"), value("trips").alias("trips"))


def _gapped_calendar_cube(p: Pipeline) -> DataFrame:
    """The cube on a calendar that lacks days."""
    cal = gapped_calendar(_spark(p))
    return cube_values(Pipeline(replace(p.src, calendar=cal, calendar_span=None), p.params).cube)


def _split_drivers_cube(p: Pipeline) -> DataFrame:
    """The cube where every driver with more than five reservations is spread
    over several join tasks."""
    return cube_values(Pipeline(p.src, p.params.with_(hot_key_rows=5)).cube)


def _incremental_cube(p: Pipeline) -> DataFrame:
    """The cube of an earlier state, refreshed with what changed since."""
    store = CubeStore(_spark(p), fresh_path(_spark(p), "cube-store"), p.params)
    earlier, changed = earlier_sources(p.src)
    store.build(earlier, run=1)
    store.refresh(p.src, changed, run=2)
    return cube_values(store.cube())


BUILDERS: dict[str, Callable[[Pipeline], DataFrame]] = {
    "signup_attribution": lambda p: p.attribution_signups,
    "star_signup": lambda p: p.star_signups,
    "signup_union": lambda p: p.signup_rows,
    "signup_base": lambda p: p.signup_base,
    "signup_base_merged": _signup_base_merged,
    "scripted_actuals": _scripted_actuals,
    "reservation_join": lambda p: p.reservations,
    "trip_day_facts": lambda p: p.trip_day_facts,
    "forecast_spine": lambda p: p.spine,
    "trailing_channel": lambda p: p.channel_sums,
    "trailing_increment": lambda p: p.increment_sums,
    "trailing_total": lambda p: p.total_sums,
    "channel_rates": lambda p: p.channel_rates,
    "increment_rates": lambda p: p.increment_rates,
    "increment_ratio": lambda p: p.increment_ratio,
    "index_table": lambda p: p.index_table,
    "ledger_last_modified": lambda p: ledger.ledger_last_modified(p.src.ledger),
    "ledger_snapshots": lambda p: p.ledger_snapshots,
    "forecast_only": lambda p: p.forecast_only,
    "final_forecast": lambda p: p.final_forecast,
    "actuals": lambda p: p.actuals,
    "accuracy_join": lambda p: p.accuracy,
    "payback_filter": lambda p: p.payback,
    "paid_days_weight": lambda p: acc.paid_days_weight(p.payback),
    "weighted_accuracy": lambda p: p.weighted_accuracy,
    "booked_day_flag": lambda p: facts.booked_day_flags(p.reservations, p.params),
    "increment_bucket": lambda p: facts.increment_buckets(p.signed_reservations, p.params),
    "risk_band": _risk_band,
    "parse_month": lambda p: ledger.ledger_months(p.src.ledger),
    "parse_scenario": lambda p: ledger.scenario_months(p.src.ledger),
    "cast_by_name": _cast_by_name,
    "lateral_alias_rate": _lateral_alias_rate,
    "actual_signup_month": lambda p: acc.actual_signup_month(p.actuals),
    "legacy_scan": _legacy_scan,
    "scan_table": _scan_table,
    "signup_regions": _signup_regions,
    "backtest_csv": _backtest_csv,
    "csv_roundtrip": _csv_roundtrip,
    "ordered_forecast": lambda p: p.ordered_forecast,
    "accuracy_sorted": lambda p: p.accuracy_sorted,
    "gapped_calendar_cube": _gapped_calendar_cube,
    "split_drivers_cube": _split_drivers_cube,
    "incremental_cube": _incremental_cube,
    "chart_seasonality": lambda p: p.chart_seasonality,
    "chart_accuracy": lambda p: p.chart_accuracy,
}


def build(key: str, spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return finish(key, BUILDERS[key](pipeline(spark, sf_dir, **kw)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, _k=k: build(_k, spark, sf_dir)) for k in BUILDERS}
