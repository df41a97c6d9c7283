"""The whole model as lazy DataFrames, cut at two boundaries.

:class:`Pipeline` exposes every derived relation as a property.  Two relations
feed several consumers: the sign-up base (spine and facts) and the cohort
cube (channel, increment and total sums, actuals).  Spark does not share such
a sub-plan reliably: each consumer's optimizer pass prunes columns and pushes
filters into it differently (the channel path's ``increment = 1`` filter ends
up inside the cube's explode), so the big inputs would be scanned once per
consumer.  With ``materialize=True`` (the default) both are written once as
Parquet to the folder named by ``spark.checkpoint.dir`` and read back: one pass
over the inputs, consumers read only the columns they use, and a cut lineage so
a lost executor never sends a retry back to the raw tables.  The base has one
row per driver and the cube is tiny, so the writes are small.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.operators import accuracy as acc
from cohortcast.operators import facts, index, joins, ledger, ordering, series, signups, trailing
from cohortcast.plans.stages import Stages
from cohortcast.sources.tables import Sources


class Pipeline:
    def __init__(self, src: Sources, params: P.Params = P.PRODUCTION,
                 legacy: DataFrame | None = None, cube_method: str = "buckets",
                 materialize: bool = True, forecast: DataFrame | None = None, stages: Stages | None = None):
        """``legacy``: the older forecast table; ``forecast``: an earlier run's
        forecast (``read_csv``) to back-test instead of computing it;
        ``stages``: where shared relations are staged (its own, if not given)."""
        self.src = src
        self.params = params
        self._legacy = legacy
        self.cube_method = cube_method
        self.materialize = materialize
        self._forecast = forecast
        self._stages = stages

    @cached_property
    def stages(self) -> Stages:
        return self._stages or Stages(SparkSession.active())

    def close(self) -> None:
        """Drops what was staged; nothing of the pipeline can be read then."""
        if "stages" in self.__dict__:
            self.stages.drop()

    def _cut(self, df: DataFrame, name: str, always: bool = False) -> DataFrame:
        """Write ``df`` once to the shared folder and read it back."""
        if not (self.materialize or always):
            return df
        return self.stages.put(df, name)

    # -- sign-ups ---------------------------------------------------------
    @cached_property
    def attribution_signups(self) -> DataFrame:
        return signups.signup_attribution(self.src.attribution, self.params)

    @cached_property
    def star_signups(self) -> DataFrame:
        s = self.src
        return signups.star_signup(s.session_fact, s.date_dim, s.location_dim,
                                   s.channel_dim, s.conversion_mart, s.driver_dim)

    @cached_property
    def signup_rows(self) -> DataFrame:
        return signups.signup_union(self.attribution_signups,
                                    signups.override_signups(self.star_signups, self.params))

    @cached_property
    def signup_base(self) -> DataFrame:
        return self._cut(signups.signup_base(self.signup_rows), "signup-base")

    # -- facts ------------------------------------------------------------
    @cached_property
    def reservations(self) -> DataFrame:
        s = self.src
        return facts.reservation_join(s.res_profit, s.res_summary, s.res_dim)

    @cached_property
    def hot_drivers(self) -> DataFrame:
        """Drivers whose reservations are split over several join tasks: counted
        over one column, map-side first.  Both sides of the join broadcast the
        same list, so Spark computes it once (a reused exchange), within the
        query: no job of its own.  The join is the same whether the list is
        empty or not."""
        return joins.hot_keys(self.src.res_summary.select("driver_id"), "driver_id", self.params.hot_key_rows)

    @cached_property
    def signed_reservations(self) -> DataFrame:
        s = self.src
        return facts.signed_reservations(s.res_profit, s.res_summary, s.res_dim, self.signup_base,
                                         self.hot_drivers)

    @cached_property
    def trip_day_facts(self) -> DataFrame:
        return facts.trip_day_facts(self.signed_reservations, self.src.calendar, self.params,
                                    self.calendar_span)

    @cached_property
    def calendar_span(self):
        """(first, last) day when the calendar has no gaps, else None.

        Known up front for a generated calendar; otherwise read with one
        aggregate over the calendar (one row per day, so a small table).
        """
        if self.src.calendar_span is not None:
            return self.src.calendar_span
        r = self.src.calendar.agg(F.countDistinct("date").alias("n"), F.count("date").alias("rows"),
                                  F.min("date").alias("lo"), F.max("date").alias("hi")).first()
        if r.rows != r.n:
            raise ValueError(f"the calendar repeats {r.rows - r.n} days; each would count its trips again")
        if r.lo is None or r.n != (r.hi - r.lo).days + 1:
            return None
        return (r.lo, r.hi)

    @cached_property
    def cube(self) -> DataFrame:
        """Facts summed per (channel, cohort month, increment); see facts.cohort_cube.

        Known gaps of the calendar are counted by ranks (facts.calendar_ranks).
        """
        if self.cube_method == "days":
            return self._cut(facts.cube_from_days(self.trip_day_facts), "cohort-cube")
        return self._cut(facts.cohort_cube(self.signed_reservations, self.src.calendar, self.params, self.calendar_span,
                                           gaps=self.calendar_span is None), "cohort-cube")

    # -- trailing sums and rates ------------------------------------------
    @cached_property
    def spine(self) -> DataFrame:
        return trailing.forecast_spine(self.signup_base, self.params.since)

    @cached_property
    def channel_sums(self) -> DataFrame:
        return trailing.channel_sums(self.spine, self.cube, self.params.window_months)

    @cached_property
    def increment_sums(self) -> DataFrame:
        return trailing.increment_sums(self.spine, self.cube, self.params.window_months)

    @cached_property
    def total_sums(self) -> DataFrame:
        return trailing.total_sums(self.spine, self.cube, self.params.window_months)

    @cached_property
    def channel_rates(self) -> DataFrame:
        return trailing.channel_rates(self.channel_sums, self.total_sums)

    @cached_property
    def increment_rates(self) -> DataFrame:
        return trailing.increment_rates(self.increment_sums, self.total_sums)

    # -- ledger -----------------------------------------------------------
    @cached_property
    def ledger_snapshots(self) -> DataFrame:
        return ledger.ledger_snapshots(self.src.ledger, self.params)

    @cached_property
    def forecast_only(self) -> DataFrame:
        return ledger.forecast_only(self.ledger_snapshots)

    # -- indexes and forecast ---------------------------------------------
    @cached_property
    def increment_ratio(self) -> DataFrame:
        return index.increment_ratio(self.increment_rates, self.params.max_increment, self.params.ratio_base)

    @cached_property
    def index_table(self) -> DataFrame:
        return index.index_table(self.channel_rates, self.increment_ratio)

    @cached_property
    def final_forecast(self) -> DataFrame:
        if self._forecast is not None:
            return self._forecast
        return index.final_forecast(self.forecast_only, self.index_table, self.params.max_increment)

    # -- back-test --------------------------------------------------------
    @cached_property
    def actuals(self) -> DataFrame:
        return acc.actuals(self.cube, self.params.as_of)

    @cached_property
    def legacy(self) -> DataFrame:
        if self._legacy is not None:
            return self._legacy
        from cohortcast.sources.fixtures import legacy_forecast
        return legacy_forecast(self.actuals)

    @cached_property
    def accuracy(self) -> DataFrame:
        return acc.accuracy_join(self.final_forecast, self.legacy, self.actuals)

    @cached_property
    def payback(self) -> DataFrame:
        return acc.payback_filter(self.accuracy, self.params.payback_channels)

    @cached_property
    def weighted_accuracy(self) -> DataFrame:
        return acc.weighted_accuracy(self.payback)

    # -- written order -----------------------------------------------------
    @cached_property
    def ordered_forecast(self) -> DataFrame:
        """The forecast as the back-test sorts and numbers it."""
        return ordering.sorted_with_position(self.final_forecast, "forecast_month", "channels", "month", "scenario",
                                             stage=self.stages.put)

    @cached_property
    def accuracy_sorted(self) -> DataFrame:
        return ordering.sorted_with_position(self.weighted_accuracy, "forecast_month", "channels", "scenario",
                                             stage=lambda df, name: self.stages.put(df, "accuracy-ordered"))

    @cached_property
    def chart_seasonality(self) -> DataFrame:
        return series.chart_seasonality(self.increment_ratio)

    @cached_property
    def chart_accuracy(self) -> DataFrame:
        return series.chart_accuracy(self.weighted_accuracy)


# Output files of a run, below a run-stamped folder.
FORECAST_FILE, BACKTEST_FILE = "rate_forecast", "weighted_accuracy"


def run_output_path(base: str, when: dt.datetime | None = None, file: str = FORECAST_FILE) -> str:
    """``{base}/{YYYY-mm-dd-HH-MM-SS}/{file}``: one folder per run."""
    when = when or dt.datetime.now()
    return f"{base.rstrip('/')}/{when:%Y-%m-%d-%H-%M-%S}/{file}"


def run(spark: SparkSession, src: Sources, params: P.Params = P.PRODUCTION,
        out: str | None = None, stages: Stages | None = None) -> DataFrame:
    """End-to-end run: sources -> forecast; optionally write the CSV hand-off.
    Then what was staged is dropped and the written forecast is the result.

    ``out`` is a folder on shared storage (see :func:`run_output_path`).  The
    forecast is written as CSV parts in global order (NULLs last): a range
    sort, so no single task carries the whole table.
    """
    from cohortcast.functions.columns import sort_nulls_last
    from cohortcast.sources.csv_io import read_csv, write_csv
    p = Pipeline(src, params, stages=stages)
    if out is None:
        return p.final_forecast
    try:
        write_csv(sort_nulls_last(p.final_forecast, "scenario", "forecast_month", "month", "channels"), out)
    finally:
        p.close()
    return read_csv(spark, out)


def backtest(spark: SparkSession, src: Sources, forecast: DataFrame, legacy: DataFrame,
             params: P.Params = P.PRODUCTION, out: str | None = None, stages: Stages | None = None) -> DataFrame:
    """Back-test of an earlier run's forecast (``read_csv``) and the older table
    against the actuals; optionally writes the weighted table as CSV, reads
    it back and drops what was staged."""
    from cohortcast.functions.columns import sort_nulls_last
    from cohortcast.schemas import WEIGHTED_ACCURACY
    from cohortcast.sources.csv_io import read_csv, write_csv
    p = Pipeline(src, params, legacy=legacy, forecast=forecast, stages=stages)
    if out is None:
        return p.weighted_accuracy
    try:
        write_csv(sort_nulls_last(p.weighted_accuracy, "scenario", "forecast_month", "channels"), out)
    finally:
        p.close()
    return read_csv(spark, out, WEIGHTED_ACCURACY)
