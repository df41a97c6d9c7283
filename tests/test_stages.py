"""Life cycle of staged tables."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.operators import facts
from cohortcast.plans.incremental import CubeStore
from cohortcast.plans.pipeline import Pipeline, run
from cohortcast.plans.queries import cube_values, pipeline
from cohortcast.plans.stages import Stages, _fs
from cohortcast.session import fresh_path
from cohortcast.sources.fixtures import EARLIER_DAY, earlier_sources
from conftest import SF_SMALL
from test_facts import _cube_rows as cube_rows


def _name(spark):
    return fresh_path(spark, "run").rsplit("/", 1)[1]


def test_a_second_run_leaves_one_copy(spark):
    name = _name(spark)
    for n in (10, 20):
        with_name = Stages(spark, name)
        with_name.put(spark.range(n), "base")
        with_name.put(spark.range(1), "other")
    assert with_name.stages() == ["base", "other"]
    assert len(with_name.versions("base")) == 1 and with_name.get("base").count() == 20
    with_name.drop("other")
    assert with_name.stages() == ["base"] and with_name.get("other") is None
    with_name.drop()
    assert with_name.stages() == []
    with_name.drop()  # if it exists


def test_a_failed_write_leaves_the_old_one(spark):
    with Stages(spark) as stages:
        stages.put(spark.range(10), "base")
        bad = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
        with pytest.raises(Exception, match="lost"):
            stages.put(bad, "base")
        assert stages.get("base").count() == 10
        fs, p = _fs(spark, stages.root)
        assert [s.getPath().getName() for s in fs.listStatus(p)] == ["base"]  # nothing half-written stays


def test_a_stage_may_be_made_from_its_old_version(spark):
    with Stages(spark) as stages:
        stages.put(spark.range(10), "t")
        assert stages.put(stages.get("t").unionByName(spark.range(5)), "t").count() == 15


def test_a_run_with_output_drops_its_stages(spark):
    name = _name(spark)
    p = pipeline(spark, SF_SMALL)
    forecast = run(spark, p.src, P.FIXTURE, out=fresh_path(spark, "out"), stages=Stages(spark, name))
    assert Stages(spark, name).stages() == []
    assert forecast.count() == p.final_forecast.count() > 0


def test_pipeline_closes_its_own_stages(spark):
    p = pipeline(spark, SF_SMALL)
    assert p.cube.count() > 0 and p.stages.stages() == ["cohort-cube", "signup-base"]
    p.close()
    assert p.stages.stages() == []


# -- the cube kept between runs ------------------------------------------------
def _rows(cube):
    return sorted(map(tuple, cube_values(cube).collect()), key=str)


@pytest.fixture(scope="module")
def states(spark):
    p = pipeline(spark, SF_SMALL)
    earlier, changed = earlier_sources(p.src)
    return p, earlier, changed.persist()


def test_refresh_equals_the_full_cube(spark, states):
    p, earlier, changed = states
    store = CubeStore(spark, fresh_path(spark, "store"), P.FIXTURE)
    store.build(earlier, run=1)
    old, new = _rows(Pipeline(earlier, P.FIXTURE).cube), _rows(p.cube)
    assert _rows(store.cube()) == old != new
    store.refresh(p.src, changed, run=2)
    assert _rows(store.cube()) == new
    store.refresh(p.src, changed, run=2)  # the same run again
    assert _rows(store.cube()) == new
    store.refresh(p.src, changed.limit(0), run=3)  # nothing changed
    assert _rows(store.cube()) == new
    back = earlier.res_dim.select("reservation_id").unionByName(changed).unionByName(p.src.res_dim.select("reservation_id"))
    store.refresh(earlier, back, run=4)  # all the way back
    assert _rows(store.cube()) == old and store.runs() == [1, 2, 3, 4]


def test_refresh_after_a_failure_between_cohorts(spark, states, monkeypatch):
    """Some cohorts were overwritten when the run broke off."""
    p, earlier, changed = states
    store = CubeStore(spark, fresh_path(spark, "store"), P.FIXTURE)
    store.build(earlier, run=1)
    whole = CubeStore._write_cube

    def half(self, sums, run, months=None):
        some = sorted(months)[::2]
        whole(self, sums.where(F.col("signup_month").isin(some)), run, some)
        raise RuntimeError("executor lost")
    monkeypatch.setattr(CubeStore, "_write_cube", half)
    with pytest.raises(RuntimeError):
        store.refresh(p.src, changed, run=2)
    monkeypatch.undo()
    store.refresh(p.src, changed, run=2)
    assert _rows(store.cube()) == _rows(p.cube)


def test_refresh_reads_fewer_facts(spark, states):
    """Only a changed reservation gets new member rows; late rows of old
    cohorts are among them, and a cohort that empties is gone."""
    p, earlier, changed = states
    store = CubeStore(spark, fresh_path(spark, "store"), P.FIXTURE)
    store.build(p.src, run=1)
    one = p.trip_day_facts.select("reservation_id").first().reservation_id
    without = dataclasses.replace(p.src, res_dim=p.src.res_dim.where(F.col("reservation_id") != one))
    store.refresh(without, spark.createDataFrame([(one,)], "reservation_id long"), run=2)
    assert store._read("members").where("run = 2").select("reservation_id").distinct().count() == 1
    assert _rows(store.cube()) == _rows(Pipeline(without, P.FIXTURE).cube) != _rows(p.cube)
    none = dataclasses.replace(p.src, res_dim=p.src.res_dim.limit(0))
    store.refresh(none, p.src.res_dim.select("reservation_id"), run=3)
    assert store.cube().count() == 0
    assert EARLIER_DAY > dt.date(1996, 1, 1)


def test_refresh_needs_a_store(spark, states):
    p, _, changed = states
    with pytest.raises(ValueError, match="build"):
        CubeStore(spark, fresh_path(spark, "store"), P.FIXTURE).refresh(p.src, changed, run=1)


def test_refresh_with_terms_beyond_decimal(spark, states):
    """An infinite revenue is taken back: the store is built anew."""
    p, _, _ = states
    one = p.trip_day_facts.select("reservation_id").where("paid_day = 1").first().reservation_id
    odd = dataclasses.replace(p.src, res_profit=p.src.res_profit.withColumn(
        "gaap_net_revenue", F.when(F.col("reservation_id") == one, float("inf")).otherwise(F.col("gaap_net_revenue"))))
    store = CubeStore(spark, fresh_path(spark, "store"), P.FIXTURE)
    store.build(odd, run=1)
    assert _rows(store.cube()) == _rows(Pipeline(odd, P.FIXTURE).cube)
    store.refresh(p.src, spark.createDataFrame([(one,)], "reservation_id long"), run=2)
    assert _rows(store.cube()) == _rows(p.cube)


# -- calendars with gaps ----------------------------------------------------------
@pytest.mark.parametrize("holds", ["dayofweek(date) not in (1, 7)", "date between '1997-01-10' and '1997-01-12' or date > '1998-02-03'",
                                   "day(date) = 1", "date = '1997-05-05'"])
def test_gaps_in_bucket_form(spark, holds):
    p = pipeline(spark, SF_SMALL)
    src = dataclasses.replace(p.src, calendar=p.src.calendar.where(holds), calendar_span=None)
    q = Pipeline(src, P.FIXTURE)
    assert cube_rows(q.cube) == cube_rows(facts.cube_from_days(q.trip_day_facts))
    plan = facts.cohort_cube(q.signed_reservations, src.calendar, P.FIXTURE, gaps=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(_lo" not in plan  # no row per day
