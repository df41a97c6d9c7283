"""Row numbers of a written order: against Python's sort, over skew, ties and NULLs."""

import pytest
from pyspark.sql import functions as F

from cohortcast.operators import ordering
from cohortcast.plans.queries import build
from cohortcast.plans.stages import Stages
from conftest import SF_SMALL


@pytest.fixture
def stage(spark):
    with Stages(spark) as s:
        yield s.put


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 3, 8, 200])
def test_against_pythons_sort(spark, stage, parts):
    """A third of the rows share one key, many have none, rows repeat."""
    rows = [(None if i % 7 == 0 else 5 if i % 3 == 0 else i % 50, f"s{i % 11}" if i % 5 else None, i // 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, s string, v long").repartition(5)
    got = ordering.sorted_with_position(df, "k", "s", stage=stage, parts=parts).collect()
    assert sorted(r.position for r in got) == list(range(3000))
    last = lambda x: (x is None, x if x is not None else 0)
    expected = sorted(rows, key=lambda r: (last(r[0]), (r[1] is None, r[1] or ""), r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.position)] == expected


def test_hot_key_is_split_over_ranges(spark, stage):
    df = spark.range(90_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = {}
    ordering.sorted_with_position(df, "k", stage=lambda d, name: kept.setdefault("rows", stage(d, name)), parts=16)
    counts = [r["count"] for r in kept["rows"].where("k = 1").groupBy(ordering.PART).count().collect()]
    assert len(counts) > 8 and max(counts) < 3 * 90_000 / 16


def test_no_task_takes_all_rows(spark, stage):
    """The only unpartitioned window runs over one row a range."""
    plan = _plan(ordering.sorted_with_position(spark.range(1000).toDF("v"), "v", stage=stage, parts=4))
    window = plan[plan.index("Window"):]
    assert "HashAggregate" in window and plan.count("SinglePartition") == 1 and "row_number" not in plan


def test_index_of_the_present_order(spark, stage):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("v"))
    got = ordering.with_row_index(df, stage=stage, start=1)
    assert [(r.v, r.position) for r in got.orderBy("position").collect()] == [(3 * i, i + 1) for i in range(1000)]
    some = ordering.positions_between(got, 10, 13).orderBy("position")
    assert [r.v for r in some.collect()] == [27, 30, 33]


def test_empty_and_clashing(spark, stage):
    empty = spark.createDataFrame([], "k long")
    assert ordering.sorted_with_position(empty, "k", stage=stage).count() == 0
    with pytest.raises(ValueError):
        ordering.sorted_with_position(spark.range(1).select("id", F.lit(1).alias("position")), "id", stage=stage)


def test_written_order_of_the_forecast(spark):
    rows = build("ordered_forecast", spark, SF_SMALL).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(len(rows)))
    keys = [(r.forecast_month, r.channels is None, r.channels or "", r.month) for r in rows]
    assert keys == sorted(keys)
