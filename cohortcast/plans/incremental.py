"""The cohort cube kept between runs: a refresh reads what changed.

A store is a folder with three tables:

* ``members``, one folder a run: the bucket rows (facts.bucket_rows) of the
  reservations that the run saw change, and a row without days for each such
  reservation, which supersedes its rows of earlier runs;
* ``base``, one folder a run: the sign-up base;
* ``cube``, one folder a sign-up cohort: the sums, with counts of their terms.

A refresh takes the reservations that are said to have changed and those of
drivers whose sign-up changed, takes their old rows (members) back out of the
sums, adds their new ones, and overwrites the cohorts that this touches.  The
sums are exact (functions.numeric), so what is taken back leaves no trace and
the cube equals one that is built of all history.  Other reservations and
members are scanned once (semi-joins with the changed ids; broadcast by the
planner while these are few, so nothing else is shuffled), but not joined to
sign-ups, spread over buckets or summed again.

Runs are numbered.  Repeating one that failed half-way is safe: its members are
overwritten, and cohorts that it had finished carry its number and are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.numeric import parts, sum_parts
from cohortcast.operators import facts, joins
from cohortcast.plans.pipeline import Pipeline
from cohortcast.plans.stages import Stages, _fs
from cohortcast.sources.tables import Sources

KEYS = ["signup_month", *facts.CUBE_KEYS]
MEASURES = ("net_revenue", "trips")
MEMBER_COLUMNS = ["reservation_id", "driver_id", *KEYS, "days", "flag", *MEASURES]
_TERMS = [f"{m}_terms" for m in MEASURES]
_COUNTED = ["paid_days", "n_days", *_TERMS]
_SUMS = [*_COUNTED, *[c for m in MEASURES for c in parts(m)]]


def _sums(rows: DataFrame) -> DataFrame:
    """Bucket rows per cohort and cube key, with the number of days (a group
    without any is gone) and of terms (a sum without any is NULL)."""
    counts = [F.sum("days").alias("n_days"), *[F.count(m).alias(t) for m, t in zip(MEASURES, _TERMS)]]
    return facts.bucket_sums(rows, *counts, keys=KEYS).select(*KEYS, *_SUMS)


def _taken_back(sums: DataFrame) -> DataFrame:
    return sums.select(*KEYS, *[(-F.col(c)).alias(c) for c in _SUMS])


def _added(sums: DataFrame) -> DataFrame:
    return (sums.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in _COUNTED], *[c for m in MEASURES for c in sum_parts(m)])
            .select(*KEYS, *_SUMS))


class CubeStore:
    def __init__(self, spark: SparkSession, path: str, params: P.Params = P.PRODUCTION):
        self.spark, self.path, self.params = spark, path.rstrip("/"), params

    # -- tables -----------------------------------------------------------
    def _table(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._table(name))

    def _write(self, df: DataFrame, name: str, by: str) -> None:
        """Overwrites the folders of ``by`` that ``df`` has rows for."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(self._table(name))

    def runs(self) -> list[int]:
        """Runs whose sign-up base is there, oldest first."""
        fs, p = _fs(self.spark, self._table("base"))
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n.removeprefix("run=")) for n in names if n.startswith("run="))

    # -- runs -------------------------------------------------------------
    def build(self, src: Sources, run: int = 0) -> None:
        """The store of all history; what stood here before is replaced."""
        with Stages(self.spark) as stages:
            p = Pipeline(src, self.params, stages=stages)
            for name in ("members", "cube", "base"):
                fs, at = _fs(self.spark, self._table(name))
                fs.delete(at, True)
            self._write(self._members(p, p.signed_reservations, run), "members", "run")
            self._write_cube(_sums(self._read("members").where(F.col("days") > 0)), run)
            self._write(p.signup_base.withColumn("run", F.lit(run)), "base", "run")

    def refresh(self, src: Sources, changed: DataFrame, run: int) -> None:
        """Brings the store to ``src``.  ``changed (reservation_id)`` names the
        reservations that are new, gone or different in any table since the
        last run; sign-ups are compared here.  Naming too many is harmless."""
        before = [r for r in self.runs() if r < run]
        if not before:
            raise ValueError("there is no earlier run to refresh: build the store first")
        with Stages(self.spark) as stages:
            p = Pipeline(src, self.params, stages=stages)
            members = self._read("members").where(F.col("run") < run)
            ids = stages.put(self._affected(p, members, changed, before[-1]), "affected")
            old = self._latest(members.join(ids, "reservation_id", "left_semi"))
            taken = stages.put(_sums(old), "taken-back")
            odd = taken.agg(*[F.sum(parts(m)[2]) for m in MEASURES]).first()
            if any(odd):  # terms beyond decimal cannot be taken out of a double sum again
                return self.build(src, run)
            mine = lambda df: df.join(ids, "reservation_id", "left_semi")
            summary = mine(src.res_summary)
            signed = facts.signed_reservations(mine(src.res_profit), summary, mine(src.res_dim), p.signup_base,
                                               joins.hot_keys(summary.select("driver_id"), "driver_id", self.params.hot_key_rows))
            fresh = self._members(p, signed, run)
            gone = ids.select("reservation_id", *[F.lit(None).cast(fresh.schema[c].dataType).alias(c)
                                                  for c in MEMBER_COLUMNS[1:] if c != "days"],
                              F.lit(0).cast("long").alias("days"), F.lit(run).alias("run"))
            self._write(fresh.unionByName(gone), "members", "run")
            added = _sums(self._read("members").where((F.col("run") == run) & (F.col("days") > 0)))
            delta = stages.put(added.unionByName(_taken_back(taken)), "delta")
            # A list of months: as long as the history, whatever its volume.
            touched = [r.signup_month for r in delta.select("signup_month").distinct().collect()]
            held = self._read("cube").where(F.col("signup_month").isin(touched))
            done = [r.signup_month for r in held.where("trip_month IS NULL").where(F.col("run") >= run).select("signup_month").collect()]
            todo = F.col("signup_month").isin([m for m in touched if m not in done])
            now = _added(held.where(todo & F.col("trip_month").isNotNull()).select(*KEYS, *_SUMS)
                         .unionByName(delta.where(todo)))
            left = stages.put(now.where(F.col("n_days") > 0), "cohorts")  # read from the cube before it is overwritten
            self._write_cube(left, run, [m for m in touched if m not in done])
            self._write(p.signup_base.withColumn("run", F.lit(run)), "base", "run")

    def cube(self) -> DataFrame:
        """The cube as facts.cohort_cube makes it."""
        rows = self._read("cube").where(F.col("trip_month").isNotNull())

        def part(m: str, c: str) -> Column:
            return F.when(F.col(f"{m}_terms") > 0, F.col(c)).alias(c) if not c.endswith("_odd") else F.col(c)
        return rows.select(*facts.CUBE_KEYS, "paid_days", *[part(m, c) for m in MEASURES for c in parts(m)])

    # -- steps ------------------------------------------------------------
    def _members(self, p: Pipeline, signed: DataFrame, run: int) -> DataFrame:
        rows = facts.bucket_rows(signed, p.src.calendar, self.params, p.calendar_span, p.calendar_span is None,
                                 keep=("reservation_id", "driver_id", "signup_month"))
        return rows.select(*MEMBER_COLUMNS, F.lit(run).alias("run"))

    def _affected(self, p: Pipeline, members: DataFrame, changed: DataFrame, last: int) -> DataFrame:
        """Changed reservations, and all of drivers whose sign-up changed,
        appeared or went, old and new."""
        cols = ["signup_date", "signup_month", "channels"]
        old = self._read("base").where(F.col("run") == last).select("driver_id", F.struct(*cols).alias("was"))
        new = p.signup_base.select("driver_id", F.struct(*cols).alias("is"))
        moved = old.join(new, "driver_id", "full").where(~F.col("was").eqNullSafe(F.col("is"))).select("driver_id")
        of = lambda df: df.join(moved, "driver_id", "left_semi").select("reservation_id")
        return changed.select("reservation_id").unionByName(of(p.src.res_summary)).unionByName(of(members)).distinct()

    @staticmethod
    def _latest(members: DataFrame) -> DataFrame:
        """Each reservation's rows of its last run: a bounded number each."""
        last = F.max("run").over(W.partitionBy("reservation_id"))
        return members.withColumn("_last", last).where((F.col("run") == F.col("_last")) & (F.col("days") > 0)).drop("_last")

    def _write_cube(self, sums: DataFrame, run: int, months: list | None = None) -> None:
        """Overwrites the cohorts of ``sums``, and of ``months``: a row without
        a trip month stands in each, so that a cohort that lost all its facts
        is overwritten too, and tells the run that wrote it."""
        if months is None:
            marks = sums.select("signup_month").distinct()
        else:
            marks = self.spark.createDataFrame([(m,) for m in months], "signup_month date")
        marks = marks.select("signup_month", *[F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in sums.columns[1:]])
        rows = sums.unionByName(marks).withColumn("run", F.lit(run))
        # one file a cohort: a cohort has channels x increments rows
        self._write(rows.repartition("signup_month"), "cube", "signup_month")
