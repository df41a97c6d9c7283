"""Table sources: the pipeline's inputs as one bundle of conformed DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortcast import schemas

class _Input:
    """A field that holds a DataFrame, or a function that makes one when the
    field is first read."""

    def __set_name__(self, owner, name: str) -> None:
        self.name = name

    def __get__(self, obj, owner=None) -> DataFrame:
        if obj is None:
            raise AttributeError(self.name)  # a field without a default
        held = obj.__dict__[self.name]
        if callable(held):
            held = obj.__dict__[self.name] = schemas.conform(held(), schemas.INPUTS[self.name])
        return held

    def __set__(self, obj, value: DataFrame | Callable[[], DataFrame]) -> None:
        obj.__dict__[self.name] = value


@dataclass
class Sources:
    """All inputs of one run, each conformed to its declared schema.  A query
    opens the inputs that it reads, the others are never made."""

    attribution: DataFrame = _Input()
    session_fact: DataFrame = _Input()
    date_dim: DataFrame = _Input()
    location_dim: DataFrame = _Input()
    channel_dim: DataFrame = _Input()
    conversion_mart: DataFrame = _Input()
    driver_dim: DataFrame = _Input()
    res_profit: DataFrame = _Input()
    res_summary: DataFrame = _Input()
    res_dim: DataFrame = _Input()
    calendar: DataFrame = _Input()
    ledger: DataFrame = _Input()
    # First and last day of ``calendar`` when known up front, for a calendar
    # with no gaps (a generated one); otherwise the pipeline reads them once.
    calendar_span: tuple[dt.date, dt.date] | None = None

    @classmethod
    def conformed(cls, calendar_span=None, **dfs: DataFrame) -> "Sources":
        return cls(**{k: schemas.conform(v, schemas.INPUTS[k]) for k, v in dfs.items()},
                   calendar_span=calendar_span)

    def register_views(self, prefix: str = "") -> None:
        """Expose every input to ``spark.sql`` as a temp view."""
        for f in fields(self):
            if f.name in schemas.INPUTS:
                getattr(self, f.name).createOrReplaceTempView(prefix + f.name)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet file/folder by path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def from_catalog(spark: SparkSession, names: dict[str, str],
                 columns: dict[str, dict[str, str]] | None = None) -> Sources:
    """Inputs read from catalog tables (or parquet paths) and conformed.

    ``names`` maps every input (the fields of :class:`Sources`) to its table,
    ``columns`` an input to {column there: column here} where they differ.
    """
    missing = sorted(set(schemas.INPUTS) - set(names))
    if missing:
        raise ValueError(f"no table named for {', '.join(missing)}")
    columns = columns or {}
    return Sources(**{
        k: (lambda k=k: read_table(spark, names[k]).withColumnsRenamed(columns.get(k, {}))) for k in schemas.INPUTS})


def _parses(spark: SparkSession, text: str) -> bool:
    """Whether Spark's own parser takes ``text`` as one statement or script."""
    try:
        spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    except ParseException:
        return False
    return True


def load_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run SQL statements separated by ``;`` and return the last one's result.

    Earlier statements are run for their side effects (temp views), the last
    one is returned lazily.  Spark's parser decides which ``;`` ends a
    statement: one in a literal or comment does not.
    """
    body = text.strip()
    while body.endswith(";"):
        body = body[:-1].rstrip()
    if not body:
        raise ValueError("empty SQL script")
    if not _parses(spark, body):
        for at in reversed([i for i, c in enumerate(body) if c == ";"]):
            head, last = body[:at].strip(), body[at + 1:].strip()
            if head and last and _parses(spark, last) and _parses(spark, f"BEGIN\n{head}\n;\nEND"):
                load_sql(spark, head)
                return spark.sql(last)
    return spark.sql(body)  # one statement, or Spark's own message about it


def set_variables(spark: SparkSession, **values) -> None:
    """Declares session variables with the values' own types; SQL reads them
    as ``session.<name>``."""
    for name, value in values.items():
        kind = spark.range(0).select(F.lit(value).alias("v")).schema["v"].dataType.simpleString()
        spark.sql(f"DECLARE OR REPLACE VARIABLE `{name}` {kind}")
        spark.sql(f"SET VAR `{name}` = :value", args={"value": value})


def run_script(spark: SparkSession, text: str, result: str, **variables) -> DataFrame:
    """Run a SQL script (``BEGIN ... END``) with session variables and return
    the temporary view ``result`` that it creates, lazily: a script's own
    result would pass through the driver, a view's rows do not."""
    set_variables(spark, **variables)
    spark.catalog.dropTempView(result)
    spark.sql(text.strip().rstrip(";"))
    if not spark.catalog.tableExists(result):
        raise ValueError(f"the script makes no view {result!r}")
    return spark.table(result)


def load_sql_file(spark: SparkSession, path: str) -> DataFrame:
    """:func:`load_sql` on the text of a ``.sql`` file."""
    with open(path, encoding="utf-8") as f:
        return load_sql(spark, f.read())


def read_legacy(spark: SparkSession, name_or_path: str) -> DataFrame:
    """The older forecast table (whole-table scan), conformed; pass it to
    ``Pipeline(..., legacy=...)`` for the back-test on real inputs."""
    return schemas.conform(read_table(spark, name_or_path), schemas.LEGACY_FORECAST)
