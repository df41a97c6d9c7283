"""CSV hand-off files (the forecast written by a run, read back by a back-test)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortcast.schemas import FINAL_FORECAST


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write ``df`` as headed CSV under ``path`` (a folder of part files, one
    per partition; readers take the folder)."""
    (df.write.mode(mode).option("header", True)
     .option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType = FINAL_FORECAST) -> DataFrame:
    """Read a headed CSV with a declared schema (no inference pass)."""
    return (spark.read.option("header", True).option("dateFormat", "yyyy-MM-dd")
            .option("mode", "FAILFAST").schema(schema).csv(path))
