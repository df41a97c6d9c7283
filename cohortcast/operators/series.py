"""Chart data series (the data behind the original plots; no drawing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortcast import params as P
from cohortcast.functions.columns import sort_nulls_last


def chart_seasonality(ratios: DataFrame) -> DataFrame:
    """One line per increment: increment index by forecast month."""
    return sort_nulls_last(ratios.select("increments_from_signup", "forecast_month", "increment_index"),
                           "increments_from_signup", "forecast_month")


def chart_accuracy(weighted: DataFrame) -> DataFrame:
    """Long table of the weighted series per channel, with the actual volume."""
    label = None
    for metric, text in P.ACCURACY_SERIES:
        cond = F.col("metric") == metric
        label = F.when(cond, F.lit(text)) if label is None else label.when(cond, F.lit(text))
    long = (weighted.unpivot(["scenario", "forecast_month", "channels", "data_volume_actual"],
                             [m for m, _ in P.ACCURACY_SERIES], "metric", "value")
            .withColumn("label", label))
    return sort_nulls_last(long, "channels", "forecast_month", "scenario", "metric")
