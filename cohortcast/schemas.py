"""Declared schemas of the pipeline's inputs and outputs.

Inputs are conformed to these types once at the source boundary, so no
operator depends on what a reader happened to infer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
DATE, TS = T.DateType(), T.TimestampNTZType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ATTRIBUTION = _st(("driver_id", L), ("signup_date", DATE), ("signup_month", DATE),
                  ("country", S), ("channel_lvl_5", S), ("platform", S))
SESSION_FACT = _st(("session_key", L), ("session_date_pdt", DATE), ("source_location_key", L),
                   ("channel_key", L), ("platform", S))
DATE_DIM = _st(("date", DATE))
LOCATION_DIM = _st(("location_key", L), ("country_code", S))
CHANNEL_DIM = _st(("channel_key", L), ("channel_name", S))
CONVERSION_MART = _st(("session_key", L), ("driver_key", L), ("rank_desc_paid_90_days", I))
DRIVER_DIM = _st(("driver_key", L), ("driver_id", L))
RES_PROFIT = _st(("reservation_id", L), ("gaap_net_revenue", D))
RES_SUMMARY = _st(("reservation_id", L), ("driver_id", L), ("is_ever_booked", I),
                  ("current_status", I), ("trip_start_ts", TS), ("current_start_ts", TS))
RES_DIM = _st(("reservation_id", L), ("created", TS), ("risk_score", D),
              ("current_start_ts", TS), ("paid_days", D))
CALENDAR = _st(("date", DATE))
LEDGER = _st(("scenario", S), ("month", S), ("country", S), ("metric", S),
             ("revenue_category", S), ("value", D), ("modified_at", TS))
LEGACY_FORECAST = _st(("channels", S), ("signup_month", DATE),
                      ("increments_from_signup", L), ("net_revenue_per_paid_day", D))

# The forecast hand-off file (one row per scenario, month and channel).
FINAL_FORECAST = _st(("scenario", S), ("forecast_month", DATE), ("month", DATE),
                     ("increments_from_signup", L), ("channels", S), ("nrpd", D),
                     ("final_index", D), ("data_volume", D),
                     ("forecast_nrpd_by_incre_channel", D))

# The back-test's weighted table.
WEIGHTED_ACCURACY = _st(("scenario", S), ("forecast_month", DATE), ("channels", S), ("w_rate_new", D),
                        ("w_rate_old", D), ("w_rate_actual", D), ("data_volume_actual", D))

INPUTS = {
    "attribution": ATTRIBUTION,
    "session_fact": SESSION_FACT,
    "date_dim": DATE_DIM,
    "location_dim": LOCATION_DIM,
    "channel_dim": CHANNEL_DIM,
    "conversion_mart": CONVERSION_MART,
    "driver_dim": DRIVER_DIM,
    "res_profit": RES_PROFIT,
    "res_summary": RES_SUMMARY,
    "res_dim": RES_DIM,
    "calendar": CALENDAR,
    "ledger": LEDGER,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: keep the declared columns, in order, cast."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
