"""Run parameters.

Every constant the original scripts hard-code is a field here, so the same
operators run on the production values (``PRODUCTION``) and on the stand-in
data built from the driver's TPC-H-like tables (``FIXTURE``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for identical results).
# ---------------------------------------------------------------------------
# Attribution source: only this country, drop this channel label.
PRODUCTION_COUNTRY = "US"
UNKNOWN_CHANNEL = "Unknown"
# AU channel regrouping, first match wins: (country, source labels, new label).
CHANNEL_REGROUPS = (
    ("AU", ("Google_Desktop", "Google_Mobile"), "Google"),
    ("AU", ("Google_Desktop_Brand", "Google_Mobile_Brand"), "Google_Brand"),
)
# Warehouse sign-ups override attribution only for this channel.
PRODUCTION_OVERRIDE_CHANNEL = "Apple_Brand"
# Source priorities: override rows beat attribution rows.
OVERRIDE_PICK_RANK = 1
ATTRIBUTION_PICK_RANK = 2
# A paid day needs is_ever_booked = 1 and a status outside this set.
EXCLUDED_STATUS = (2, 11)
# Cohort age bucket width in days, trailing window in months, horizon.
INCREMENT_DAYS = 30
WINDOW_MONTHS = 12
MAX_INCREMENT = 12
# First forecast month of the spine.
PRODUCTION_SINCE = dt.date(2022, 1, 1)
# Budget ledger metric names and the revenue category to leave out.
NET_REVENUE_METRIC = "Net Revenue (USD $)"
TRIP_DAYS_METRIC = "GAAP Days (#)"
EXCLUDED_REVENUE_CATEGORY = "Other Transaction Revenue"
# Forecast snapshots read by the pipeline.
PRODUCTION_SCENARIOS = (
    "Sep-23 Forecast (8+4)",
    "Oct-23 BOD Forecast (9+3)",
    "Feb-24 BOD Forecast (1+11)",
    "Mar-24 Forecast (2+11)",
    "May-24 BOD Forecast (3+9)",
    "May-24 Forecast (4+8)",
    "Jun-24 Forecast (5+7)",
    "Aug-24 BOD Forecast (6+6)",
    "Sep-24 Forecast (8+4)",
)
# Channels kept in the back-test.
PRODUCTION_PAYBACK_CHANNELS = (
    "Apple", "Google_Desktop", "Google_Desktop_Brand", "Google_Discovery",
    "Google_Mobile", "Google_Mobile_Brand", "Google_UAC_Android", "Kayak_Desktop",
    "Kayak_Desktop_Core", "Kayak_Mobile_Core", "Mediaalpha", "Expedia", "Microsoft_Desktop",
    "Microsoft_Desktop_Brand", "Microsoft_Mobile", "Microsoft_Mobile_Brand", "Kayak_Desktop_Front_Door",
    "Kayak_Desktop_Compare", "Google_Pmax", "Kayak_Desktop_Carousel", "Kayak_Mobile_Carousel",
    "Kayak_Mobile", "Kayak_Afterclick", "Facebook/IG_App", "Facebook/IG_Web",
)
# Risk band cut-over and thresholds: (band, upper bound before the cut-over
# (exclusive), upper bound from the cut-over on (inclusive)); None = no bound.
PRODUCTION_RISK_CUTOVER = dt.datetime(2023, 4, 19, 18, 28, 0)
RISK_BANDS = (
    ("A1", 0.01, 0.0045),
    ("A2", 0.02, 0.009),
    ("A3", 0.03, 0.0135),
    ("B", 0.06, 0.0315),
    ("C", 0.09, 0.05),
    ("D", 0.12, 0.07),
    ("E", 0.18, 0.10),
    ("F", None, None),
)
RISK_BAND_MISSING = "NA"
# Back-test chart series: (weighted column, label).
ACCURACY_SERIES = (
    ("w_rate_new", "New forecast"),
    ("w_rate_old", "Old forecast"),
    ("w_rate_actual", "Actual rate"),
)


@dataclass(frozen=True)
class Params:
    """Knobs of one run.  ``as_of`` replaces the scripts' CURRENT_DATE."""

    country: str = PRODUCTION_COUNTRY
    override_channel: str = PRODUCTION_OVERRIDE_CHANNEL
    since: dt.date = PRODUCTION_SINCE
    as_of: dt.date | None = None
    window_months: int = WINDOW_MONTHS
    max_increment: int = MAX_INCREMENT
    increment_days: int = INCREMENT_DAYS
    excluded_status: tuple[int, ...] = EXCLUDED_STATUS
    scenarios: tuple[str, ...] = PRODUCTION_SCENARIOS
    payback_channels: tuple[str, ...] = PRODUCTION_PAYBACK_CHANNELS
    risk_cutover: dt.datetime = PRODUCTION_RISK_CUTOVER
    # 'first': base increment is the first non-null index in increment order
    # (what the original computes); an int picks that increment instead.
    ratio_base: str | int = "first"
    # A driver with more reservations than this is spread over
    # ceil(rows / hot_key_rows) join tasks.
    hot_key_rows: int = 1_000_000

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


PRODUCTION = Params()

# Parameters for the stand-in data derived from the driver's tables.
FIXTURE_SCENARIOS = (
    "Feb-96 BOD Forecast (1+11)",
    "May-96 Forecast (4+8)",
    "Sep-96 Forecast (8+4)",
    "Feb-97 BOD Forecast (1+11)",
    "Mar-95 BOD Forecast (2+10)",
)
FIXTURE = Params(
    country="US",
    override_channel="1-URGENT",
    since=dt.date(1996, 1, 1),
    as_of=dt.date(2001, 10, 1),
    scenarios=FIXTURE_SCENARIOS,
    payback_channels=("BUILDING", "HOUSEHOLD", "1-URGENT"),
    risk_cutover=dt.datetime(1998, 6, 15, 18, 28, 0),
)
