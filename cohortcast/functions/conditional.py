"""Conditional and null-handling expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortcast import params as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never inf or an error)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def paid_day_flag(is_ever_booked="is_ever_booked", status="current_status",
                  excluded=P.EXCLUDED_STATUS) -> Column:
    """1 for a booked reservation whose status is not excluded, else 0.
    A NULL status makes NOT IN unknown, which falls to 0."""
    ok = (_c(is_ever_booked) == 1) & ~_c(status).isin(*excluded)
    return F.when(ok, F.lit(1)).otherwise(F.lit(0))


def regroup_channel(country="country", channel="channel_lvl_5",
                    regroups=P.CHANNEL_REGROUPS) -> Column:
    """First-match channel relabelling by (country, label list)."""
    out = None
    for ctry, labels, new in regroups:
        cond = (_c(country) == ctry) & _c(channel).isin(*labels)
        out = F.when(cond, F.lit(new)) if out is None else out.when(cond, F.lit(new))
    return _c(channel) if out is None else out.otherwise(_c(channel))


def risk_band(created="created", score="risk_score", cutover: dt.datetime = P.PRODUCTION_RISK_CUTOVER,
              bands=P.RISK_BANDS) -> Column:
    """Risk band of a reservation from its score.

    Before the cut-over a band's bound is exclusive, from it on inclusive; the
    last band takes the rest.  A NULL score or NULL ``created`` gives 'NA'.
    """
    ts = _c(created).cast("timestamp_ntz")
    # From text, so the wall-clock cut-over does not depend on any time zone.
    cut = F.lit(cutover.isoformat(sep=" ")).cast("timestamp_ntz")
    before, after = ts < cut, ts >= cut
    s = _c(score)
    out = None
    for band, lo_regime_bound, hi_regime_bound in bands:
        if lo_regime_bound is None:
            cond = (before | after) & s.isNotNull()
        else:
            cond = (before & (s < lo_regime_bound)) | (after & (s <= hi_regime_bound))
        out = F.when(cond, F.lit(band)) if out is None else out.when(cond, F.lit(band))
    return out.otherwise(F.lit(P.RISK_BAND_MISSING))
