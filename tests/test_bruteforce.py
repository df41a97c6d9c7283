"""Brute force on the smallest fixture: recompute the index and forecast steps
with pandas (row-wise frames, written independently of the Spark operators)
from the Spark rates and snapshots, and compare with the Spark forecast."""

import math

import pandas as pd

from cohortcast.plans.queries import pipeline
from conftest import SF_SMALL


def _div(a, b):
    return None if a is None or b is None or (isinstance(b, float) and math.isnan(b)) or b == 0 \
        or (isinstance(a, float) and math.isnan(a)) else a / b


def _pandas_forecast(channel: pd.DataFrame, increment: pd.DataFrame, fc: pd.DataFrame) -> pd.DataFrame:
    inc = increment[increment["increments_from_signup"] <= 12].copy()
    inc["increment_index"] = [_div(a, b) for a, b in zip(inc["nrpd_increment"], inc["nrpd_all"])]
    inc = inc.sort_values(["forecast_month", "increments_from_signup"])
    base = {}
    for fm, grp in inc.groupby("forecast_month"):
        vals = [v for v in grp["increment_index"] if v is not None and not math.isnan(v)]
        base[fm] = vals[0] if vals else None
    inc["ratio"] = [_div(v, base[fm]) for v, fm in zip(inc["increment_index"], inc["forecast_month"])]
    ch = channel.copy()
    ch["channel_index"] = [_div(a, b) for a, b in zip(ch["nrpd_channel"], ch["nrpd_all"])]
    rows = []
    for _, f in fc[fc["increments_from_signup"] <= 12].iterrows():
        matches = []
        for _, c in ch[ch["forecast_month"] == f["forecast_month"]].iterrows():
            for _, r in inc[(inc["forecast_month"] == c["forecast_month"])
                            & (inc["increments_from_signup"] == f["increments_from_signup"])].iterrows():
                ci, ra = c["channel_index"], r["ratio"]
                fi = None if ci is None or ra is None or pd.isna(ci) or pd.isna(ra) else ci * ra
                matches.append((c["channels"], fi, c["data_volume"]))
        for channels, fi, vol in matches or [(None, None, None)]:
            out = None if fi is None or pd.isna(f["nrpd"]) else f["nrpd"] * fi
            rows.append((f["scenario"], f["forecast_month"], f["month"], f["increments_from_signup"],
                         channels, fi, vol, out))
    return pd.DataFrame(rows, columns=["scenario", "forecast_month", "month", "increments_from_signup",
                                       "channels", "final_index", "data_volume", "forecast"])


def _key(t):
    return tuple("" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v) for v in t[:5])


def test_forecast_matches_pandas_brute_force(spark):
    p = pipeline(spark, SF_SMALL)
    ch = p.channel_rates.toPandas()
    inc = p.increment_rates.toPandas()
    fc = p.forecast_only.toPandas()
    expected = _pandas_forecast(ch, inc, fc)
    got = p.final_forecast.toPandas()
    assert len(got) == len(expected) == 180
    e = sorted(expected.itertuples(index=False, name=None), key=_key)
    g = sorted(got[["scenario", "forecast_month", "month", "increments_from_signup", "channels",
                    "final_index", "data_volume", "forecast_nrpd_by_incre_channel"]]
               .itertuples(index=False, name=None), key=_key)
    for a, b in zip(e, g):
        assert _key(a) == _key(b)
        for x, y in zip(a[5:], b[5:]):
            if x is None or (isinstance(x, float) and math.isnan(x)):
                assert y is None or (isinstance(y, float) and math.isnan(y))
            else:
                assert abs(x - y) <= 1e-9 * max(1.0, abs(x))
