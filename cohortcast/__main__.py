"""Command line: ``python -m cohortcast --out BASE [options]`` runs the forecast,
``python -m cohortcast backtest --forecast CSV --legacy TABLE --out BASE [options]``
back-tests an earlier run's forecast against the actuals.

Reads the inputs (``--tables``: a JSON file that maps each input to a catalog
table or parquet path, or the stand-ins built from a test-data folder with
``--fixture``), and writes the result as CSV below a run-stamped folder of
``BASE``.  Prints the output path.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from cohortcast import FIXTURE, PRODUCTION
from cohortcast.plans.pipeline import BACKTEST_FILE, FORECAST_FILE, Pipeline, backtest, run, run_output_path
from cohortcast.session import build_session


def main(argv: list[str] | None = None) -> str:
    ap = argparse.ArgumentParser(prog="cohortcast", description="Forecast run, or back-test of one.")
    ap.add_argument("command", nargs="?", choices=["forecast", "backtest"], default="forecast")
    ap.add_argument("--out", required=True, help="output base folder (shared storage)")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="date standing in for today")
    ap.add_argument("--tables", help="JSON file: input name -> table name or parquet path")
    ap.add_argument("--columns", help="JSON file: input name -> {column there: column here}")
    ap.add_argument("--fixture", help="build the stand-in inputs from this test-data folder")
    ap.add_argument("--forecast", help="back-test: forecast CSV of an earlier run")
    ap.add_argument("--legacy", help="back-test: table or parquet path of the older forecast")
    ap.add_argument("--buckets", type=int, help="first write the reservation tables with this many buckets, as new catalog tables")
    ap.add_argument("--checkpoint-dir", help="folder that driver and executors share (default: spark.checkpoint.dir)")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    # Generous start: AQE coalesces small partitions, so size for the largest shuffle.
    ap.add_argument("--shuffle-partitions", type=int, default=2000)
    a = ap.parse_args(argv)
    if not a.fixture and not a.tables:
        ap.error("name the inputs: --tables or --fixture")
    if a.command == "backtest" and not (a.forecast and (a.legacy or a.fixture)):
        ap.error("a back-test needs --forecast and --legacy")

    extra = {"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else None
    spark = build_session(a.master, a.shuffle_partitions, extra=extra)
    if a.fixture:
        from cohortcast.sources.fixtures import fixture_sources
        src, params = fixture_sources(spark, a.fixture), FIXTURE
    else:
        from cohortcast.sources.tables import from_catalog
        src, params = from_catalog(spark, _json(a.tables), _json(a.columns)), PRODUCTION
    if a.buckets:
        from cohortcast.sources.layout import bucket_reservations
        src = bucket_reservations(spark, src, a.buckets)
    if a.as_of:
        params = params.with_(as_of=a.as_of)
    out = run_output_path(a.out, file=BACKTEST_FILE if a.command == "backtest" else FORECAST_FILE)
    if a.command == "backtest":
        from cohortcast.sources.csv_io import read_csv
        from cohortcast.sources.tables import read_legacy
        legacy = read_legacy(spark, a.legacy) if a.legacy else Pipeline(src, params).legacy
        backtest(spark, src, read_csv(spark, a.forecast), legacy, params, out=out)
    else:
        run(spark, src, params, out=out)
    print(out)
    return out


def _json(path: str | None) -> dict | None:
    if not path:
        return None
    with open(path, encoding="utf-8") as f:
        return json.load(f)


if __name__ == "__main__":
    main(sys.argv[1:])
