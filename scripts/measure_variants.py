"""Time the literal plans against the rewritten ones and record shuffle volume.

Usage: ``python scripts/measure_variants.py [sf_dir] [runs]``.  Writes an event
log to a fresh scratch folder and reports, per variant, the median wall time
(noop sink) and the shuffle bytes written by its last run.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import zstandard  # noqa: E402

import bench  # noqa: E402
from cohortcast.operators import trailing  # noqa: E402
from cohortcast.plans.queries import build, pipeline  # noqa: E402
from cohortcast.session import build_session  # noqa: E402


def _events(d):
    for f in sorted(glob.glob(f"{d}/*/events*")):
        raw = open(f, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if f.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    log_dir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.driver.memory": "8g"})
    variants = {
        "trip_day_facts/literal range join": lambda: bench._literal_days(spark, sf_dir),
        "trip_day_facts/guarded explode": lambda: build("trip_day_facts", spark, sf_dir),
        "trailing_increment/literal theta join": lambda: bench._literal_trailing(spark, sf_dir),
        "trailing_increment/fan-out of day cube": lambda: trailing.increment_sums(
            pipeline(spark, sf_dir, cube_method="days").spine,
            pipeline(spark, sf_dir, cube_method="days", materialize=False).cube),
        "trailing_increment/fan-out of bucket cube": lambda: build("trailing_increment", spark, sf_dir),
        "final_forecast/end to end": lambda: build("final_forecast", spark, sf_dir),
    }
    marks = {}
    for name, make in variants.items():
        bench._run(make())
        ts = []
        for _ in range(runs):
            t = time.perf_counter()
            spark.sparkContext.setJobDescription(name)
            bench._run(make())
            ts.append(time.perf_counter() - t)
        marks[name] = statistics.median(ts)
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    # shuffle bytes of the last run of each variant, from the job descriptions
    job_desc, stage_job, shuffle, last_job = {}, {}, {}, {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description")
            job_desc[e["Job ID"]] = desc
            for s in e.get("Stage IDs", []):
                stage_job[s] = e["Job ID"]
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            w = sum(a.get("Value", 0) for a in si.get("Accumulables", [])
                    if a.get("Name") == "internal.metrics.shuffle.write.bytesWritten")
            shuffle[si["Stage ID"]] = w
    per_desc: dict[str, list[int]] = {}
    for s, w in shuffle.items():
        d = job_desc.get(stage_job.get(s))
        if d:
            per_desc.setdefault(d, []).append(w)
    out = {}
    for name, sec in marks.items():
        tot = sum(per_desc.get(name, [])) / runs
        out[name] = {"sec": round(sec, 3), "shuffle_bytes_per_run": int(tot),
                     "peak_stage_shuffle_bytes": max(per_desc.get(name, [0]))}
    print(json.dumps({"sf_dir": sf_dir, "runs": runs, "variants": out}, indent=1))


if __name__ == "__main__":
    main()
