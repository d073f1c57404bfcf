"""Benchmark the headline jobs and print one JSON line.

Jobs (same work as the reference's published runs, on the benchmark tables):
  features     T18: sources -> cleaned -> integrated -> 49-column feature table,
               written once (staged) like the original's feature CSV
  backtest     T4: seasonal-naive validation metrics for every series
  rolling      T5: rolling-origin validation over every series
  submission   T6: seasonal-naive predictions for every test id

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="shelfcast-bench",
                          shuffle_partitions=max(8, 2 * cpus), driver_memory="8g")
    from shelfcast.operators import forecast
    from shelfcast.plans.pipeline import TEST_START, VAL_START, pipeline_for

    timings: dict[str, float] = {}
    rows: dict[str, int] = {}

    t = time.time()
    p = pipeline_for(spark, sf_dir)
    rows["features"] = p.features.count()
    timings["features"] = time.time() - t

    jobs = {
        "backtest": lambda: forecast.baseline_backtest(p.features, VAL_START, TEST_START),
        "rolling": lambda: forecast.rolling_validation(p.features),
        "submission": lambda: forecast.submission(p.features, p.cleaned.test),
    }
    for name, build in jobs.items():
        t = time.time()
        rows[name] = len(build().collect())
        timings[name] = time.time() - t

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_jobs_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
