"""Benchmark: run every catalogue query over the tables at $BENCH_SF_DIR.

Each query is executed in full with a ``noop`` write (no collect to the driver),
twice; the second (warm) run is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickstream.plans.catalog import QUERIES  # noqa: E402
from clickstream.session import build_session, drop_scratch  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(f"local[{cpus}]", int(cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-scratch-")})
    times = {}
    for name in names:
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            _run(QUERIES[name](spark, sf_dir))
            best = time.perf_counter() - t0
            drop_scratch(spark)
        times[name] = round(best, 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "catalogue_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
