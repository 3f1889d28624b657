"""Print a one-line physical-plan summary (or the full plan) of every catalogue query.

    python tools/explain_all.py [sf_dir] [--full]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickstream.plans.catalog import QUERIES  # noqa: E402
from clickstream.session import build_session  # noqa: E402

WATCH = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "WindowGroupLimit", "Window", "Generate", "HashAggregate", "FlatMapGroupsInPandas",
         "MapInPandas", "FlatMapCoGroupsInPandas", "Scan parquet"]


def main(argv):
    sf_dir = next((a for a in argv[1:] if os.path.isdir(a)), "/root/testdata/sf0.01")
    full = "--full" in argv
    spark = build_session("local[8]", 8)
    for name, q in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, sf_dir).explain("formatted")
        plan = buf.getvalue()
        if full:
            print(f"===== {name}\n{plan}")
            continue
        tree = plan.split("\n\n")[0]
        counts = {w: len(re.findall(rf"[-+] {re.escape(w)} \(|^{re.escape(w)} \(", tree, re.M)) for w in WATCH}
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)))
        print(f"{name:26s} " + " ".join(f"{k}={v}" for k, v in counts.items() if v) + f" | read {schemas}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
