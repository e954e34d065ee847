"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries" {name: sec}, "sf"}.
Each query is executed in full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sylva.plans.queries import QUERIES  # noqa: E402
from sylva.session import drop_tables, get_spark  # noqa: E402

HEADLINE = [
    "error_lines",        # flagship: pairs -> both trees -> signatures -> anti-join
    "root_paths",         # tree walk
    "branches",           # path-contexts
    "vocabulary",         # global vocabulary aggregate
    "corpus_lines",       # per-document export lines
    "signature_groups",   # all-document signatures
    "label_lines",        # diff + label file rows
    "train_val_split",    # preprocess chain
    "text_lines",         # listings
    "html_nodes",         # parse job
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(app="sylva-bench", extra={"spark.ui.showConsoleProgress": "false"})
    # warm-up on the smallest scale (not the measured data): JVM code paths of the
    # tree walk, parquet readers, Python workers of the parse job
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("error_lines", "html_nodes"):
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    QUERIES["submissions_scan"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        drop_tables(spark)  # tables between the walk's rounds
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
