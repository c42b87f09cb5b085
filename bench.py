"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries": {...}, "sf"}.
Each query is executed in full with the ``noop`` sink (every row is produced, nothing
is collected). ``--all`` runs every registered query; ``--only a,b`` a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_listings", "group_stats", "value_counts_all", "describe_numeric", "dup_count", "dup_rows",
    "missing_counts", "unique_counts", "box_stats", "hist_price", "kde_price", "kde_binned",
    "violin_density", "joint_regression", "pearson", "target_encode", "feature_table",
    "validate_records", "rf_predict",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    args = sys.argv[1:]
    from pricelens.plans.catalog import QUERIES
    from pricelens.session import build_session

    names = HEADLINE
    if "--all" in args:
        names = list(QUERIES)
    if "--only" in args:
        names = args[args.index("--only") + 1].split(",")
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra=extra)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-"))
    # Warm-up: JVM, parquet footers, Python workers.
    QUERIES["scan_listings"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
