"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, forcing the full result through the ``noop`` sink;
per query the median of ``$BENCH_RUNS`` timed runs after one warm-up.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = ["latest_per_key", "exact_dedupe", "scd2_merge", "scd2_dim_load", "load_sales_stage",
            "load_fact", "flag_latest", "derive_end_date", "assign_surrogate_keys",
            "pipeline_two_batches"]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from histdim.plans.queries import QUERIES
    from histdim.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE)]
    spark = build_session(f"local[{cpus}]", app="histdim-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.ui.enabled": "false",
                                 "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")

    def once(name):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    out = {}
    for name in names:
        once(name)                               # warm-up
        out[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"# {name}: {out[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "runs": runs, "cpus": cpus}))


if __name__ == "__main__":
    main()
