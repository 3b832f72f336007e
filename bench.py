"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is materialised with the ``noop`` sink (full computation, no
driver collect).  Before timing, every headline query runs once on the
smallest scale factor ($BENCH_WARMUP_DIR, default sf0.001; other input
files) so that JVM class loading and code generation are not timed; set
BENCH_WARMUP_DIR= (empty) for cold timings.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shroud.plans.catalog import QUERIES  # noqa: E402
from shroud.session import local_session, release_kept  # noqa: E402

HEADLINE = [
    "load_source", "pseudonymize", "utility_matrix", "table_entropy", "roll_up_rare",
    "generalize_numeric", "k_anonymity", "k_anonymity_path", "iter_k_check", "flag_k",
    "l_diversity", "l_diversity_docs", "course_combos", "flag_unique_users",
    "best_drop_single", "best_drop_multi", "user_k_anonymity_multi", "anonymize",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="shroud-bench",
                          checkpoint_dir=os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="shroud-bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001").rstrip("/")
    if warm_dir and os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        QUERIES["total_records"](spark, sf_dir).collect()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_kept(spark)
    sf = os.path.basename(sf_dir).replace("sf", "")
    metric = "headline_queries_warm_total" if warm_dir else "headline_queries_total"
    print(json.dumps({"metric": metric, "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
