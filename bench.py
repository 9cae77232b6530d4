"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed completely through a ``noop`` sink (no driver collect).
Warm: every query runs once untimed, then the median of $BENCH_REPS timed runs.
"""

from __future__ import annotations

import gc
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workpulse.plans import queries as Q  # noqa: E402
from workpulse.session import build_session  # noqa: E402

HEADLINE = [
    "risk_scores", "attention_flags", "html_text", "comment_rollup", "copy_paste_comments",
    "copy_paste_similarity", "copy_paste_documents", "document_text_stats", "latest_compliant", "gate_branch",
    "rubric_grade", "grader_parse", "snapshot_rows", "snapshot_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="workpulse-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    timings = {}
    for name in names:
        fn = Q.QUERIES[name][0]
        runs = []
        for i in range(reps + 1):
            Q._cache.clear()
            t = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(runs), 3)
        # Measure each query on its own: drop the previous query's DataFrames (and their checkpoints).
        Q._cache.clear()
        gc.collect()
        spark.catalog.clearCache()
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
