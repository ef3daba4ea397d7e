"""Benchmark: the discovery run and its headline queries at one scale factor.

Prints one JSON line. ``value`` is the wall time of a whole run (discovery,
profiling, relationships, semantics, result tables and run record); the
``queries`` are the headline named queries, each run to completion with the
``noop`` sink (nothing collected).

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["discovery_inventory", "column_profiles", "profile_top_values", "value_overlap",
            "relationship_candidates", "semantic_annotations"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cartograph.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2,
                          scratch=tempfile.mkdtemp(prefix="cartograph-bench-"))
    from cartograph import KEY_DISCOVERY, run_pipeline
    from cartograph.plans.queries import QUERIES

    # warm the JVM once on the smallest folder (not timed)
    QUERIES["discovery_inventory"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 2)

    loc = tempfile.mkdtemp(prefix="cartograph-bench-tables-")
    opts = KEY_DISCOVERY.replace(provider="rules", output_schema="cartograph_bench")
    t0 = time.time()
    summary = run_pipeline(spark, sf_dir, opts, table_location=loc)
    total = round(time.time() - t0, 2)
    times["pipeline"] = total
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "discovery_run_wall_time", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "status": summary.get("status"),
                      "phases": summary.get("phase_durations")}))


if __name__ == "__main__":
    main()
