"""Wall time of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` picks the tables (default sf0.1), ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` a comma-separated list or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "platform_rollup", "visible_text", "screen_documents", "all_matches", "taxon_catalogue", "dominant_value", "top_k_fold", "systematic_sample", "last_state", "feature_facts",
    "sniff_tables", "long_rows", "safe_pivot", "duplicate_report", "relative_abundance", "detection_matrix", "interval_coverage", "error_profile", "primer_regions", "exclusive_quantiles", "retention_track", "filter_tree",
]


def main() -> None:
    from taxaloom.plans import registered
    from taxaloom.operators.ordering import drop_stored
    from taxaloom.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries, _ = registered()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries["filter_tree"](spark, folder).count()  # starts the engine; not timed
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        # the whole result is computed and thrown away, nothing travels to the driver
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        drop_stored(spark)
    spark.stop()
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
