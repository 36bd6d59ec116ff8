"""Benchmark: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Each query is executed in full
with the ``noop`` sink (no driver collect) and timed separately.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "demand_array_matrix", "demand_scalar_matrix", "demand_measure_matrix",
    "volume_units_by_location", "volume_rows_by_location", "demand_macro_average",
    "presence_rate", "demand_array_long",
    "words_after_marker_n2", "credits_text_parse",
    "placement_inner_base", "fragment_rest", "derived_fragment_semi", "placement_site_counts",
    "two_stage_extremes", "groups_always_above",
    "class_shares", "pivot_mean_hour", "axis_density",
    "search_matches", "logistic_accuracy", "prequential_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from tessera.plans import catalog
    from tessera.session import build_session, input_bytes, partition_settings

    conf = partition_settings(input_bytes([sf_dir]), int(cpus))
    conf["spark.driver.memory"] = "16g"
    spark = build_session(f"local[{cpus}]", app="tessera-bench", conf=conf)
    # warm-up: JVM, codegen caches, file listing and the first scans of the
    # event and line-item tables (not timed)
    for warm in ("class_counts", "two_stage_extremes"):
        catalog.REGISTRY[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float | None] = {}
    failed: list[str] = []
    for name in names:
        t0 = time.perf_counter()
        try:
            catalog.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep timing the others; report the failure
            times[name] = None
            failed.append(name)
            print(f"# {name} FAILED: {type(exc).__name__}: {exc}", file=sys.stderr, flush=True)
            continue
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    result = {"metric": "headline_queries_total",
              "value": round(sum(t for t in times.values() if t is not None), 3),
              "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
