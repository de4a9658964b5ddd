"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query is run to completion with the ``noop`` sink (whole plan executed,
nothing collected). One untimed pass over the same queries comes first, so
the timed passes measure steady state (JIT-compiled generated code, warm
caches) as a long-running job sees it, not JVM start-up; ``BENCH_WARMUP=0``
skips it. Then ``BENCH_ROUNDS`` (default 3) timed passes, and after all of
them the whole pipeline (one untimed run, then the same number of timed
runs); each entry is the median of its rounds (single samples varied by up to 50 % between
runs, as HotSpot compiles generated code in background threads). Prints one
JSON line: {"metric", "value" (sum of the per-query medians), "unit",
"queries", "sf"}. ``BENCH_QUERIES=a,b`` runs a subset; ``BENCH_EVENT_LOG_DIR``
writes Spark's event log there (per-stage and per-task times).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "raw_matches", "silver_matches", "team_match_rows", "team_season_table", "league_season_summary",
    "league_table_ranked", "champions", "matches_enriched", "schema_drift_union", "landing_results",
    "partition_roundtrip", "landing_to_silver", "catalog_views", "match_features", "outcome_model",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from touchline.session import build_session
    from touchline.plans.jobs import run_all
    from touchline.params import RunParams
    from touchline.plans.queries import REGISTRY, _landed_run
    from touchline.session import scratch_path

    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # stage/task times without the UI
    # local mode runs every executor thread in this one JVM: size its heap
    # (PySpark's default is 1 GB for all eight task threads)
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")}
    if event_dir:
        os.makedirs(event_dir, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", app_name="touchline-bench", shuffle_partitions=int(cpus) * 2,
                          extra_conf=extra)

    def pipeline() -> float:
        """Whole pipeline over landed CSV files: land -> bronze -> silver -> gold -> catalog."""
        run_root, run_id = _landed_run(spark, sf_dir)
        landing_root = run_root[: -len(f"/_runs/{run_id}")]
        params = RunParams(lake_root=scratch_path(spark, "bench-lake"), landing_root=landing_root,
                           start_year=1990, end_year=2005)
        spark.sparkContext.setJobDescription("pipeline_run_all")
        t0 = time.perf_counter()
        run_all(spark, params, run_id, with_model=False)
        return round(time.perf_counter() - t0, 3)

    def run(name: str) -> float:
        spark.sparkContext.setJobDescription(name)  # names the jobs in the event log
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    names = only or HEADLINE
    warm = os.environ.get("BENCH_WARMUP", "1") != "0"
    rounds = max(1, int(os.environ.get("BENCH_ROUNDS", "3")))
    samples: dict[str, list[float]] = {}
    # the queries first, then the pipeline: the pipeline runs the same parse
    # code over another input layout, and interleaving it slowed the next
    # queries by up to 2x in this one shared JVM (measured), an effect of
    # local mode that separate cluster jobs do not share
    for name in names if warm else ():
        run(name)
    for _ in range(rounds):
        for name in names:
            samples.setdefault(name, []).append(run(name))
    if not only:
        if warm:
            pipeline()
        samples["pipeline_run_all"] = [pipeline() for _ in range(rounds)]
    timings = {name: statistics.median(times) for name, times in samples.items()}

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf.group(1)) if sf else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
