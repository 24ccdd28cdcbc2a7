"""Benchmark: the batch pipeline and the headline queries at one scale.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_MODELS=0 to leave out model fitting. Prints ONE JSON line.

Each query runs to completion through the ``noop`` sink (every row is produced,
nothing is collected). ``pipeline`` is the cost of building and persisting the
raw flight table, the cleaned/enriched table and the feature table; the queries
then read the persisted tables, as a production run would.

Every query is built and run once cold (JVM JIT and code generation of a new plan
shape; reported under ``cold``). Then it is built afresh and run again, and that
whole time counts: size checks, group tables and other jobs of the build included.
``model_training`` is the fit of the three models; ``value`` is the sum of
``pipeline``, ``model_training`` and all queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contrail.plans import registry, registry_stats  # noqa: E402
from contrail.plans.pipeline import fixture_enriched, fixture_features, fixture_frames  # noqa: E402
from contrail.session import local_session  # noqa: E402

HEADLINE = [
    # descriptive reports
    "executive_snapshot", "airline_performance", "airport_congestion", "monthly_trend", "hourly_trend",
    "route_bottlenecks",
    # cleaning / joins on the raw view
    "clean_times", "valid_airports_only", "enrich_airports",
    # data quality
    "null_profile", "numeric_summary", "code_breakdown", "invalid_airport_codes", "duplicate_report",
    "duplicate_rows", "junk_text_report", "time_format_report",
    # statistics
    "contingency", "chi_square_test", "anova_test", "correlation", "delay_distribution", "stratified_sample",
    # features and prescription
    "tail_utilisation", "origin_congestion", "model_table", "classification_report", "risk_tiers",
    "top_risk_flights",
]
MODELS = ["model_comparison", "feature_importance", "model_classification_report", "delay_scores", "model_top_risk_flights"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus * 2, app="contrail-bench")
    sf = os.path.basename(sf_dir).replace("sf", "")

    # JVM / codegen warm-up on the smallest input, not timed
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and warm != sf_dir:
        run(registry.QUERIES["airline_performance"](spark, warm))

    times: dict[str, float] = {}
    stages: dict[str, float] = {}
    t0 = time.perf_counter()
    fixture_frames(spark, sf_dir)            # raw flight table derived from the driver tables
    stages["source"] = round(time.perf_counter() - t0, 3)
    t = time.perf_counter()
    fixture_enriched(spark, sf_dir, persist=True)          # stage 1: clean + enrich + scalar features
    stages["stage1"] = round(time.perf_counter() - t, 3)
    t = time.perf_counter()
    fixture_features(spark, sf_dir)          # stage 2: per-group counts
    stages["stage2"] = round(time.perf_counter() - t, 3)
    times["pipeline"] = round(time.perf_counter() - t0, 3)

    names = list(HEADLINE)
    if os.environ.get("BENCH_MODELS") != "0":
        t = time.perf_counter()
        registry_stats._trained(spark, sf_dir)
        times["model_training"] = round(time.perf_counter() - t, 3)
        names += MODELS
    cold: dict[str, float] = {}
    for name in names:
        t = time.perf_counter()
        run(registry.QUERIES[name](spark, sf_dir))
        cold[name] = round(time.perf_counter() - t, 3)
        t = time.perf_counter()
        run(registry.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
                      "cpus": cpus, "pipeline_stages": stages, "cold": cold, "cold_total": round(times["pipeline"] + sum(cold.values()), 3)}))


if __name__ == "__main__":
    main()
