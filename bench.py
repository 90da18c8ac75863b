"""Time the headline queries: one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cohort_filter_ledger",
    "ledger_sum_by_group",
    "item_history_lags",
    "delta_relative",
    "product_total_leads",
    "pivot_items",
    "pnl_features",
    "pnl_dataset",
    "profile_fit",
    "profile_transform",
    "feature_dataset",
    "scoring_features",
    "score_quantile_bins",
    "calibration_fit",
    "classification_metrics",
    "total_prediction",
    "metrics_report",
]


def stage_sources(spark, sf_dir, fx, staged, stage_path) -> None:
    """The ledger and the profile are source tables: build them from the order tables once, timed."""
    ledger = staged(fx.raw_ledger(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism), stage_path(spark, "ledger"))
    profile = staged(fx.raw_profile(spark, sf_dir), stage_path(spark, "profile"))
    fx.raw_ledger = lambda spark, sf_dir: ledger
    fx.raw_profile = lambda spark, sf_dir: profile


def main() -> None:
    from ledgercast.plans import fixtures as fx
    from ledgercast.plans.catalog import QUERIES
    from ledgercast.session import build_session, stage_path
    from ledgercast.sources.stages import staged

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    start = time.time()
    stage_sources(spark, sf_dir, fx, staged, stage_path)
    seconds["stage_ledger_and_profile"] = round(time.time() - start, 3)
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
