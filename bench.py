"""Wall time of the headline queries; prints one JSON line.

The layers are built first, each timed under its own ``layer_*`` name (raw rows, clean rows,
dimensions, fact, features); the queries then read the written layers, as the jobs do. Every
query result is written to the ``noop`` sink, so all of its rows and columns are computed and
nothing is collected. Each timing is one cold run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lakeops.plans.layers import layers
from lakeops.queries import catalogue
from lakeops.queries.modelling import encoded_layer
from lakeops.session import get_spark, pin_semantics

HEADLINE = (
    # raw layer
    "clean_strings", "parse_timestamps", "table_footprint", "null_blank_profile", "distinct_profile",
    "duplicate_summary", "duplicate_sample", "frequency_product", "date_range_profile", "case_fragmentation",
    "unparseable_counts", "suspicious_pattern", "missing_by_group", "id_preservation",
    # clean layer and star schema
    "dedupe_latest", "silver_scorecard", "silver_gate", "build_date_dim", "build_dim_product", "build_dim_company",
    "ordered_key", "lookup_key_nullsafe", "build_fact", "denormalise", "orphan_counts", "top_products",
    "volume_by_state", "gold_scorecard", "gold_gate",
    # features and encoding
    "feature_table", "feature_gate", "correlation_matrix", "rate_by_group", "class_weight", "target_encode_fit",
    "target_encode_apply", "target_encode_oof", "stratified_halves",
    # curves and serving
    "pr_curve", "threshold_for_recall", "average_precision", "roc_auc", "binary_metrics", "reliability_bins",
    "score_requests", "drift_check",
    # files
    "read_raw_csv", "write_snapshot", "unpack_archives",
    # models
    "select_features", "fit_tree", "fit_forest", "fit_gbt", "tune", "platt_calibrate", "predictions_table", "model_metrics",
    "calibration_reliability", "promote_champion", "score_with_champion",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = pin_semantics(
        get_spark("lakeops-bench", master=f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus})
    )
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM and code generation start-up
    built = layers(spark, sf_dir)
    times = {
        "layer_raw": timed(lambda: built.bronze),
        "layer_clean": timed(lambda: built.silver),
        "layer_dimensions": timed(lambda: built.dims),
        "layer_fact": timed(lambda: built.fact),
        "layer_features": timed(lambda: built.features("md5")),
        "layer_encoded": timed(lambda: encoded_layer(built)),
    }
    queries = catalogue.queries()
    for name in names:
        times[name] = timed(lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total wall time of the layers and headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
