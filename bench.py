"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_ONLY (comma-separated query names, optional).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lagline.queries import load_all  # noqa: E402
from lagline.session import local_session  # noqa: E402

HEADLINE = [
    "late_share_by_priority",
    "s1_delimited_scan",
    "s3_prepared_scan",
    "p5_late_label",
    "d2_date_parts",
    "c1_distinct_rows",
    "c2_duplicate_count",
    "c3_null_counts",
    "c8_iqr_limits",
    "c9_outlier_summary",
    "c10_capped_values",
    "c11_rare_to_other",
    "a1_describe_numeric",
    "a6_distinct_counts",
    "a8_value_counts",
    "a10_histogram",
    "a11_box_summary",
    "a12_contingency_with_margins",
    "a15_chi_square",
    "a16_correlation_matrix",
    "f1_one_hot",
    "f3_standardised",
    "f7_stratified_split",
    "l1_knn_euclidean_uniform",
    "l1_knn_manhattan_distance",
    "l1_knn_order_lines",
    "l5_folds_of_three",
    "l6_knn_grid_scores",
    "m1_confusion_counts",
    "m4_roc_auc",
    "m9_roc_curve",
    "m12_calibration_curve",
    "m15_comparison_table",
    "m16_best_by_metric",
    "f10_whole_preparation",
    "l2_logistic_regression",
    "l4_boosted_trees",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{seconds[name]:8.2f} {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
