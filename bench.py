"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabmill.catalog import QUERIES  # noqa: E402
from tabmill.runtime import build_session  # noqa: E402

HEADLINE = [
    "c01_key_semi_join",
    "c01_filter_folder_by_keys",
    "c02_leak_anti_join",
    "c04_d04_dup_counts",
    "c05_c06_lookup_counts",
    "d01_dedup_first",
    "d03_distinct_features",
    "d05_l10_key_summary",
    "d08_d09_null_profile",
    "d15_group_statistics",
    "d16_d17_quantiles",
    "f03_fill_group_mode",
    "f04_fill_group_median",
    "f05_fill_group_mean",
    "f06_fill_typed",
    "f11_train_fill",
    "g01_document_keys",
    "g10_g12_b14_dict_expand",
    "g13_list_expand",
    "h02_h03_h04_date_parts",
    "i06_i07_segments",
    "i08_i09_ratios_scores",
    "i11_indices",
    "i14_expanded_features",
    "j01_clip_quantile",
    "j02_winsorise",
    "j03_bins_width",
    "j04_bins_quantile",
    "j05_standardise",
    "j06_freq_encode",
    "j07_onehot_encode",
    "j10_label_encode",
    "k02_pca",
    "k04_split_stratified",
    "k04_split_stratified_exact",
    "k05_k12_a10_a11_linear_regression",
    "k05_k13_model_compare_small",
    "k08_k10_k11_k20_model_compare_large",
    "k11_leafwise_trees",
    "k20_symmetric_trees",
    "k18_l14_score_batch",
    "k19_feature_job",
    "l02_l03_metrics",
    "l05_range_r2",
    "l09_error_histogram",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
