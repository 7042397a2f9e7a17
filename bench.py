"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Each query is
built and run once to the end (``noop`` sink) after a small warm-up job.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tablewarden.plans.registry import QUERIES
from tablewarden.session import RUNTIME_SETTINGS

HEADLINE = """
profile_lineitem profile_orders_by_status infer_types_customer infer_types_events comma_decimal sample_values
read_budget weighted_distribution reported_vs_computed dedup_files software_folders participant_aggregates
even_sample filename_patterns granularity pair_rule batches batch_context merge_answers overlay annotation_status
consistency_checks cm_stats_eval class_metrics per_repo_metrics repo_avg weighted_confusion config_summary
method_accuracy binary_field missingness size_quartiles size_effect winner match_labels second_pass coverage
label_quality health_checks stability run_quality recommend grand_report cross_config repeat_score timing_summary
slowest_k stage_status upsert funnel repo_summary corpus_composition batch_plan strip_markup parse_answer
xml_metadata delimited_cells
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in {
        **RUNTIME_SETTINGS,
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()

    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
