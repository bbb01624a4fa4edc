"""Time registered queries: one JSON line on standard output.

Every query is run to completion into the no-op sink.  The first run of each
warms up code generation and the file cache; the faster of the next two counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from estrato.session import session
from estrato.workload import runnable

# A broad cut: each operator family, on the largest tables it reads.
HEADLINE = (
    "kpi_punctuality",
    "kpi_maintenance",
    "silver_flights",
    "flight_enriched",
    "sales_by_country_sorted",
    "sales_enriched",
    "sales_enriched_hot_keys",
    "clean_customers",
    "clean_claims",
    "dedup_latest",
    "telematics_by_vehicle",
    "prediction_rollup",
    "claim_policy_customer",
    "claim_telematics",
    "claim_decisions",
    "decision_share",
    "top_makes_loss",
    "amount_histogram",
    "amount_center",
    "rule_failures",
    "executive_kpis",
    "null_audit",
    "duplicate_keys",
    "orphan_keys",
    "join_audit",
    "table_counts",
    "profile_columns",
    "correlation_matrix",
    "exact_quartiles",
    "iqr_outliers",
    "zscore_outliers",
    "table_upsert",
    "table_as_of",
    "label_distribution",
    "label_index",
    "split_distribution",
    "standardize_vectors",
    "accuracy_by_class",
)


def seconds(build, spark, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=cpus,
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED", os.path.abspath("spark-warehouse")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    available = runnable()
    times = {}
    for name in names:
        seconds(available[name], spark, folder)
        times[name] = round(min(seconds(available[name], spark, folder) for _ in range(2)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
