"""Time the headline jobs on one machine and print one JSON line.

Inputs at rest (documents and raw rows) are prepared first and not counted.
The three whole-pipeline jobs run against a fresh table store; the single
operators and reports read tables at rest, as they do in production.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.plans import checks, loading, staging, store  # noqa: E402
from ledgerloom.session import fresh_path, local_session  # noqa: E402
from workloads import queries as registered  # noqa: E402
from workloads.truth import AS_OF, AS_OF_2, BATCH  # noqa: E402
from workloads.warehouse import warehouse  # noqa: E402

OPERATORS = [
    "stage_client_a_transactions", "stage_client_a_items", "stage_client_c_transactions", "stage_client_c_items",
    "stage_customers", "stage_orders", "stage_products", "stage_payments", "unify_transactions",
    "load_dim_customer", "load_dim_product", "scd2_apply", "assign_surrogate_keys", "keep_first",
    "load_fact_transaction_client_a", "load_fact_transaction_client_c", "load_fact_transaction_item",
    "update_transaction_aggregates", "load_fact_order", "load_fact_payment",
    "detect_duplicate_transactions", "log_issues_client_a", "log_issues_client_c", "detect_amount_mismatches",
    "calculate_dq_metrics", "apply_validation_rules", "quarantine_rejects",
    "report_issue_summary", "report_duplicate_summary", "report_transaction_quality", "report_anomaly_detail",
    "report_file_quality", "report_batch_quality", "report_issue_trend", "report_customer_quality", "report_reconciliation",
    # from files: parsing, row numbers, ids, two whole runs
    "capture_file_metadata", "read_csv_orders", "read_xml_documents", "read_json_documents", "run_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    spark = local_session(cpus, shuffle_partitions=cpus, app="bench")
    times: dict[str, float] = {}

    def timed(name: str, job):
        started = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    w = warehouse(spark, sf_dir)
    raw = registered._staging_inputs(w)
    tables = store.TableStore(spark, fresh_path(spark, "bench-store"))
    staged = timed("materialize_staging", lambda: staging.materialize_staging(tables, raw))
    loading.create_dimensions(tables, AS_OF, "1995-01-01", "2002-12-31")
    timed("load_all", lambda: loading.load_all(tables, staged, AS_OF))
    timed("run_all_dq_checks", lambda: checks.run_all_dq_checks(tables, staged, BATCH, AS_OF))
    timed("load_all_nothing_new", lambda: loading.load_all(tables, staged, AS_OF_2))

    # the tables the operators and reports read
    for name in ("fact", "fact_item", "fact_order", "fact_payment", "issues", "tracker", "metrics"):
        getattr(w, name)
    for name in OPERATORS:
        timed(name, lambda: registered.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
