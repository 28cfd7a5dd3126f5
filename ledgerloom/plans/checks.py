"""All data-quality checks of a batch, written to the logs."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import dims, keys, quality, seeds
from ..session import run_together
from .loading import DIM_CUSTOMER, DIM_PRODUCT, FACT_ITEM, FACT_ORDER, FACT_PAYMENT, FACT_TRANSACTION, _now, read_fact
from .staging import CLIENT_A, CLIENT_A_ITEMS, CLIENT_C, CLIENT_C_ITEMS, ITEMS, TRANSACTIONS
from .store import TableStore

ISSUES, TRACKER = "data_quality.dq_issue_log", "data_quality.dq_duplicate_tracker"
METRICS, REJECTS = "data_quality.dq_summary_metrics", "data_quality.dq_rejected_records"
VIOLATIONS, INTEGRITY = "data_quality.dq_rule_violations", "data_quality.dq_integrity_issues"
PATTERNS = "data_quality.dq_anomaly_patterns"

_LINE = "concat(coalesce(transaction_id, ''), '-LINE_', cast(line_number AS string))"
# how a record is named in the log, by the table that the rules name
RECORD = {
    "fact_transaction": "coalesce(transaction_id, order_id, concat('UNKNOWN_', cast(raw_record_id AS string)))",
    "fact_transaction_item": _LINE,
    "dim_customer": "customer_id",
}
# foreign keys of the star schema: fact, key, parent, the parent's key, how a row is named
REFERENCES = [
    (FACT_TRANSACTION, "customer_sk", DIM_CUSTOMER, "customer_sk", "transaction_id"),
    (FACT_ITEM, "transaction_sk", FACT_TRANSACTION, "transaction_sk", _LINE),
    (FACT_ITEM, "product_sk", DIM_PRODUCT, "product_sk", _LINE),
    (FACT_ORDER, "customer_sk", DIM_CUSTOMER, "customer_sk", "order_id"),
]
# declared keys of the facts, and how a row is named
UNIQUE_KEYS = [
    (FACT_TRANSACTION, ["transaction_id", "source_client"], "transaction_id"),
    (FACT_ITEM, ["transaction_id", "line_number", "source_client"], _LINE),
    (FACT_ORDER, ["order_id"], "order_id"),
    (FACT_PAYMENT, ["payment_id"], "payment_id"),
]


def run_all_dq_checks(
    store: TableStore, staged: dict[str, DataFrame], batch_id: str, as_of: str, malformed: DataFrame | None = None
) -> DataFrame:
    """Duplicates, issues, mismatches, rejects and metrics of a batch; returns (check_name, result, completed_at).

    Every log keeps one partition per batch, which is replaced as a whole, so
    checks may be run again.
    """
    started = time.monotonic()
    a, c, items_a, items_c = (staged[n] for n in (CLIENT_A, CLIENT_C, CLIENT_A_ITEMS, CLIENT_C_ITEMS))
    done = []

    def note(name: str, result: str) -> None:
        done.append((name, result, _now()))

    found = quality.detect_duplicate_transactions(a, c, batch_id, as_of)
    rejects = quality.quarantine_rejects(staged[TRANSACTIONS], batch_id, as_of, malformed)
    run_together(
        lambda: store.replace_batches(TRACKER, found, [batch_id]), lambda: store.replace_batches(REJECTS, rejects, [batch_id])
    )
    tracker = _of_batch(store, TRACKER, batch_id, found)
    note("Duplicate Detection", f"Duplicate detection completed. Found {tracker.count()} duplicate groups.")

    fact = read_fact(store, FACT_TRANSACTION, [batch_id])
    logged = (
        quality.duplicate_issues(tracker, batch_id, as_of)
        .unionByName(quality.log_issues_client_a(a, items_a, batch_id, as_of))
        .unionByName(quality.log_issues_client_c(c, items_c, batch_id, as_of))
        .unionByName(quality.detect_amount_mismatches(fact, batch_id, as_of))
    )
    store.replace_batches(ISSUES, logged, [batch_id])
    issues = _of_batch(store, ISSUES, batch_id, logged)
    own = (F.col("issue_category") != "UNIQUENESS") & (F.col("issue_type") != "AMOUNT_MISMATCH")
    counts = issues.agg(
        F.count_if(own & (F.col("source_client") == "ClientA")).alias("a"),
        F.count_if(own & (F.col("source_client") == "ClientC")).alias("c"),
        F.count_if(F.col("issue_type") == "AMOUNT_MISMATCH").alias("m"),
    ).first()
    note("ClientA Issues", f"ClientA DQ issues logged: {counts['a']} issues")
    note("ClientC Issues", f"ClientC DQ issues logged: {counts['c']} issues")
    note("Amount Mismatches", f"Amount mismatch detection completed. Found {counts['m']} mismatches.")

    elapsed = int((time.monotonic() - started) * 1000)
    store.replace_batches(METRICS, quality.calculate_dq_metrics(a, c, fact, issues, tracker, batch_id, as_of, elapsed), [batch_id])
    note("Metrics Calculation", f"DQ metrics calculated for batch {batch_id}")
    report = store.spark.createDataFrame(done, "check_name string, result string, completed_at string")
    return report.withColumn("completed_at", F.col("completed_at").cast("timestamp"))


def rule_violations(staged: dict[str, DataFrame]) -> DataFrame:
    """Records of a batch that break a rule of the catalogue.

    Rules on facts are asked of the staged records, since a record that a rule
    rejects never becomes a fact; rules on customers are asked of the members
    that the batch brings, one per customer.
    """
    brought = dims.customer_candidates(staged["staging.stg_customers"], staged[CLIENT_A], staged[CLIENT_C])
    tables = {"fact_transaction": staged[TRANSACTIONS], "fact_transaction_item": staged[ITEMS], "dim_customer": dims.one_per_key(brought, dims.CUSTOMER)}
    return quality.apply_validation_rules(tables, RECORD, seeds.VALIDATION_RULES)


def integrity_issues(store: TableStore, batch_id: str) -> DataFrame:
    """Facts of a batch whose parent is missing or unknown, and keys that the batch holds more than once.

    Only facts of the batch are read, and of a parent only the range of keys they
    refer to. Keys of earlier batches are not asked again: a load skips them.
    """
    def found(rows: DataFrame, fact: str, kind: str, columns: list[str], record: str) -> DataFrame:
        value = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
        return rows.select(
            F.lit(fact).alias("target_table"), F.lit(kind).alias("check_type"), F.lit(", ".join(columns)).alias("key_columns"),
            F.expr(record).alias("record_identifier"), value.alias("key_value"),
        )

    parts = []
    for fact, key, parent, parent_key, record in REFERENCES:
        rows = read_fact(store, fact, [batch_id])
        low, high = rows.filter(F.col(key) != -1).agg(F.min(key), F.max(key)).first()
        parents = read_fact(store, parent) if parent == FACT_TRANSACTION else store.read(parent)
        near = parents.filter(F.col(parent_key).between(low, high))
        parts.append(found(keys.check_referential(rows, key, near, parent_key), fact, "REFERENCE", [key], record))
    for fact, key, record in UNIQUE_KEYS:
        parts.append(found(keys.check_unique(read_fact(store, fact, [batch_id]), key), fact, "UNIQUE", key, record))
    return reduce(DataFrame.unionByName, parts)


def run_validation(store: TableStore, staged: dict[str, DataFrame], batch_id: str, as_of: str) -> DataFrame:
    """Rules, references and keys of a batch, and its anomaly patterns; returns (check_name, result, completed_at).

    Runs after ``run_all_dq_checks``, whose issues the patterns sum up. Every log
    keeps one partition per batch, which is replaced as a whole.
    """
    issues = store.read(ISSUES)
    issues = store.read(ISSUES, store.spark.createDataFrame([], issues.schema), parts=[batch_id])
    when = {"batch_id": F.lit(batch_id), "detected_at": F.lit(as_of).cast("timestamp")}
    logs = {
        VIOLATIONS: rule_violations(staged).withColumns(when),
        INTEGRITY: integrity_issues(store, batch_id).withColumns(when),
        PATTERNS: quality.track_anomaly_patterns(issues).withColumn("batch_id", F.lit(batch_id)),
    }
    run_together(*[lambda n=n, df=df: store.replace_batches(n, df, [batch_id]) for n, df in logs.items()])
    written = {n: _of_batch(store, n, batch_id, df) for n, df in logs.items()}
    broken = written[VIOLATIONS].agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("action_on_failure") == "REJECT").alias("rejected")).first()
    gaps = written[INTEGRITY].agg(F.count_if(F.col("check_type") == "REFERENCE").alias("gaps"), F.count_if(F.col("check_type") == "UNIQUE").alias("repeats")).first()
    done = [
        ("Validation Rules", f"{broken['n']} violations, {broken['rejected']} of rules that reject", _now()),
        ("Referential Integrity", f"{gaps['gaps']} facts without a known parent", _now()),
        ("Unique Keys", f"{gaps['repeats']} repeated keys", _now()),
        ("Anomaly Patterns", f"{written[PATTERNS].count()} patterns", _now()),
    ]
    report = store.spark.createDataFrame(done, "check_name string, result string, completed_at string")
    return report.withColumn("completed_at", F.col("completed_at").cast("timestamp"))


def anomaly_patterns(store: TableStore) -> DataFrame:
    """Recurring issue types over all batches, from what each batch left of them; no issue log is read."""
    return quality.merge_patterns(store.read(PATTERNS))


def _of_batch(store: TableStore, name: str, batch_id: str, like: DataFrame) -> DataFrame:
    empty = store.spark.createDataFrame([], like.schema)
    return store.read(name, empty, parts=[batch_id])
