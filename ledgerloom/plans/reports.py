"""Monitoring and reconciliation reports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ..operators.lookups import join_customer_transactions
from ..operators.quality import percent

c = F.col


def _flagged(condition) -> object:
    return F.sum(F.when(condition, 1).otherwise(0))


def _row_count(df: DataFrame, **labels: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("record_count"))
    return counted.select(*[F.lit(v).alias(k) for k, v in labels.items()], "record_count")


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report_issue_summary(issues: DataFrame) -> DataFrame:
    keys = ["batch_id", "source_client", "issue_category", "issue_type", "issue_severity"]
    return issues.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count_distinct("source_file_name").alias("affected_files"),
        F.count_distinct("record_identifier").alias("affected_records"),
        F.min("detected_at").alias("first_detected"),
        F.max("detected_at").alias("last_detected"),
        _flagged(c("is_resolved")).alias("resolved_count"),
    ).orderBy(c("issue_count").desc(), *keys)


def report_duplicate_summary(tracker: DataFrame) -> DataFrame:
    return tracker.groupBy("batch_id", "source_client", "duplicate_type").agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.sum("occurrence_count").alias("total_duplicate_records"),
        (F.sum("occurrence_count") - F.count(F.lit(1))).alias("excess_records"),
        F.min("detected_at").alias("first_detected"),
        F.max("detected_at").alias("last_detected"),
    )


def report_transaction_quality(fact_transaction: DataFrame) -> DataFrame:
    return fact_transaction.groupBy("source_client", "dq_status").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("payment_amount_abs").alias("total_amount"),
        F.avg("payment_amount_abs").cast("decimal(18,4)").alias("avg_amount"),
        F.min("order_date").alias("min_order_date"),
        F.max("order_date").alias("max_order_date"),
        _flagged(c("has_dq_issues")).alias("issues_flagged"),
        F.sum("dq_issue_count").alias("total_issue_count"),
    ).orderBy("source_client", "dq_status")


def item_issue_counts(fact_item: DataFrame) -> DataFrame:
    """Lines with an anomaly per transaction; only such lines take part in the shuffle."""
    odd = fact_item.filter("has_negative_quantity OR has_negative_price OR is_missing_sku")
    return odd.groupBy("transaction_sk").agg(
        F.count_if("has_negative_quantity").alias("negative_quantity_lines"),
        F.count_if("has_negative_price").alias("negative_price_lines"),
        F.count_if("is_missing_sku").alias("missing_sku_lines"),
    )


def report_anomaly_detail(fact_transaction: DataFrame, fact_item: DataFrame) -> DataFrame:
    counts = ["negative_quantity_lines", "negative_price_lines", "missing_sku_lines"]
    odd = fact_transaction.filter("has_dq_issues OR dq_status != 'VALID' OR has_amount_variance")
    joined = odd.join(item_issue_counts(fact_item), "transaction_sk", "left")
    return joined.select(
        "transaction_id", "order_id", "customer_id", "source_client", "source_file_name", "order_date", "dq_status",
        "dq_issues", "dq_issue_count", "payment_amount", "payment_amount_abs",
        F.coalesce(c("payment_amount") < 0, F.lit(False)).alias("has_negative_payment"),
        "has_amount_variance", "amount_variance", "item_count",
        *[F.coalesce(n, F.lit(0)).alias(n) for n in counts],
        "ingestion_timestamp", "created_at",
    ).orderBy(c("dq_issue_count").desc_nulls_first(), c("order_date").desc_nulls_first())


def report_file_quality(fact_transaction: DataFrame) -> DataFrame:
    status = c("dq_status")
    summed = fact_transaction.groupBy("source_file_name", "source_client", "source_format").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        *[_flagged(status == s).alias(f"{s.lower()}_count") for s in ("VALID", "WARNING", "INVALID", "CRITICAL")],
        F.sum("payment_amount_abs").alias("total_amount"),
        F.sum("item_count").alias("total_items"),
        F.min("ingestion_timestamp").alias("first_ingested"),
        F.max("ingestion_timestamp").alias("last_ingested"),
    )
    return summed.withColumns({
        "valid_percentage": percent(c("valid_count"), c("total_transactions")),
        "error_percentage": percent(c("invalid_count") + c("critical_count"), c("total_transactions")),
    }).orderBy("source_file_name")


def report_batch_quality(metrics: DataFrame, issues: DataFrame, tracker: DataFrame) -> DataFrame:
    key = ["batch_id", "source_client"]
    logged = issues.groupBy(*key).agg(F.count(F.lit(1)).alias("total_issues_logged"))
    groups = tracker.groupBy(*key).agg(F.count(F.lit(1)).alias("duplicate_groups"))
    joined = metrics.join(logged, key, "left").join(groups, key, "left")
    return joined.select(
        "batch_id", "metric_date", "source_client", "total_records_received", "total_records_loaded",
        "total_records_rejected", "total_records_warning", "missing_field_count", "invalid_format_count",
        "negative_value_count", "duplicate_count", "rejection_rate", "warning_rate", "data_quality_score",
        "calculated_at",
        F.coalesce("total_issues_logged", F.lit(0)).alias("total_issues_logged"),
        F.coalesce("duplicate_groups", F.lit(0)).alias("duplicate_groups"),
    ).orderBy(c("metric_date").desc_nulls_first(), "source_client")


def report_issue_trend(issues: DataFrame) -> DataFrame:
    return issues.groupBy(
        F.to_date("detected_at").alias("issue_date"), "source_client", "issue_category", "issue_severity"
    ).agg(F.count(F.lit(1)).alias("issue_count")).orderBy(
        c("issue_date").desc_nulls_first(), "source_client", c("issue_count").desc()
    )


def report_customer_quality(dim_customer: DataFrame, fact_transaction: DataFrame) -> DataFrame:
    joined = join_customer_transactions(dim_customer, fact_transaction)
    return joined.select(
        "customer_id", "full_name", "email", "email_validation_status", "loyalty_tier", "source_client",
        F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"),
        "total_spend",
        F.coalesce("transactions_with_issues", F.lit(0)).alias("transactions_with_issues"),
        "last_order_date",
    ).orderBy(c("transaction_count").desc(), "customer_id")


# Layer label and table name per reconciled table.
RECONCILED = [
    ("RAW_XML", "raw.raw_xml_transactions"),
    ("RAW_TXT", "raw.raw_txt_xml_transactions"),
    ("RAW_JSON", "raw.raw_json_transactions"),
    ("RAW_CSV_CUSTOMERS", "raw.raw_csv_customers"),
    ("RAW_CSV_ORDERS", "raw.raw_csv_orders"),
    ("RAW_CSV_PRODUCTS", "raw.raw_csv_products"),
    ("RAW_CSV_PAYMENTS", "raw.raw_csv_payments"),
    ("STAGING_CLIENT_A", "staging.stg_client_a_transactions"),
    ("STAGING_CLIENT_C", "staging.stg_client_c_transactions"),
    ("CANONICAL_TRANSACTIONS", "canonical.fact_transaction"),
    ("CANONICAL_ITEMS", "canonical.fact_transaction_item"),
    ("DQ_ISSUES", "data_quality.dq_issue_log"),
    ("DQ_DUPLICATES", "data_quality.dq_duplicate_tracker"),
]


def report_reconciliation(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts per layer; ``tables`` maps qualified names to DataFrames."""
    parts = [_row_count(tables[name], layer=layer, table_name=name) for layer, name in RECONCILED if name in tables]
    return _stack(parts).orderBy("layer")


def report_ingestion_summary(raw_tables: dict[str, DataFrame], batch_id: str) -> DataFrame:
    parts = [
        df.filter(c("batch_id") == batch_id).agg(
            F.count(F.lit(1)).alias("total_records"), F.count_distinct("source_file_name").alias("files_loaded")
        ).select(F.lit(name).alias("table_name"), "total_records", "files_loaded")
        for name, df in raw_tables.items()
    ]
    return _stack(parts)


def report_txt_parse_status(raw_txt: DataFrame, batch_id: str) -> DataFrame:
    return raw_txt.filter(c("batch_id") == batch_id).agg(
        _flagged(c("xml_parse_success")).alias("success_count"),
        _flagged(~c("xml_parse_success")).alias("failure_count"),
    ).select(F.lit("TXT XML Parse Results").alias("check_type"), "success_count", "failure_count")


def report_run_summary(tables: dict[str, DataFrame], metrics, issues, tracker, fact_transaction, batch_id: str) -> dict[str, DataFrame]:
    return {
        "reconciliation": report_reconciliation(tables),
        "batch_quality": report_batch_quality(metrics, issues, tracker).filter(c("batch_id") == batch_id),
        "file_quality": report_file_quality(fact_transaction),
    }


def report_lineage_counts(raw: DataFrame, staged: DataFrame, fact_transaction: DataFrame, issues: DataFrame, client: str) -> DataFrame:
    """Counts of one client from raw to issues."""
    mine = c("source_client") == client
    return _stack([
        _row_count(raw.filter(mine), layer="RAW"),
        _row_count(staged.filter(mine), layer="STAGING"),
        _row_count(fact_transaction.filter(mine), layer="CANONICAL"),
        _row_count(issues.filter(mine), layer="DQ_ISSUES"),
    ])


def report_recent_loads(audit: DataFrame, limit: int = 10) -> DataFrame:
    return audit.orderBy(c("created_at").desc_nulls_first(), "target_table", "source_file_name").limit(limit)


def report_metrics_last_7_days(batch_quality: DataFrame, today: str) -> DataFrame:
    first = date.fromisoformat(today[:10]) - timedelta(days=7)
    return batch_quality.filter(c("metric_date") >= F.lit(first)).orderBy(c("metric_date").desc_nulls_first())


def report_open_critical(issues: DataFrame) -> DataFrame:
    return issues.filter("issue_severity = 'CRITICAL' AND NOT is_resolved").agg(F.count(F.lit(1)).alias("critical_issues"))


def report_batch_status_by_file(fact_transaction: DataFrame, batch_id: str) -> DataFrame:
    return (
        fact_transaction.filter(c("batch_id") == batch_id)
        .groupBy("source_file_name", "dq_status")
        .agg(F.count(F.lit(1)).alias("transaction_count"))
        .orderBy(c("transaction_count").desc(), "source_file_name", "dq_status")
    )
