"""Both clients in one header shape and one item shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEADER_COLUMNS = [
    "source_format", "source_file_name", "raw_record_id", "batch_id", "ingestion_timestamp", "transaction_index",
    "transaction_id", "transaction_id_raw", "order_id", "customer_id", "order_date",
    "first_name", "last_name", "email", "email_validation_status",
    "payment_method", "payment_amount", "payment_amount_abs", "payment_currency",
    "is_missing_transaction_id", "is_missing_order_id", "is_missing_order_date", "is_missing_customer_id",
    "is_missing_email", "is_missing_payment_method", "is_missing_payment_amount", "is_negative_payment_amount",
]
ITEM_COLUMNS = [
    "source_file_name", "raw_record_id", "batch_id", "ingestion_timestamp", "transaction_index",
    "transaction_id", "order_id", "customer_id", "order_date", "line_number",
    "sku", "sku_raw", "description", "quantity", "quantity_abs", "unit_price", "unit_price_abs", "currency",
    "line_total", "line_total_abs",
    "is_missing_sku", "is_missing_description", "is_negative_quantity", "is_negative_unit_price",
]


def classify_header_dq(payment_method_counts: bool = False) -> Column:
    """CRITICAL, INVALID, WARNING or VALID. The loader also warns about a missing payment method."""
    warning = F.col("is_missing_email") | F.col("is_missing_order_date")
    if payment_method_counts:
        warning = warning | F.col("is_missing_payment_method")
    invalid = F.col("is_missing_order_id") | F.col("is_missing_customer_id") | F.col("is_negative_payment_amount")
    return (
        F.when(F.col("is_missing_transaction_id"), "CRITICAL").when(invalid, "INVALID").when(warning, "WARNING")
        .otherwise("VALID")
    )


def classify_item_dq() -> Column:
    doubtful = F.col("is_negative_quantity") | F.col("is_negative_unit_price") | F.col("is_missing_description")
    return F.when(F.col("is_missing_sku"), "INVALID").when(doubtful, "WARNING").otherwise("VALID")


def unify_transactions(client_a: DataFrame, client_c: DataFrame) -> DataFrame:
    def shape(df: DataFrame, client: str, tier: str, metadata: str, payload: str) -> DataFrame:
        return df.select(
            F.lit(client).alias("source_client"), *HEADER_COLUMNS, F.col(tier).alias("loyalty_tier"),
            classify_header_dq().alias("dq_status"),
            F.col(metadata).alias("metadata_json"), F.col(payload).alias("raw_payload"),
        )

    a = shape(client_a, "ClientA", "loyalty_tier_extra", "extra_fields_summary", "raw_transaction_xml")
    return a.unionByName(shape(client_c, "ClientC", "loyalty_tier", "transaction_metadata", "raw_transaction_json"))


def unify_transaction_items(items_a: DataFrame, items_c: DataFrame) -> DataFrame:
    def shape(df: DataFrame, client: str, metadata: str) -> DataFrame:
        return df.select(
            F.lit(client).alias("source_client"), *ITEM_COLUMNS,
            classify_item_dq().alias("dq_status"), F.col(metadata).alias("item_metadata"),
        )

    a = shape(items_a, "ClientA", "item_extra_fields_summary")
    return a.unionByName(shape(items_c, "ClientC", "item_metadata_json"))
