"""Joins between staging, facts and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NULL_SPREAD = 1024
# Earliest character there is; no trimmed business key starts with it.
_NO_KEY = "\x00"


def spread_missing_keys(key: str, row_columns: list[str]) -> Column:
    """The key itself, or for a NULL key one of many values that match nothing.

    Rows without a key would otherwise all go to one task of a shuffled join.
    """
    spread = F.pmod(F.xxhash64(*row_columns), F.lit(NULL_SPREAD))
    return F.coalesce(F.col(key), F.concat(F.lit(_NO_KEY), spread.cast("string")))


def left_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: list[str], row_columns: list[str]) -> DataFrame:
    """Left join on a business key, adding ``columns`` of the dimension. Whether the dimension is broadcast is
    decided from its size; a hot key's partition is split by adaptive execution."""
    right = dim.select(F.col(dim_key).alias("_dim_key"), *columns)
    left = df.withColumn("_key", spread_missing_keys(key, row_columns))
    return left.join(right, F.col("_key") == F.col("_dim_key"), "left").drop("_key", "_dim_key")


def _current(dim: DataFrame, sk: str) -> DataFrame:
    return dim.filter(F.col("is_current") & (F.col(sk) != -1))


def join_dim_customer_current(df: DataFrame, dim_customer: DataFrame, row_columns: list[str]) -> DataFrame:
    joined = left_lookup(df, _current(dim_customer, "customer_sk"), "customer_id", "customer_id", ["customer_sk"], row_columns)
    return joined.withColumn("customer_sk", F.coalesce("customer_sk", F.lit(-1)).cast("bigint"))


def join_dim_product_current(df: DataFrame, dim_product: DataFrame, row_columns: list[str]) -> DataFrame:
    joined = left_lookup(df, _current(dim_product, "product_sk"), "sku", "sku", ["product_sk"], row_columns)
    return joined.withColumn("product_sk", F.coalesce("product_sk", F.lit(-1)).cast("bigint"))


def join_dim_date(df: DataFrame, dim_date: DataFrame, date_column: str, name: str) -> DataFrame:
    """The calendar has one row per day of a fixed span, so it is always broadcast."""
    days = dim_date.filter("date_sk != -1").select(
        F.col("date_actual").alias(date_column), F.col("date_sk").alias(name)
    )
    joined = df.join(F.broadcast(days), date_column, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(-1)).cast("bigint"))


def join_dim_payment_method(df: DataFrame, dim_payment_method: DataFrame) -> DataFrame:
    """Unmatched codes get the key of the code UNKNOWN. The seed dimension has seven rows."""
    methods = dim_payment_method.select(F.col("payment_method_code").alias("payment_method"), "payment_method_sk")
    unknown = dim_payment_method.filter("payment_method_code = 'UNKNOWN'").select("payment_method_sk").scalar()
    joined = df.join(F.broadcast(methods), "payment_method", "left")
    return joined.withColumn("payment_method_sk", F.coalesce("payment_method_sk", unknown).cast("bigint"))


def join_dim_order_status(df: DataFrame, dim_order_status: DataFrame) -> DataFrame:
    """NULL when the status is not known. The seed dimension has eight rows."""
    statuses = dim_order_status.select(F.col("status_code").alias("_code"), "order_status_sk")
    return df.join(F.broadcast(statuses), F.upper("status") == F.col("_code"), "left").drop("_code")


def join_items_to_header(items: DataFrame, fact_transaction: DataFrame) -> DataFrame:
    header = fact_transaction.select("transaction_id", "source_client", "transaction_sk", "order_date_sk")
    return items.join(header, ["transaction_id", "source_client"])


def anti_join_existing(rows: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Only rows whose key is not in the target yet."""
    return rows.join(target.select(*key), key, "left_anti")


def not_in_current(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Only rows whose business key has no current dimension member."""
    return rows.join(dim.filter("is_current").select(key), key, "left_anti")


def semi_join_in(rows: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(keys.select(*key), key, "left_semi")


def join_customer_transactions(dim_customer: DataFrame, fact_transaction: DataFrame) -> DataFrame:
    """Current customers with the figures of their transactions.

    Transactions are summed per customer before the join, so a customer (or the
    unknown member) with a large share of them is only one row in it.
    ``transaction_sk`` is unique, so counting rows counts transactions.
    """
    per_customer = fact_transaction.filter("customer_sk != -1").groupBy("customer_sk").agg(
        F.count("transaction_sk").alias("transaction_count"),
        F.sum("payment_amount_abs").alias("total_spend"),
        F.sum(F.when(F.col("has_dq_issues"), 1).otherwise(0)).alias("transactions_with_issues"),
        F.max("order_date").alias("last_order_date"),
    )
    return _current(dim_customer, "customer_sk").join(per_customer, "customer_sk", "left")


def trace_backward(fact_transaction: DataFrame, raw_documents: DataFrame) -> DataFrame:
    """Transactions with the document they came from, by raw record id and batch."""
    content = next(c for c in raw_documents.columns if c in ("raw_xml_content", "raw_json_content", "raw_text_content"))
    docs = raw_documents.select("raw_record_id", "source_client", "batch_id", F.col(content).alias("raw_content"))
    columns = ["transaction_id", "source_client", "source_file_name", "batch_id", "ingestion_timestamp", "raw_record_id"]
    return fact_transaction.select(*columns).join(docs, ["raw_record_id", "source_client", "batch_id"])


def trace_forward(fact_transaction: DataFrame, fact_item: DataFrame, source_file_name: str) -> DataFrame:
    """Headers and lines that came from one source file."""
    headers = fact_transaction.filter(F.col("source_file_name") == source_file_name)
    lines = fact_item.select("transaction_sk", "line_number", "sku", "quantity", "unit_price", "line_total")
    return headers.join(lines, "transaction_sk", "left")
