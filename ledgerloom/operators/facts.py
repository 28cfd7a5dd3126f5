"""Fact loaders. Each returns the new rows only; existing keys are skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as x
from ..functions.parse import MONEY
from . import lookups as lk
from .keys import assign_surrogate_keys, keep_first, max_key
from .unify import classify_header_dq, classify_item_dq

FIRST_SEEN = ["ingestion_timestamp", "source_file_name", "raw_record_id"]

# Which flags count as issues, and which members the issue object has, per client.
_COUNTED_A = [
    "is_missing_transaction_id", "is_missing_order_id", "is_missing_customer_id", "is_missing_email",
    "is_missing_order_date", "is_negative_payment_amount",
]
_COUNTED_C = [f for f in _COUNTED_A if f != "is_missing_order_date"]
_OBJECT_A = [
    "is_missing_transaction_id", "is_missing_order_id", "is_missing_customer_id", "is_missing_email",
    "is_missing_order_date", "is_missing_payment_method", "is_missing_payment_amount", "is_negative_payment_amount",
    "email_validation_status",
]
_OBJECT_C = [f for f in _OBJECT_A if f not in ("is_missing_payment_method", "is_missing_payment_amount")]

FACT_TRANSACTION = [
    "transaction_sk", "transaction_id", "order_id", "customer_sk", "order_date_sk", "payment_method_sk",
    "customer_id", "order_date", "payment_amount", "payment_amount_abs", "payment_currency",
    "item_count", "total_line_amount", "total_line_amount_abs", "amount_variance", "has_amount_variance",
    "source_client", "source_file_name", "source_format", "dq_status", "dq_issues", "dq_issue_count", "has_dq_issues",
    "raw_record_id", "batch_id", "ingestion_timestamp", "created_at",
]
FACT_ITEM = [
    "transaction_item_sk", "transaction_sk", "product_sk", "order_date_sk", "transaction_id", "line_number", "sku",
    "quantity", "quantity_abs", "unit_price", "unit_price_abs", "line_total", "line_total_abs", "currency",
    "description", "item_metadata", "dq_status", "has_negative_quantity", "has_negative_price", "is_missing_sku",
    "is_missing_description", "source_file_name", "source_client", "batch_id", "created_at",
]
FACT_ORDER = [
    "order_sk", "order_id", "customer_sk", "order_date_sk", "order_status_sk", "customer_id", "order_date",
    "total_amount", "currency", "status", "source_file_name", "dq_status", "has_dq_issues", "raw_record_id",
    "batch_id", "record_hash", "created_at",
]
FACT_PAYMENT = [
    "payment_sk", "payment_id", "order_id", "transaction_id", "payment_method_sk", "payment_date_sk", "amount",
    "amount_abs", "currency", "status", "payment_date", "source_file_name", "dq_status", "is_negative_amount",
    "raw_record_id", "batch_id", "created_at",
]


def _keyed(
    rows: DataFrame, sk: str, key: list[str], start: int, columns: list[str], staged: list[DataFrame],
    derived: dict[str, Column], sources: list[str],
) -> DataFrame:
    """Fact rows with their surrogate key; only columns of the fact are carried through the shuffle and kept at rest.

    ``derived`` are the columns that follow from others, of the fact or named in ``sources``; they are computed from the keyed
    rows. A load adds at most one row per staged one; staging is at rest, so its files tell how many there are.
    """
    at_most = sum(df.count() for df in staged)
    carried = [c for c in columns if c != sk and c not in derived]
    keyed = assign_surrogate_keys(rows.select(*carried, *[c for c in sources if c not in carried]), sk, key, start, at_most)
    return keyed.withColumns(derived).select(*columns)


def _load_fact_transaction(staged, dim_customer, dim_date, dim_payment_method, existing, as_of, client, counted, members, start):
    columns = [
        "transaction_id", "order_id", "customer_id", "order_date", "payment_method", "payment_amount",
        "payment_currency", "source_file_name", "source_format", "raw_record_id", "batch_id", "ingestion_timestamp",
        "transaction_index", *_OBJECT_A,
    ]
    rows = staged.filter("transaction_id IS NOT NULL AND NOT is_missing_transaction_id").select(*columns)
    rows = keep_first(rows, ["transaction_id"], [*FIRST_SEEN, "transaction_index"])
    rows = lk.anti_join_existing(rows, existing.filter(F.col("source_client") == client), ["transaction_id"])
    rows = lk.join_dim_customer_current(rows, dim_customer, ["transaction_id"])
    rows = lk.join_dim_date(rows, dim_date, "order_date", "order_date_sk")
    rows = lk.join_dim_payment_method(rows, dim_payment_method)
    issue_count = sum((F.col(f).cast("bigint") for f in counted), F.lit(0).cast("bigint"))
    money = F.lit(None).cast(MONEY)
    rows = rows.withColumn("source_client", F.lit(client))
    derived = {
        "payment_amount_abs": x.abs_value(F.col("payment_amount")),
        "item_count": F.lit(None).cast("bigint"),
        "total_line_amount": money, "total_line_amount_abs": money, "amount_variance": money,
        "has_amount_variance": F.lit(False),
        "dq_status": classify_header_dq(payment_method_counts=True),
        "dq_issues": x.object_construct(*members),
        "dq_issue_count": issue_count,
        "has_dq_issues": issue_count > 0,
        "created_at": F.lit(as_of).cast("timestamp"),
    }
    start = max_key(existing, "transaction_sk") if start is None else start
    return _keyed(
        rows, "transaction_sk", ["source_client", "transaction_id"], start, FACT_TRANSACTION, [staged], derived, _OBJECT_A
    )


def load_fact_transaction_client_a(staged, dim_customer, dim_date, dim_payment_method, existing, as_of, start=None) -> DataFrame:
    return _load_fact_transaction(
        staged, dim_customer, dim_date, dim_payment_method, existing, as_of, "ClientA", _COUNTED_A, _OBJECT_A, start
    )


def load_fact_transaction_client_c(staged, dim_customer, dim_date, dim_payment_method, existing, as_of, start=None) -> DataFrame:
    return _load_fact_transaction(
        staged, dim_customer, dim_date, dim_payment_method, existing, as_of, "ClientC", _COUNTED_C, _OBJECT_C, start
    )


def load_fact_transaction_item(items_a, items_c, fact_transaction, dim_product, existing, as_of, start=None) -> DataFrame:
    """Lines of both clients whose header is loaded; the first line wins per transaction, line number and client."""
    payload = x.object_construct(
        F.col("attributes_extra").alias("attributes"), F.col("warranty_extra").alias("warranty"),
        F.col("gift_options_extra").alias("gift_options"),
    )
    shared = [
        "transaction_id", F.col("line_number").cast("bigint").alias("line_number"), "sku", "quantity", "quantity_abs",
        "unit_price", "unit_price_abs", "line_total", "currency", "description", "is_negative_quantity",
        "is_negative_unit_price", "is_missing_sku", "is_missing_description", "source_file_name", "raw_record_id",
        "ingestion_timestamp", "transaction_index", "batch_id",
    ]
    rows = items_a.select(*shared, payload.alias("item_metadata"), F.lit("ClientA").alias("source_client")).unionByName(
        items_c.select(*shared, F.col("item_metadata_json").alias("item_metadata"), F.lit("ClientC").alias("source_client"))
    )
    key = ["source_client", "transaction_id", "line_number"]
    # the header join comes first: its exchange is the one the first line per key needs, too
    rows = lk.join_items_to_header(rows.filter("transaction_id IS NOT NULL AND transaction_id != ''"), fact_transaction)
    rows = keep_first(rows, [*key, "transaction_sk"], [*FIRST_SEEN, "transaction_index"])
    rows = lk.anti_join_existing(rows, existing, key)
    rows = lk.join_dim_product_current(rows, dim_product, ["transaction_id", "line_number"])
    product = x.line_total(F.col("quantity_abs"), F.col("unit_price_abs"))
    flags = {"has_negative_quantity": "is_negative_quantity", "has_negative_price": "is_negative_unit_price"}
    derived = {
        "line_total_abs": F.coalesce(F.abs("line_total"), product),
        "dq_status": classify_item_dq(),
        **{name: F.col(flag) for name, flag in flags.items()},
        "created_at": F.lit(as_of).cast("timestamp"),
    }
    start = max_key(existing, "transaction_item_sk") if start is None else start
    return _keyed(rows, "transaction_item_sk", key, start, FACT_ITEM, [items_a, items_c], derived, list(flags.values()))


def aggregate_items_per_transaction(items: DataFrame) -> DataFrame:
    return items.groupBy("transaction_sk").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("line_total").try_cast(MONEY).alias("total_line_amount"),
        F.sum("line_total_abs").try_cast(MONEY).alias("total_line_amount_abs"),
    )


def add_to_aggregates(fact_transaction: DataFrame, sums: DataFrame) -> DataFrame:
    """Headers after further lines, from the sums of these lines alone (``aggregate_items_per_transaction``)."""
    names = ["item_count", "total_line_amount", "total_line_amount_abs"]
    more = sums.select("transaction_sk", *[F.col(n).alias(f"_{n}") for n in names])
    c = F.col
    zero = F.lit(0).cast(MONEY)

    def added(n: str) -> Column:
        both = c(n).isNull() & c(f"_{n}").isNull()
        kind = "bigint" if n == "item_count" else MONEY
        return F.when(~both, (F.coalesce(c(n), F.lit(0).cast(kind)) + F.coalesce(c(f"_{n}"), F.lit(0).cast(kind))).try_cast(kind))

    change = c("_item_count").isNotNull()
    joined = fact_transaction.join(more, "transaction_sk", "left").withColumns({f"new_{n}": F.when(change, added(n)).otherwise(c(n)) for n in names})
    paid, lines = c("payment_amount_abs"), c("new_total_line_amount_abs")
    gap = F.abs(F.coalesce(paid, zero) - F.coalesce(lines, zero))
    new = {
        **{n: c(f"new_{n}").cast(fact_transaction.schema[n].dataType) for n in names},
        "amount_variance": (paid - lines).try_cast(MONEY),
        "has_amount_variance": gap > F.lit("0.01").cast("decimal(18,4)"),
    }
    return joined.withColumns({n: F.when(change, v).otherwise(c(n)) for n, v in new.items()}).select(*fact_transaction.columns)


def update_transaction_aggregates(fact_transaction: DataFrame, items: DataFrame) -> DataFrame:
    """Headers with the figures of their lines; a header is touched only where count or total differ."""
    names = ["item_count", "total_line_amount", "total_line_amount_abs"]
    agg = aggregate_items_per_transaction(items).select("transaction_sk", *[F.col(n).alias(f"_{n}") for n in names])
    c = F.col
    differs = (
        c("item_count").isNull() | (c("item_count") != c("_item_count"))
        | c("total_line_amount").isNull() | (c("total_line_amount") != c("_total_line_amount"))
    )
    change = c("_item_count").isNotNull() & F.coalesce(differs, F.lit(False))
    paid, lines = c("payment_amount_abs"), c("_total_line_amount_abs")
    zero = F.lit(0).cast(MONEY)
    gap = F.abs(F.coalesce(paid, zero) - F.coalesce(lines, zero))
    new = {
        **{n: c(f"_{n}") for n in names},
        "amount_variance": (paid - lines).try_cast(MONEY),
        "has_amount_variance": gap > F.lit("0.01").cast("decimal(18,4)"),
    }
    joined = fact_transaction.join(agg, "transaction_sk", "left")
    updated = joined.withColumns({n: F.when(change, v).otherwise(c(n)) for n, v in new.items()})
    return updated.select(*fact_transaction.columns)


def load_fact_order(staged, dim_customer, dim_date, dim_order_status, existing, as_of, start=None) -> DataFrame:
    rows = staged.filter("order_id IS NOT NULL AND NOT is_missing_order_id").select(
        "order_id", "customer_id", "order_date", "total_amount", "currency", "status", "is_missing_order_id",
        "is_missing_customer_id", "is_invalid_order_date", "is_negative_amount", "record_hash", "batch_id", *FIRST_SEEN,
        "file_row_number",
    )
    rows = keep_first(rows, ["order_id"], [*FIRST_SEEN, "file_row_number"])
    rows = lk.anti_join_existing(rows, existing, ["order_id"])
    rows = lk.join_dim_customer_current(rows, dim_customer, ["order_id"])
    rows = lk.join_dim_date(rows, dim_date, "order_date", "order_date_sk")
    rows = lk.join_dim_order_status(rows, dim_order_status)
    c = F.col
    warning = c("is_missing_customer_id") | c("is_invalid_order_date") | c("is_negative_amount")
    derived = {
        "dq_status": F.when(c("is_missing_order_id"), "INVALID").when(warning, "WARNING").otherwise("VALID"),
        "has_dq_issues": c("is_missing_order_id") | c("is_missing_customer_id") | c("is_negative_amount"),
        "created_at": F.lit(as_of).cast("timestamp"),
    }
    flags = ["is_missing_order_id", "is_missing_customer_id", "is_invalid_order_date", "is_negative_amount"]
    start = max_key(existing, "order_sk") if start is None else start
    return _keyed(rows, "order_sk", ["order_id"], start, FACT_ORDER, [staged], derived, flags)


def load_fact_payment(staged, dim_date, dim_payment_method, existing, as_of, start=None) -> DataFrame:
    rows = staged.filter("payment_id IS NOT NULL AND NOT is_missing_payment_id").select(
        "payment_id", "order_id", "transaction_id", "payment_method", "amount", "currency", "status", "payment_date",
        "is_missing_payment_id", "is_negative_amount", "batch_id", *FIRST_SEEN, "file_row_number",
    )
    rows = keep_first(rows, ["payment_id"], [*FIRST_SEEN, "file_row_number"])
    rows = lk.anti_join_existing(rows, existing, ["payment_id"])
    rows = lk.join_dim_payment_method(rows, dim_payment_method)
    rows = lk.join_dim_date(rows, dim_date, "payment_date", "payment_date_sk")
    c = F.col
    derived = {
        "amount_abs": x.abs_value(c("amount")),
        "dq_status": F.when(c("is_missing_payment_id"), "INVALID").when(c("is_negative_amount"), "WARNING").otherwise("VALID"),
        "created_at": F.lit(as_of).cast("timestamp"),
    }
    start = max_key(existing, "payment_sk") if start is None else start
    return _keyed(rows, "payment_sk", ["payment_id"], start, FACT_PAYMENT, [staged], derived, ["is_missing_payment_id"])


_TYPES = {
    **{c: "bigint" for c in (
        "transaction_sk", "transaction_item_sk", "order_sk", "payment_sk", "customer_sk", "product_sk", "order_date_sk",
        "payment_date_sk", "payment_method_sk", "order_status_sk", "item_count", "dq_issue_count", "raw_record_id",
        "line_number", "quantity", "quantity_abs")},
    **{c: MONEY for c in (
        "payment_amount", "payment_amount_abs", "total_line_amount", "total_line_amount_abs", "amount_variance",
        "unit_price", "unit_price_abs", "line_total", "line_total_abs", "total_amount", "amount", "amount_abs")},
    **{c: "date" for c in ("order_date", "payment_date")},
    **{c: "timestamp" for c in ("ingestion_timestamp", "created_at")},
    **{c: "boolean" for c in (
        "has_amount_variance", "has_dq_issues", "has_negative_quantity", "has_negative_price", "is_missing_sku",
        "is_missing_description", "is_negative_amount")},
}


def fact_schema(columns: list[str]) -> str:
    return ", ".join(f"{c} {_TYPES.get(c, 'string')}" for c in columns)


def empty_fact(spark, columns: list[str]) -> DataFrame:
    nulls = [f"CAST(NULL AS {_TYPES.get(c, 'string')}) AS {c}" for c in columns]
    # seen to be empty before any task runs
    return spark.sql(f"SELECT {', '.join(nulls)} WHERE false")
