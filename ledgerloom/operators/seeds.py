"""Seeded reference dimensions, unknown members and validation rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Payment methods (key, code, name, category, digital, order).
PAYMENT_METHODS = [
    (1, "CREDIT_CARD", "Credit Card", "Card", False, True, 1),
    (2, "DEBIT_CARD", "Debit Card", "Card", False, True, 2),
    (3, "PAYPAL", "PayPal", "Digital Wallet", True, True, 3),
    (4, "BANK_TRANSFER", "Bank Transfer", "Bank", False, True, 4),
    (5, "OTHER", "Other", "Other", None, True, 98),
    (6, "MISSING", "Missing/Unknown", "Unknown", None, True, 99),
    (7, "UNKNOWN", "Unknown", "Unknown", None, True, 100),
]
# Order statuses (key, code, name, category, terminal, order).
ORDER_STATUSES = [
    (1, "PENDING", "Pending", "Open", False, 1),
    (2, "PROCESSING", "Processing", "Open", False, 2),
    (3, "SHIPPED", "Shipped", "In Transit", False, 3),
    (4, "DELIVERED", "Delivered", "Closed", True, 4),
    (5, "COMPLETED", "Completed", "Closed", True, 5),
    (6, "CANCELLED", "Cancelled", "Closed", True, 6),
    (7, "REFUNDED", "Refunded", "Closed", True, 7),
    (8, "UNKNOWN", "Unknown", "Unknown", None, 99),
]
# Currencies (key, code, name, symbol).
CURRENCIES = [
    (1, "USD", "US Dollar", "$", True),
    (2, "EUR", "Euro", "€", True),
    (3, "GBP", "British Pound", "£", True),
    (4, "UNKNOWN", "Unknown", "?", True),
]
# Validation rules (code, name, category, table, column, type, severity, action).
VALIDATION_RULES = [
    ("R001", "Transaction ID Required", "COMPLETENESS", "fact_transaction", "transaction_id", "NOT_NULL", "CRITICAL", "REJECT"),
    ("R002", "Order ID Required", "COMPLETENESS", "fact_transaction", "order_id", "NOT_NULL", "HIGH", "LOG"),
    ("R003", "Customer ID Required", "COMPLETENESS", "fact_transaction", "customer_id", "NOT_NULL", "HIGH", "LOG"),
    ("R004", "Valid Email Format", "FORMAT", "dim_customer", "email", "REGEX", "MEDIUM", "LOG"),
    ("R005", "Positive Payment Amount", "VALIDITY", "fact_transaction", "payment_amount", "POSITIVE", "HIGH", "LOG"),
    ("R006", "Positive Quantity", "VALIDITY", "fact_transaction_item", "quantity", "POSITIVE", "HIGH", "LOG"),
    ("R007", "Positive Unit Price", "VALIDITY", "fact_transaction_item", "unit_price", "POSITIVE", "HIGH", "LOG"),
    ("R008", "SKU Required", "COMPLETENESS", "fact_transaction_item", "sku", "NOT_NULL", "MEDIUM", "LOG"),
    ("R009", "No Duplicate Transactions", "UNIQUENESS", "fact_transaction", "transaction_id", "UNIQUE", "CRITICAL", "REJECT"),
    ("R010", "Valid Order Date", "FORMAT", "fact_transaction", "order_date", "NOT_NULL", "MEDIUM", "LOG"),
]


def seed_dim_payment_method(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_METHODS,
        "payment_method_sk bigint, payment_method_code string, payment_method_name string, "
        "payment_method_category string, is_digital boolean, is_active boolean, display_order bigint",
    )


def seed_dim_order_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ORDER_STATUSES,
        "order_status_sk bigint, status_code string, status_name string, status_category string, "
        "is_terminal boolean, display_order bigint",
    )


def seed_dim_currency(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CURRENCIES,
        "currency_sk bigint, currency_code string, currency_name string, currency_symbol string, is_active boolean",
    )


def seed_validation_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        VALIDATION_RULES,
        "rule_code string, rule_name string, rule_category string, target_table string, target_column string, "
        "rule_type string, severity string, action_on_failure string",
    )
