"""CSV master-data staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import functions as x


def stage_customers(raw: DataFrame) -> DataFrame:
    c = F.col
    return raw.withColumns({
        "customer_id": x.norm_upper(c("customer_id_raw")),
        "first_name": x.norm_initcap(c("first_name_raw")),
        "last_name": x.norm_initcap(c("last_name_raw")),
        "email": x.norm_lower(c("email_raw")),
        "email_validation_status": x.email_status(c("email_raw")),
        "loyalty_tier": x.loyalty_tier_code(c("loyalty_tier_raw")),
        "signup_source": x.norm_trim(c("signup_source_raw")),
        "is_active": x.text_to_boolean(c("is_active_raw")),
        "is_missing_customer_id": x.missing_flag(c("customer_id_raw")),
        "is_missing_email": x.missing_flag(c("email_raw")),
        "is_missing_first_name": x.missing_flag(c("first_name_raw")),
        "is_missing_last_name": x.missing_flag(c("last_name_raw")),
    })


def stage_orders(raw: DataFrame) -> DataFrame:
    c = F.col
    amount = x.safe_decimal(c("total_amount_raw"))
    return raw.withColumns({
        "order_id": x.norm_upper(c("order_id_raw")),
        "customer_id": x.norm_upper(c("customer_id_raw")),
        "order_date": x.safe_date(c("order_date_raw")),
        "status": x.norm_upper(c("status_raw")),
        "total_amount": amount,
        "total_amount_abs": x.abs_value(amount),
        "currency": x.default_currency(c("currency_raw")),
        "is_missing_order_id": x.missing_flag(c("order_id_raw")),
        "is_missing_customer_id": x.missing_flag(c("customer_id_raw")),
        "is_missing_order_date": x.missing_flag(c("order_date_raw")),
        "is_invalid_order_date": x.invalid_date_flag(c("order_date_raw")),
        "is_negative_amount": x.negative_flag(amount),
    })


def stage_products(raw: DataFrame) -> DataFrame:
    c = F.col
    price = x.safe_decimal(c("price_raw"))
    return raw.withColumns({
        "product_id": x.norm_upper(c("product_id_raw")),
        "sku": x.norm_upper(c("sku_raw")),
        "product_name": x.norm_trim(c("product_name_raw")),
        "description": x.norm_trim(c("description_raw")),
        "category": x.norm_initcap(c("category_raw")),
        "price": price,
        "price_abs": x.abs_value(price),
        "currency": x.default_currency(c("currency_raw")),
        "is_missing_sku": x.missing_flag(c("sku_raw")),
        "is_missing_product_name": x.missing_flag(c("product_name_raw")),
        "is_negative_price": x.negative_flag(price),
    })


def stage_payments(raw: DataFrame) -> DataFrame:
    c = F.col
    amount = x.safe_decimal(c("amount_raw"))
    return raw.withColumns({
        "payment_id": x.norm_upper(c("payment_id_raw")),
        "order_id": x.norm_upper(c("order_id_raw")),
        "transaction_id": x.norm_upper(c("transaction_id_raw")),
        "payment_method": x.payment_method_code(c("payment_method_raw")),
        "amount": amount,
        "amount_abs": x.abs_value(amount),
        "currency": x.default_currency(c("currency_raw")),
        "payment_date": x.safe_date(c("payment_date_raw")),
        "status": x.norm_upper(c("status_raw")),
        "is_missing_payment_id": x.missing_flag(c("payment_id_raw")),
        "is_missing_order_id": x.missing_flag(c("order_id_raw")),
        "is_negative_amount": x.negative_flag(amount),
    })
