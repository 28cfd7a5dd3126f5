"""The expected result of every registered query as one SQL statement over the driver tables."""

from __future__ import annotations

import re

from . import truth
from .truth import AS_OF, BATCH

TABLES = {t: t for t in ("customer", "orders", "lineitem", "part", "events", "documents")}

# The character class of word delimiters, the e-mail pattern.
_D = r"\s!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>".replace('\\"', '"')
_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def up(x):
    return f"upper(trim(nullif({x}, '')))"


def low(x):
    return f"lower(trim(nullif({x}, '')))"


def tr(x):
    return f"trim(nullif({x}, ''))"


def cap(x):
    return f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[^{_D}]*[{_D}]?'), lambda w: upper(w[1]) || w[2:]), '')"


def initcap(x):
    return f"CASE WHEN {tr(x)} IS NOT NULL THEN {cap(tr(x))} END"


def missing(x):
    return f"(nullif(trim({x}), '') IS NULL)"


def to_date(x):
    return f"CAST(coalesce(try_strptime({x}, '%Y-%m-%d'), try_strptime({x}, '%m/%d/%Y')) AS DATE)"


def dec(x):
    return f"try_cast({x} AS DECIMAL(18,4))"


def integer(x):
    return f"try_cast(try_cast({x} AS DECIMAL(38,0)) AS BIGINT)"


def neg(x):
    return f"coalesce({x} < 0, false)"


def currency(x):
    return f"coalesce({up(x)}, 'USD')"


def email_status(x):
    return f"CASE WHEN {missing(x)} THEN 'MISSING' WHEN NOT regexp_matches(lower(trim({x})), '{_EMAIL}') THEN 'INVALID' ELSE 'VALID' END"


def method(x):
    packed = f"upper(replace(trim({x}), ' ', ''))"
    return (
        f"CASE WHEN {packed} IN ('CREDITCARD', 'CREDIT_CARD', 'CC') THEN 'CREDIT_CARD' "
        f"WHEN {packed} IN ('DEBITCARD', 'DEBIT_CARD', 'DC') THEN 'DEBIT_CARD' "
        f"WHEN upper(trim({x})) = 'PAYPAL' THEN 'PAYPAL' "
        f"WHEN {packed} IN ('BANKTRANSFER', 'BANK_TRANSFER', 'WIRE') THEN 'BANK_TRANSFER' "
        f"WHEN {missing(x)} THEN 'MISSING' ELSE 'OTHER' END"
    )


def tier(x):
    return f"CASE WHEN upper(trim({x})) IN ('GOLD', 'SILVER', 'BRONZE', 'PLATINUM') THEN upper(trim({x})) ELSE 'UNKNOWN' END"


def boolean(x):
    return (
        f"CASE WHEN upper(trim({x})) IN ('TRUE', 'YES', '1', 'Y', 'T') THEN true "
        f"WHEN upper(trim({x})) IN ('FALSE', 'NO', '0', 'N', 'F') THEN false END"
    )


def sha(*parts):
    joined = " || '|' || ".join(f"coalesce({p}, '')" for p in parts)
    return f"sha256({joined})"


def big(x):
    return f"CAST({x} AS BIGINT)"


def pct(part, whole):
    return f"CAST(round(100.0 * ({part}) / nullif({whole}, 0), 2) AS DECIMAL(9,2))"


def first_rows(source, key, order):
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


CTES: dict[str, str] = {
    "raw_customers": truth.CUSTOMERS,
    "raw_customers_2": truth.CUSTOMERS_DAY_2,
    "raw_orders": truth.ORDERS,
    "raw_products": truth.PRODUCTS,
    "raw_payments": truth.PAYMENTS,
    "raw_lines": truth.ITEM_TEXT,
    # malformed documents never reach staging
    "landed_a": truth.HEADERS_A,
    "raw_headers_a": "SELECT * FROM landed_a WHERE is_txt = 0 OR is_broken = 0",
    "raw_headers_c": truth.HEADERS_C,
    "raw_items_c": truth.ITEMS_C,
}


def _customers(raw):
    return f"""SELECT *, {up('customer_id_raw')} AS customer_id, {initcap('first_name_raw')} AS first_name,
      {initcap('last_name_raw')} AS last_name, {low('email_raw')} AS email, {email_status('email_raw')} AS email_validation_status,
      {tier('loyalty_tier_raw')} AS loyalty_tier, {tr('signup_source_raw')} AS signup_source, {boolean('is_active_raw')} AS is_active,
      {missing('customer_id_raw')} AS is_missing_customer_id, {missing('email_raw')} AS is_missing_email,
      {missing('first_name_raw')} AS is_missing_first_name, {missing('last_name_raw')} AS is_missing_last_name,
      {sha('customer_id_raw', 'first_name_raw', 'last_name_raw', 'email_raw', 'loyalty_tier_raw')} AS record_hash
      FROM {raw}"""


CTES["stg_customers"] = _customers("raw_customers")
CTES["stg_customers_2"] = _customers("raw_customers_2")
CTES["stg_orders"] = f"""SELECT *, {up('order_id_raw')} AS order_id, {up('customer_id_raw')} AS customer_id,
      {to_date('order_date_raw')} AS order_date, {up('status_raw')} AS status, {dec('total_amount_raw')} AS total_amount,
      abs({dec('total_amount_raw')}) AS total_amount_abs, {currency('currency_raw')} AS currency,
      {missing('order_id_raw')} AS is_missing_order_id, {missing('customer_id_raw')} AS is_missing_customer_id,
      {missing('order_date_raw')} AS is_missing_order_date,
      ({to_date('order_date_raw')} IS NULL AND NOT {missing('order_date_raw')}) AS is_invalid_order_date,
      {neg(dec('total_amount_raw'))} AS is_negative_amount,
      {sha('order_id_raw', 'customer_id_raw', 'order_date_raw', 'total_amount_raw')} AS record_hash FROM raw_orders"""
CTES["stg_products"] = f"""SELECT *, {up('product_id_raw')} AS product_id, {up('sku_raw')} AS sku,
      {tr('product_name_raw')} AS product_name, {tr('description_raw')} AS description, {initcap('category_raw')} AS category,
      {dec('price_raw')} AS price, abs({dec('price_raw')}) AS price_abs, {currency('currency_raw')} AS currency,
      {missing('sku_raw')} AS is_missing_sku, {missing('product_name_raw')} AS is_missing_product_name,
      {neg(dec('price_raw'))} AS is_negative_price,
      {sha('product_id_raw', 'sku_raw', 'product_name_raw', 'price_raw')} AS record_hash FROM raw_products"""
CTES["stg_payments"] = f"""SELECT *, {up('payment_id_raw')} AS payment_id, {up('order_id_raw')} AS order_id,
      {up('transaction_id_raw')} AS transaction_id, {method('payment_method_raw')} AS payment_method,
      {dec('amount_raw')} AS amount, abs({dec('amount_raw')}) AS amount_abs, {currency('currency_raw')} AS currency,
      {to_date('payment_date_raw')} AS payment_date, {up('status_raw')} AS status,
      {missing('payment_id_raw')} AS is_missing_payment_id, {missing('order_id_raw')} AS is_missing_order_id,
      {neg(dec('amount_raw'))} AS is_negative_amount,
      {sha('payment_id_raw', 'order_id_raw', 'amount_raw', 'payment_method_raw')} AS record_hash FROM raw_payments"""

_A_EXTRAS = ["metadata", "tags", "preferences", "notes", "flags", "attributes", "fees"]
_SUMMARY_A = "to_json(struct_pack(loyalty_tier := loyalty_tier_extra, " + ", ".join(
    f"has_{e} := {e}_extra IS NOT NULL" for e in _A_EXTRAS
) + "))"
CTES["stg_a"] = f"""SELECT * REPLACE (nullif(payment_amount_raw, '') AS payment_amount_raw),
      CASE WHEN is_txt = 1 THEN 'XML_FROM_TXT' ELSE 'XML' END AS source_format, 'ClientA' AS source_client,
      {up('transaction_id_raw')} AS transaction_id, {up('order_id_raw')} AS order_id, {to_date('order_date_raw')} AS order_date,
      {up('customer_id_raw')} AS customer_id, {initcap('first_name_raw')} AS first_name, {initcap('last_name_raw')} AS last_name,
      {low('email_raw')} AS email, {email_status('email_raw')} AS email_validation_status, {method('payment_method_raw')} AS payment_method,
      {dec('payment_amount_raw')} AS payment_amount, abs({dec('payment_amount_raw')}) AS payment_amount_abs,
      {currency('payment_currency_raw')} AS payment_currency, {_SUMMARY_A} AS extra_fields_summary,
      {missing('transaction_id_raw')} AS is_missing_transaction_id, {missing('order_id_raw')} AS is_missing_order_id,
      {missing('order_date_raw')} AS is_missing_order_date,
      ({to_date('order_date_raw')} IS NULL AND NOT {missing('order_date_raw')}) AS is_invalid_order_date,
      {missing('customer_id_raw')} AS is_missing_customer_id, {missing('email_raw')} AS is_missing_email,
      {missing('first_name_raw')} AS is_missing_first_name, {missing('last_name_raw')} AS is_missing_last_name,
      {missing('payment_method_raw')} AS is_missing_payment_method, {missing('payment_amount_raw')} AS is_missing_payment_amount,
      {neg(dec('payment_amount_raw'))} AS is_negative_payment_amount
      FROM raw_headers_a"""


def _items(source, sku, description, quantity, price, cur):
    q, p = integer(quantity), dec(price)
    total = f"try_cast(CAST({q} AS DECIMAL(18,0)) * CAST({p} AS DECIMAL(18,4)) AS DECIMAL(18,4))"
    return f"""{up(sku)} AS sku, {tr(description)} AS description, {q} AS quantity, {p} AS unit_price,
      {currency(cur)} AS currency, abs({q}) AS quantity_abs, abs({p}) AS unit_price_abs,
      {total} AS line_total, abs({total}) AS line_total_abs,
      {missing(sku)} AS is_missing_sku, {missing(description)} AS is_missing_description, {q} IS NULL AS is_missing_quantity,
      {neg(q)} AS is_negative_quantity, coalesce({q} = 0, false) AS is_zero_quantity,
      {p} IS NULL AS is_missing_unit_price, {neg(p)} AS is_negative_unit_price, coalesce({p} = 0, false) AS is_zero_unit_price
      {source}"""


_PARENT = ("h.raw_record_id, h.source_file_name, h.source_client, h.transaction_index, h.transaction_id, h.transaction_id_raw, "
           "h.order_id, h.customer_id, h.order_date")
CTES["stg_a_items"] = f"""SELECT {_PARENT}, {big('i.line')} AS line_number, i.sku_text AS sku_raw, i.description_text AS description_raw,
      i.quantity_text AS quantity_raw, i.unit_price_text AS unit_price_raw, i.currency_text AS currency_raw,
      i.attributes_extra, i.warranty_extra, i.gift_options_extra,
      to_json(struct_pack(has_attributes := i.attributes_extra IS NOT NULL, has_warranty := i.warranty_extra IS NOT NULL,
        has_gift_options := i.gift_options_extra IS NOT NULL)) AS item_extra_fields_summary,
      {_items("FROM stg_a h JOIN raw_lines i ON i.o = h.o", 'i.sku_text', 'i.description_text', 'i.quantity_text', 'i.unit_price_text', 'i.currency_text')}"""

_first = (f"CASE WHEN nullif(first_name_raw, '') IS NOT NULL THEN {cap('trim(first_name_raw)')} "
          f"WHEN nullif(full_name_raw, '') IS NOT NULL THEN " + cap("split_part(full_name_raw, ' ', 1)") + " END")
_last = (f"CASE WHEN nullif(last_name_raw, '') IS NOT NULL THEN {cap('trim(last_name_raw)')} "
         f"WHEN nullif(full_name_raw, '') IS NOT NULL THEN CASE WHEN len(string_split(full_name_raw, ' ')) > 1 THEN "
         + cap("split_part(full_name_raw, ' ', 2)") + " ELSE '' END END")
_tid = "coalesce(transaction_id_raw, transaction_id_alt_raw)"
_cid = "coalesce(customer_id_raw, customer_id_alt_raw)"
_tier = "coalesce(loyalty_tier_raw, tier_alt_raw)"
_method = "coalesce(payment_method_raw, payment_method_alt_raw)"
_amount = "coalesce(payment_amount_raw, payment_total_alt_raw)"
CTES["stg_c"] = f"""SELECT *, 'JSON' AS source_format, 'ClientC' AS source_client, {up(_tid)} AS transaction_id,
      {up('order_id_raw')} AS order_id, {to_date('order_date_raw')} AS order_date, {up(_cid)} AS customer_id,
      {_first} AS first_name, {_last} AS last_name, {low('email_raw')} AS email, {email_status('email_raw')} AS email_validation_status,
      {tier(_tier)} AS loyalty_tier, {method(_method)} AS payment_method, {dec(_amount)} AS payment_amount,
      abs({dec(_amount)}) AS payment_amount_abs, {currency('payment_currency_raw')} AS payment_currency,
      coalesce((SELECT count(*) FROM raw_items_c i WHERE i.o = raw_headers_c.o), 0) AS items_count,
      to_json(struct_pack(source_file := source_file_name, has_loyalty_tier := loyalty_tier_raw IS NOT NULL, order_status := order_status_raw)) AS transaction_metadata,
      {missing(_tid)} AS is_missing_transaction_id, {missing('order_id_raw')} AS is_missing_order_id,
      {missing('order_date_raw')} AS is_missing_order_date,
      ({to_date('order_date_raw')} IS NULL AND NOT {missing('order_date_raw')}) AS is_invalid_order_date,
      {missing(_cid)} AS is_missing_customer_id, {missing('email_raw')} AS is_missing_email,
      {missing(_method)} AS is_missing_payment_method, {missing(_amount)} AS is_missing_payment_amount,
      {neg(dec(_amount))} AS is_negative_payment_amount
      FROM raw_headers_c"""
CTES["stg_c_items"] = f"""SELECT {_PARENT}, {big('i.line')} AS line_number, i.sku_raw, i.product_id_raw, i.description_raw, i.name_raw,
      i.quantity_raw, i.qty_alt_raw, i.unit_price_raw, i.price_alt_raw, i.currency_raw,
      {_items("FROM stg_c h JOIN raw_items_c i ON i.o = h.o", 'coalesce(i.sku_raw, i.product_id_raw)', 'coalesce(i.description_raw, i.name_raw)',
              'coalesce(i.quantity_raw, i.qty_alt_raw)', 'coalesce(i.unit_price_raw, i.price_alt_raw)', 'i.currency_raw')}"""


def header_dq(loader=False):
    extra = " OR is_missing_payment_method" if loader else ""
    return ("CASE WHEN is_missing_transaction_id THEN 'CRITICAL' WHEN is_missing_order_id OR is_missing_customer_id OR "
            f"is_negative_payment_amount THEN 'INVALID' WHEN is_missing_email OR is_missing_order_date{extra} THEN 'WARNING' ELSE 'VALID' END")


ITEM_DQ = ("CASE WHEN is_missing_sku THEN 'INVALID' WHEN is_negative_quantity OR is_negative_unit_price THEN 'WARNING' "
           "WHEN is_missing_description THEN 'WARNING' ELSE 'VALID' END")

UNIFIED = ("source_client, source_format, source_file_name, raw_record_id, transaction_index, transaction_id, transaction_id_raw, order_id, "
           "customer_id, order_date, first_name, last_name, email, email_validation_status, {tier} AS loyalty_tier, payment_method, "
           "payment_amount, payment_amount_abs, payment_currency, is_missing_transaction_id, is_missing_order_id, is_missing_order_date, "
           "is_missing_customer_id, is_missing_email, is_missing_payment_method, is_missing_payment_amount, is_negative_payment_amount")
CTES["unified"] = (f"SELECT {UNIFIED.format(tier='loyalty_tier_extra')}, {header_dq()} AS dq_status, extra_fields_summary AS metadata_json FROM stg_a "
                   f"UNION ALL SELECT {UNIFIED.format(tier='loyalty_tier')}, {header_dq()}, transaction_metadata FROM stg_c")
ITEM_COLS = ("source_client, source_file_name, raw_record_id, transaction_index, transaction_id, order_id, customer_id, order_date, line_number, "
             "sku, sku_raw, description, quantity, quantity_abs, unit_price, unit_price_abs, currency, line_total, line_total_abs, "
             "is_missing_sku, is_missing_description, is_negative_quantity, is_negative_unit_price")
CTES["unified_items"] = (f"SELECT {ITEM_COLS}, {ITEM_DQ} AS dq_status FROM stg_a_items "
                         f"UNION ALL SELECT {ITEM_COLS}, {ITEM_DQ} FROM stg_c_items")

# ---- dimensions -----------------------------------------------------------

CTES["dim_payment_method"] = """SELECT * FROM (VALUES (1, 'CREDIT_CARD'), (2, 'DEBIT_CARD'), (3, 'PAYPAL'), (4, 'BANK_TRANSFER'),
      (5, 'OTHER'), (6, 'MISSING'), (7, 'UNKNOWN')) AS t(payment_method_sk, payment_method_code)"""
CTES["dim_order_status"] = """SELECT * FROM (VALUES (1, 'PENDING'), (2, 'PROCESSING'), (3, 'SHIPPED'), (4, 'DELIVERED'), (5, 'COMPLETED'),
      (6, 'CANCELLED'), (7, 'REFUNDED'), (8, 'UNKNOWN')) AS t(order_status_sk, status_code)"""

_CAND = ("customer_id, first_name, last_name, email, email_validation_status, {tier} AS loyalty_tier, {signup} AS signup_source, "
         "{active} AS is_active, {client} AS source_client, source_file_name, {hash} AS record_hash, {prio} AS prio, {rec} AS rec, {pos} AS pos")


def _candidates(csv):
    csv_part = _CAND.format(tier="loyalty_tier", signup="signup_source", active="is_active", client="'CSV'", hash="record_hash",
                            prio=0, rec="raw_record_id", pos="file_row_number")
    rest = dict(signup="CAST(NULL AS VARCHAR)", active="CAST(NULL AS BOOLEAN)", hash="CAST(NULL AS VARCHAR)", rec="raw_record_id", pos="transaction_index")
    a = _CAND.format(tier=tier("loyalty_tier_extra"), client="'ClientA'", prio=1, **rest)
    c = _CAND.format(tier="loyalty_tier", client="'ClientC'", prio=2, **rest)
    ok = "WHERE customer_id IS NOT NULL AND NOT is_missing_customer_id"
    return (f"SELECT {csv_part} FROM {csv} {ok} UNION ALL SELECT {a} FROM stg_a {ok} UNION ALL SELECT {c} FROM stg_c {ok}")


CTES["customer_candidates"] = _candidates("stg_customers")
CTES["customer_first"] = first_rows("customer_candidates", "customer_id", "prio, source_file_name, rec, pos")
_FULL = ("coalesce(first_name, '') || ' ' || coalesce(last_name, '') AS full_name, "
         "CASE WHEN email IS NOT NULL THEN split_part(email, '@', 2) END AS email_domain")
CTES["dim_customer"] = (f"SELECT {big('row_number() OVER (ORDER BY md5(customer_id), customer_id)')} AS customer_sk, "
                        f"* EXCLUDE (prio, rec, pos), {_FULL} FROM customer_first")
CTES["csv_first"] = first_rows("(SELECT * FROM customer_candidates WHERE prio = 0)", "customer_id", "source_file_name, rec, pos")
CTES["csv_day_2"] = first_rows("(SELECT *, raw_record_id AS rec, file_row_number AS pos FROM stg_customers_2 WHERE customer_id IS NOT NULL AND NOT is_missing_customer_id)",
                               "customer_id", "source_file_name, rec, pos")
CTES["csv_dim"] = (f"SELECT {big('row_number() OVER (ORDER BY md5(customer_id), customer_id)')} AS customer_sk, customer_id, first_name, "
                   "last_name, email, loyalty_tier, record_hash FROM csv_first")

CTES["product_candidates"] = """
      SELECT sku, product_id, product_name, description, category, price, currency, 'CSV' AS source_client, source_file_name, record_hash,
        0 AS prio, raw_record_id AS rec, file_row_number AS pos, 0 AS ln FROM stg_products WHERE sku IS NOT NULL AND NOT is_missing_sku
      UNION ALL SELECT sku, NULL, description, description, NULL, NULL, 'USD', 'ClientA', source_file_name, NULL, 1, raw_record_id, transaction_index, line_number
        FROM stg_a_items WHERE sku IS NOT NULL AND NOT is_missing_sku
      UNION ALL SELECT sku, NULL, description, description, NULL, NULL, 'USD', 'ClientC', source_file_name, NULL, 2, raw_record_id, transaction_index, line_number
        FROM stg_c_items WHERE sku IS NOT NULL AND NOT is_missing_sku"""
CTES["product_first"] = first_rows("product_candidates", "sku", "prio, source_file_name, rec, pos, ln")
CTES["dim_product"] = (f"SELECT {big('row_number() OVER (ORDER BY md5(sku), sku)')} AS product_sk, * EXCLUDE (prio, rec, pos, ln) FROM product_first")

# ---- facts ----------------------------------------------------------------

_DATE_SK = "CASE WHEN {d} BETWEEN DATE '1995-01-01' AND DATE '2002-12-31' THEN " + big("strftime({d}, '%Y%m%d')") + " ELSE -1 END"


def date_sk(d):
    return _DATE_SK.format(d=d)


_COUNT_A = ["is_missing_transaction_id", "is_missing_order_id", "is_missing_customer_id", "is_missing_email", "is_missing_order_date", "is_negative_payment_amount"]
_COUNT_C = [f for f in _COUNT_A if f != "is_missing_order_date"]
_OBJ_A = ["is_missing_transaction_id", "is_missing_order_id", "is_missing_customer_id", "is_missing_email", "is_missing_order_date",
          "is_missing_payment_method", "is_missing_payment_amount", "is_negative_payment_amount", "email_validation_status"]
_OBJ_C = [f for f in _OBJ_A if f not in ("is_missing_payment_method", "is_missing_payment_amount")]


def _fact(stg, client, counted, members, start):
    n = " + ".join(f"CAST({f} AS BIGINT)" for f in counted)
    obj = "to_json(struct_pack(" + ", ".join(f"{m} := t.{m}" for m in members) + "))"
    rows = first_rows(f"(SELECT * FROM {stg} WHERE transaction_id IS NOT NULL AND NOT is_missing_transaction_id)",
                      "transaction_id", "source_file_name, raw_record_id, transaction_index")
    return f"""SELECT {big(f"{start} + row_number() OVER (ORDER BY md5('{client}|' || t.transaction_id), t.transaction_id)")} AS transaction_sk,
      t.transaction_id, t.order_id, coalesce(c.customer_sk, -1) AS customer_sk, {date_sk('t.order_date')} AS order_date_sk,
      {big('coalesce(pm.payment_method_sk, 7)')} AS payment_method_sk, t.customer_id, t.order_date, t.payment_amount,
      abs(t.payment_amount) AS payment_amount_abs, t.payment_currency, t.source_client, t.source_file_name, t.source_format,
      {header_dq(True)} AS dq_status, {obj} AS dq_issues, {big(n)} AS dq_issue_count, ({n}) > 0 AS has_dq_issues, t.raw_record_id
      FROM ({rows}) t LEFT JOIN dim_customer c ON c.customer_id = t.customer_id
      LEFT JOIN dim_payment_method pm ON pm.payment_method_code = t.payment_method"""


CTES["fact_a"] = _fact("stg_a", "ClientA", _COUNT_A, _OBJ_A, "0")
CTES["fact_c"] = _fact("stg_c", "ClientC", _COUNT_C, _OBJ_C, "(SELECT count(*) FROM fact_a)")
CTES["fact_ac"] = "SELECT * FROM fact_a UNION ALL SELECT * FROM fact_c"
_META_A = ("'{' || array_to_string(list_filter([CASE WHEN attributes_extra IS NOT NULL THEN '\"attributes\":' || to_json(attributes_extra) END, "
           "CASE WHEN warranty_extra IS NOT NULL THEN '\"warranty\":' || to_json(warranty_extra) END, "
           "CASE WHEN gift_options_extra IS NOT NULL THEN '\"gift_options\":' || to_json(gift_options_extra) END], lambda x: x IS NOT NULL), ',') || '}'")
_FI = ("transaction_id, line_number, sku, quantity, quantity_abs, unit_price, unit_price_abs, line_total, currency, description, is_negative_quantity, "
       "is_negative_unit_price, is_missing_sku, is_missing_description, source_file_name, raw_record_id, transaction_index, source_client")
CTES["fact_item"] = f"""SELECT {big("row_number() OVER (ORDER BY md5(i.source_client || '|' || i.transaction_id || '|' || i.line_number), i.transaction_id, i.line_number)")} AS transaction_item_sk,
      h.transaction_sk, coalesce(p.product_sk, -1) AS product_sk, h.order_date_sk, i.transaction_id, i.line_number, i.sku, i.quantity, i.quantity_abs,
      i.unit_price, i.unit_price_abs, i.line_total,
      coalesce(abs(i.line_total), try_cast(CAST(i.quantity_abs AS DECIMAL(18,0)) * i.unit_price_abs AS DECIMAL(18,4))) AS line_total_abs,
      i.currency, i.description, {ITEM_DQ.replace('is_', 'i.is_')} AS dq_status, i.is_negative_quantity AS has_negative_quantity,
      i.is_negative_unit_price AS has_negative_price, i.is_missing_sku, i.is_missing_description, i.source_file_name, i.source_client, i.item_metadata
      FROM ({first_rows(f"(SELECT {_FI}, {_META_A} AS item_metadata FROM stg_a_items UNION ALL SELECT {_FI}, NULL FROM stg_c_items)", "source_client, transaction_id, line_number", "source_file_name, raw_record_id, transaction_index")}) i
      JOIN fact_ac h ON h.transaction_id = i.transaction_id AND h.source_client = i.source_client
      LEFT JOIN dim_product p ON p.sku = i.sku WHERE i.transaction_id <> ''"""
CTES["item_sums"] = """SELECT transaction_sk, count(*) AS item_count, CAST(sum(line_total) AS DECIMAL(18,4)) AS total_line_amount,
      CAST(sum(line_total_abs) AS DECIMAL(18,4)) AS total_line_amount_abs FROM fact_item GROUP BY transaction_sk"""
CTES["fact"] = """SELECT f.*, s.item_count, s.total_line_amount, s.total_line_amount_abs,
      CASE WHEN s.item_count IS NOT NULL THEN CAST(f.payment_amount_abs - s.total_line_amount_abs AS DECIMAL(18,4)) END AS amount_variance,
      CASE WHEN s.item_count IS NOT NULL THEN abs(coalesce(f.payment_amount_abs, 0) - coalesce(s.total_line_amount_abs, 0)) > 0.01 ELSE false END AS has_amount_variance
      FROM fact_ac f LEFT JOIN item_sums s USING (transaction_sk)"""
CTES["fact_order"] = f"""SELECT {big('row_number() OVER (ORDER BY md5(o.order_id), o.order_id)')} AS order_sk, o.order_id,
      coalesce(c.customer_sk, -1) AS customer_sk, {date_sk('o.order_date')} AS order_date_sk, {big('s.order_status_sk')} AS order_status_sk,
      o.customer_id, o.order_date, o.total_amount, o.currency, o.status, o.source_file_name,
      CASE WHEN is_missing_order_id THEN 'INVALID' WHEN is_missing_customer_id OR is_invalid_order_date OR is_negative_amount THEN 'WARNING' ELSE 'VALID' END AS dq_status,
      is_missing_order_id OR is_missing_customer_id OR is_negative_amount AS has_dq_issues, o.raw_record_id, o.record_hash
      FROM ({first_rows("(SELECT * FROM stg_orders WHERE order_id IS NOT NULL)", "order_id", "source_file_name, raw_record_id")}) o
      LEFT JOIN dim_customer c ON c.customer_id = o.customer_id LEFT JOIN dim_order_status s ON s.status_code = upper(o.status)"""
CTES["fact_payment"] = f"""SELECT {big('row_number() OVER (ORDER BY md5(p.payment_id), p.payment_id)')} AS payment_sk, p.payment_id, p.order_id, p.transaction_id,
      {big('coalesce(m.payment_method_sk, 7)')} AS payment_method_sk, {date_sk('p.payment_date')} AS payment_date_sk, p.amount, abs(p.amount) AS amount_abs,
      p.currency, p.status, p.payment_date, p.source_file_name,
      CASE WHEN is_missing_payment_id THEN 'INVALID' WHEN is_negative_amount THEN 'WARNING' ELSE 'VALID' END AS dq_status, is_negative_amount, p.raw_record_id
      FROM (SELECT * FROM stg_payments WHERE payment_id IS NOT NULL) p LEFT JOIN dim_payment_method m ON m.payment_method_code = p.payment_method"""

# ---- data quality ---------------------------------------------------------


def _dups(stg, client, key, label, how):
    return f"""SELECT '{BATCH}' AS batch_id, '{client}' AS source_client, '{label}' AS duplicate_type, {key} AS duplicate_key, sha256({key}) AS duplicate_key_hash,
      count(*) AS occurrence_count, min(source_file_name) AS first_occurrence_file,
      list_sort(list(DISTINCT source_file_name)) AS all_occurrence_files, '{how}' AS resolution_method
      FROM {stg} WHERE trim({key}) <> '' GROUP BY {key} HAVING count(*) > 1"""


CTES["tracker"] = " UNION ALL ".join([
    _dups("stg_a", "ClientA", "transaction_id", "TRANSACTION_ID", "KEEP_FIRST"),
    _dups("stg_c", "ClientC", "transaction_id", "TRANSACTION_ID", "KEEP_FIRST"),
    _dups("stg_a", "ClientA", "order_id", "ORDER_ID", "ALLOW_MULTIPLE"),
])
CTES["dup_issues"] = f"""SELECT '{BATCH}' AS batch_id, source_client, CAST(NULL AS VARCHAR) AS source_file_name,
      'staging.stg_client_' || lower(right(source_client, 1)) || '_transactions' AS source_table, CAST(NULL AS VARCHAR) AS target_table,
      'DUPLICATE_' || duplicate_type AS issue_type, 'UNIQUENESS' AS issue_category,
      CASE WHEN duplicate_type = 'TRANSACTION_ID' THEN 'CRITICAL' ELSE 'WARNING' END AS issue_severity,
      'Found ' || occurrence_count || ' occurrences of ' || duplicate_type || ' = ' || duplicate_key AS issue_description,
      duplicate_key AS record_identifier, CAST(NULL AS VARCHAR) AS field_name, CAST(NULL AS VARCHAR) AS field_value_raw,
      CAST(NULL AS VARCHAR) AS field_value_expected FROM tracker"""


def _issue(stg, letter, items, target, kind, category, severity, text, ident, field, raw, expected, where):
    table = f"staging.stg_client_{letter}_transaction" + ("_items" if items else "s")
    exp = f"'{expected}'" if expected else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{BATCH}' AS batch_id, source_client, source_file_name, '{table}' AS source_table, 'canonical.{target}' AS target_table,
      '{kind}' AS issue_type, '{category}' AS issue_category, '{severity}' AS issue_severity, {text} AS issue_description,
      {ident} AS record_identifier, '{field}' AS field_name, {raw} AS field_value_raw, {exp} AS field_value_expected FROM {stg} WHERE {where}"""


_NO_ID = "coalesce(order_id, 'UNKNOWN_' || raw_record_id)"
_LINE = "transaction_id || '-' || coalesce(sku, 'LINE_' || line_number)"
_HAS = " AND NOT is_missing_transaction_id"


def _issues_a():
    h = lambda *a: _issue("stg_a", "a", False, *a)
    i = lambda *a: _issue("stg_a_items", "a", True, *a)
    ft, fi = "fact_transaction", "fact_transaction_item"
    return " UNION ALL ".join([
        h(ft, "MISSING_TRANSACTION_ID", "COMPLETENESS", "CRITICAL", "'Transaction ID is missing or empty'", _NO_ID, "transaction_id", "transaction_id_raw", None, "is_missing_transaction_id"),
        h(ft, "MISSING_CUSTOMER_ID", "COMPLETENESS", "HIGH", "'Customer ID is missing or empty'", "transaction_id", "customer_id", "customer_id_raw", None, "is_missing_customer_id" + _HAS),
        h(ft, "MISSING_ORDER_ID", "COMPLETENESS", "HIGH", "'Order ID is missing or empty'", "transaction_id", "order_id", "order_id_raw", None, "is_missing_order_id" + _HAS),
        h(ft, "MISSING_ORDER_DATE", "COMPLETENESS", "MEDIUM", "'Order date is missing or empty'", "transaction_id", "order_date", "order_date_raw", None, "is_missing_order_date" + _HAS),
        h("dim_customer", "INVALID_EMAIL_FORMAT", "FORMAT", "LOW", "'Email format is invalid'", "transaction_id", "email", "email_raw", "user@domain.com", "email_validation_status = 'INVALID'"),
        h(ft, "MISSING_PAYMENT_METHOD", "COMPLETENESS", "MEDIUM", "'Payment method is missing or empty'", "transaction_id", "payment_method", "payment_method_raw", None, "is_missing_payment_method" + _HAS),
        h(ft, "NEGATIVE_PAYMENT_AMOUNT", "VALIDITY", "HIGH", "'Payment amount is negative: ' || payment_amount_raw", "transaction_id", "payment_amount", "payment_amount_raw", ">= 0", "is_negative_payment_amount"),
        i(fi, "NEGATIVE_QUANTITY", "VALIDITY", "HIGH", "'Item quantity is negative: ' || quantity_raw", _LINE, "quantity", "quantity_raw", ">= 0", "is_negative_quantity"),
        i(fi, "NEGATIVE_UNIT_PRICE", "VALIDITY", "HIGH", "'Unit price is negative: ' || unit_price_raw", _LINE, "unit_price", "unit_price_raw", ">= 0", "is_negative_unit_price"),
        i(fi, "MISSING_SKU", "COMPLETENESS", "MEDIUM", "'Item SKU is missing or empty'", "transaction_id || '-LINE_' || line_number", "sku", "sku_raw", None, "is_missing_sku"),
    ])


def _issues_c():
    h = lambda *a: _issue("stg_c", "c", False, *a)
    i = lambda *a: _issue("stg_c_items", "c", True, *a)
    ft, fi = "fact_transaction", "fact_transaction_item"
    return " UNION ALL ".join([
        h(ft, "MISSING_TRANSACTION_ID", "COMPLETENESS", "CRITICAL", "'Transaction ID is missing or empty'", _NO_ID, "transaction_id", "transaction_id_raw", None, "is_missing_transaction_id"),
        h(ft, "NEGATIVE_PAYMENT_AMOUNT", "VALIDITY", "HIGH", "'Payment amount is negative: ' || payment_amount_raw", "transaction_id", "payment_amount", "payment_amount_raw", None, "is_negative_payment_amount"),
        i(fi, "NEGATIVE_QUANTITY", "VALIDITY", "HIGH", "'Item quantity is negative: ' || quantity_raw", _LINE, "quantity", "quantity_raw", None, "is_negative_quantity"),
    ])


CTES["issues_a"] = _issues_a()
CTES["issues_c"] = _issues_c()
CTES["mismatches"] = f"""SELECT '{BATCH}' AS batch_id, source_client, CAST(NULL AS VARCHAR) AS source_file_name, 'canonical.fact_transaction' AS source_table,
      'canonical.fact_transaction' AS target_table, 'AMOUNT_MISMATCH' AS issue_type, 'CONSISTENCY' AS issue_category, 'WARNING' AS issue_severity,
      'Payment amount (' || CAST(payment_amount_abs AS VARCHAR) || ') does not match line total (' || CAST(total_line_amount_abs AS VARCHAR) || ')' AS issue_description,
      transaction_id AS record_identifier, 'payment_amount vs total_line_amount' AS field_name,
      CAST(payment_amount_abs AS VARCHAR) AS field_value_raw, CAST(total_line_amount_abs AS VARCHAR) AS field_value_expected
      FROM fact WHERE total_line_amount_abs IS NOT NULL AND payment_amount_abs IS NOT NULL AND abs(payment_amount_abs - total_line_amount_abs) > 0.01
      AND abs(payment_amount_abs - total_line_amount_abs) / nullif(payment_amount_abs, 0) > 0.05"""
CTES["issues"] = "SELECT * FROM dup_issues UNION ALL SELECT * FROM issues_a UNION ALL SELECT * FROM issues_c UNION ALL SELECT * FROM mismatches"
CTES["metrics"] = f"""SELECT '{BATCH}' AS batch_id, DATE '{AS_OF[:10]}' AS metric_date, s.source_client, s.n AS total_records_received,
      coalesce(c.n, 0) AS total_records_processed, coalesce(c.n, 0) AS total_records_loaded, {big('coalesce(c.rej, 0)')} AS total_records_rejected,
      {big('coalesce(c.warn, 0)')} AS total_records_warning, {big('coalesce(i.miss, 0)')} AS missing_field_count, {big('coalesce(i.fmt, 0)')} AS invalid_format_count,
      {big('coalesce(i.val, 0)')} AS invalid_value_count, {big('coalesce(i.neg, 0)')} AS negative_value_count, coalesce(d.n, 0) AS duplicate_count,
      {pct('coalesce(c.rej, 0)', 's.n')} AS rejection_rate, {pct('coalesce(c.warn, 0)', 's.n')} AS warning_rate,
      CAST(100 - {pct('coalesce(i.miss, 0) + coalesce(i.val, 0)', 's.n')} AS DECIMAL(9,2)) AS data_quality_score
      FROM (SELECT 'ClientA' AS source_client, count(*) AS n FROM stg_a UNION ALL SELECT 'ClientC', count(*) FROM stg_c) s
      LEFT JOIN (SELECT source_client, count(*) AS n, sum(CASE WHEN dq_status = 'INVALID' THEN 1 ELSE 0 END) AS rej,
        sum(CASE WHEN dq_status = 'WARNING' THEN 1 ELSE 0 END) AS warn FROM fact GROUP BY 1) c ON c.source_client = s.source_client
      LEFT JOIN (SELECT source_client, sum(CASE WHEN issue_category = 'COMPLETENESS' THEN 1 ELSE 0 END) AS miss,
        sum(CASE WHEN issue_category = 'FORMAT' THEN 1 ELSE 0 END) AS fmt, sum(CASE WHEN issue_category = 'VALIDITY' THEN 1 ELSE 0 END) AS val,
        sum(CASE WHEN issue_type LIKE 'NEGATIVE%' THEN 1 ELSE 0 END) AS neg FROM issues GROUP BY 1) i ON i.source_client = s.source_client
      LEFT JOIN (SELECT source_client, count(*) AS n FROM tracker GROUP BY 1) d ON d.source_client = s.source_client"""


def statement(final: str) -> str:
    """``final`` preceded by the common table expressions it needs, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(final)
    parts = ", ".join(f"{n} AS ({sql.format(**TABLES) if n in _TEMPLATES else sql})" for n, sql in CTES.items() if n in needed)
    return f"WITH {parts} {final}" if parts else final


# entries that still hold table placeholders
_TEMPLATES = {"raw_customers", "raw_customers_2", "raw_orders", "raw_products", "raw_payments", "raw_lines", "landed_a", "raw_headers_c", "raw_items_c"}
