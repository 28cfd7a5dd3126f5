"""Messy landing rows derived from the driver tables.

The SQL here runs unchanged on Spark and on the checking engine. Spark turns
the rows into XML, JSON and CSV and stages those; the checks compute what
staging must give straight from these rows. All derivations use integer
arithmetic on keys. A document holds the orders of one key range, so the
number of documents grows with the data and their size does not.
"""

from __future__ import annotations

AS_OF = "2025-01-15 10:00:00"
AS_OF_2 = "2025-02-15 10:00:00"
BATCH = "BATCH_1"


def s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def money(x: str) -> str:
    return s(f"CAST({x} AS DECIMAL(18,2))")


def div(x: str, n: int) -> str:
    return f"CAST(({x} - {x} % {n}) / {n} AS BIGINT)"


_DAY = s("CAST(o_orderdate AS DATE)")
ORDER_DATE = (
    f"CASE WHEN o_orderkey % 45 = 7 THEN '' WHEN o_orderkey % 5 IN (0, 1, 2) THEN {_DAY} "
    f"WHEN o_orderkey % 5 = 3 THEN substr({_DAY}, 6, 2) || '/' || substr({_DAY}, 9, 2) || '/' || substr({_DAY}, 1, 4) "
    "ELSE 'not-a-date' END"
)
METHOD = (
    "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Credit Card' WHEN '2' THEN 'dc' WHEN '3' THEN 'PayPal' "
    "WHEN '4' THEN '' ELSE 'crypto' END"
)
CURRENCY = "CASE o_orderkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE '' END"
STATUS = (
    "CASE WHEN o_orderkey % 30 = 11 THEN 'weird' WHEN o_orderstatus = 'F' THEN 'completed' "
    "WHEN o_orderstatus = 'O' THEN 'Pending ' ELSE 'processing' END"
)
SIGN = "CASE WHEN o_orderkey % 13 = 0 THEN '-' ELSE '' END"
TOTAL = f"{SIGN} || {money('o_totalprice')}"

# ---- CSV landing ----------------------------------------------------------

def _customer_rows(where: str, changed: str, copy: int) -> str:
    key = s("c_custkey")
    email = (
        "CASE WHEN c_custkey % 20 = 3 THEN '' WHEN c_custkey % 20 = 4 THEN 'invalid-email' "
        f"WHEN {changed} THEN 'changed' || {key} || '@Example.COM' ELSE 'USER' || {key} || '@Example.COM' END"
    )
    return f"""
    SELECT c_custkey * 2 + {copy} AS raw_record_id,
      CASE WHEN c_custkey % 50 = 0 THEN '' WHEN c_custkey % 50 = 1 THEN '   ' ELSE ' cust-a-' || {key} || ' ' END AS customer_id_raw,
      CASE WHEN c_custkey % 40 = 7 THEN '' ELSE lower(c_mktsegment) END AS first_name_raw,
      CASE c_custkey % 4 WHEN 0 THEN 'CUSTOMER' WHEN 1 THEN 'smith-JONES' WHEN 2 THEN 'o' || chr(39) || 'neil (jr.)' ELSE ' van der_berg' END AS last_name_raw,
      {email} AS email_raw,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'gold' WHEN 'MACHINERY' THEN 'Silver' WHEN 'AUTOMOBILE' THEN ' PLATINUM ' WHEN 'HOUSEHOLD' THEN 'bronze' ELSE 'vip' END AS loyalty_tier_raw,
      CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' web' || {s('c_custkey % 3')} || ' ' END AS signup_source_raw,
      CASE c_custkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN '0' WHEN 2 THEN 'T' WHEN 3 THEN 'n' WHEN 4 THEN 'maybe' ELSE '' END AS is_active_raw,
      CASE WHEN (c_custkey + {copy}) % 2 = 0 THEN 'Customer.csv' ELSE 'Customer.CSV' END AS source_file_name,
      c_custkey + 1 AS file_row_number
    FROM {{customer}} WHERE {where}"""


def customers(day: int = 1) -> str:
    """Customer rows; every thirtieth customer is in both files. On day 2 some e-mails differ."""
    changed = "c_custkey % 10 = 0" if day == 2 else "1 = 0"
    return f"{_customer_rows('1 = 1', changed, 0)} UNION ALL {_customer_rows('c_custkey % 30 = 5', '1 = 1', 1)}"


CUSTOMERS = customers(1)
CUSTOMERS_DAY_2 = customers(2)

ORDERS = f"""
    SELECT o_orderkey + 1 AS raw_record_id,
      CASE WHEN o_orderkey % 60 = 0 THEN '' ELSE 'ord-' || {s('o_orderkey')} END AS order_id_raw,
      CASE WHEN o_orderkey % 45 = 5 THEN '' ELSE 'cust-a-' || {s('o_custkey')} END AS customer_id_raw,
      {ORDER_DATE} AS order_date_raw,
      {STATUS} AS status_raw,
      {TOTAL} AS total_amount_raw,
      {CURRENCY} AS currency_raw,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Orders.csv' ELSE 'Order.csv' END AS source_file_name,
      o_orderkey + 1 AS file_row_number
    FROM {{orders}}"""

PRODUCTS = f"""
    SELECT p_partkey + 1 AS raw_record_id,
      'p-' || {s('p_partkey')} AS product_id_raw,
      CASE WHEN p_partkey % 25 = 0 THEN '' ELSE 'sku-' || {s('p_partkey')} END AS sku_raw,
      CASE WHEN p_partkey % 35 = 4 THEN '' ELSE ' ' || p_name || ' ' END AS product_name_raw,
      p_type || ' ' || p_brand AS description_raw,
      lower(p_type) AS category_raw,
      CASE WHEN p_partkey % 31 = 0 THEN '-' ELSE '' END || {money('p_retailprice')} AS price_raw,
      CASE p_partkey % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE '' END AS currency_raw,
      'Products.csv' AS source_file_name,
      p_partkey + 1 AS file_row_number
    FROM {{part}}"""

PAYMENTS = f"""
    SELECT o_orderkey + 1 AS raw_record_id,
      CASE WHEN o_orderkey % 70 = 0 THEN '' ELSE 'pay-' || {s('o_orderkey')} END AS payment_id_raw,
      'ord-' || {s('o_orderkey')} AS order_id_raw,
      'txn-' || {s('o_orderkey')} AS transaction_id_raw,
      {METHOD} AS payment_method_raw,
      {TOTAL} AS amount_raw,
      {CURRENCY} AS currency_raw,
      {ORDER_DATE} AS payment_date_raw,
      {STATUS} AS status_raw,
      'Payments.csv' AS source_file_name,
      o_orderkey + 1 AS file_row_number
    FROM {{orders}}"""

# ---- transaction lines, shared by both clients ----------------------------

LINES = f"""
    SELECT l_orderkey AS o, l_partkey AS p,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
        l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line,
      CAST(l_quantity AS DECIMAL(18,0)) AS qty,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS price
    FROM {{lineitem}}"""

# defects depend on order plus line, so that they fall on different lines
ITEM_TEXT = f"""
    SELECT o, line,
      CASE WHEN (o + line) % 25 = 0 THEN '' ELSE 'sku-' || {s('p')} END AS sku_text,
      CASE WHEN (o + line) % 40 = 3 THEN '' ELSE 'part ' || {s('p')} END AS description_text,
      CASE WHEN (o + line) % 31 = 0 THEN '0' WHEN (o + line) % 33 = 5 THEN 'many' WHEN (o + line) % 29 = 0 THEN '-' || {s('qty')} ELSE {s('qty')} END AS quantity_text,
      CASE WHEN (o + line) % 41 = 0 THEN '0.00' WHEN (o + line) % 37 = 0 THEN '-' || {s('price')} ELSE {s('price')} END AS unit_price_text,
      CASE (o + line) % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE '' END AS currency_text,
      CASE WHEN (o + line) % 43 = 0 THEN '<Color>red</Color>' END AS attributes_extra,
      CASE WHEN (o + line) % 47 = 0 THEN '<Months>12</Months>' END AS warranty_extra,
      CASE WHEN (o + line) % 53 = 0 THEN '<Wrap>yes</Wrap>' END AS gift_options_extra
    FROM ({LINES}) AS lines"""

# what a payment would have to be: the sum of the absolute line totals
LINE_SUM = """CAST(sum(
        CASE WHEN (o + line) % 31 = 0 OR (o + line) % 33 = 5 OR (o + line) % 41 = 0 THEN CAST(0 AS DECIMAL(18,0)) ELSE qty END * price
      ) AS DECIMAL(18,2))"""
LINE_SUMS = f"""
    SELECT o, {LINE_SUM} AS line_sum
    FROM ({LINES}) AS lines GROUP BY o"""

_AMOUNT = f"""{SIGN} || {s('''CAST(CASE WHEN o_orderkey % 8 IN (0, 1) THEN coalesce(line_sum, CAST(o_totalprice AS DECIMAL(18,2)))
        WHEN o_orderkey % 8 IN (2, 3) THEN coalesce(line_sum, CAST(o_totalprice AS DECIMAL(18,2))) + CAST(10 AS DECIMAL(18,2))
        ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2))''')}"""

# an order is emitted again, in a document of its own kind, where the key is a multiple of 97 (A) or one more (C)
_COPIES = "(SELECT 0 AS copy UNION ALL SELECT 1 AS copy)"


def _documents(parity: int) -> str:
    return f"""
    SELECT orders_.*, copies.copy,
      CASE WHEN copies.copy = 0 THEN {div('o_orderkey', 512)} ELSE 1000000000 + {div('o_orderkey', 16384)} END AS doc
    FROM {{orders}} AS orders_ JOIN {_COPIES} AS copies
      ON copies.copy = 0 OR orders_.o_orderkey % 97 = {parity}
    WHERE o_orderkey % 2 = {parity}"""


def orders_with_sums(parity: int) -> str:
    """The orders of one client as emitted, with what their lines sum up to."""
    return f"FROM ({_documents(parity)}) AS documents_ LEFT JOIN ({LINE_SUMS}) AS sums ON sums.o = o_orderkey"


HEADERS_A = f"""
    SELECT o_orderkey AS o, copy, doc, CASE WHEN doc % 4 = 3 THEN 1 ELSE 0 END AS is_txt,
      CASE WHEN doc % 16 = 15 THEN 1 ELSE 0 END AS is_broken,
      row_number() OVER (PARTITION BY doc ORDER BY o_orderkey) - 1 AS transaction_index,
      'ClientA_Transactions_' || {s('doc')} || CASE WHEN doc % 4 = 3 THEN '.txt' ELSE '.xml' END AS source_file_name,
      doc + 1 AS raw_record_id,
      CASE WHEN o_orderkey % 60 = 0 THEN '' ELSE 'txn-' || {s('o_orderkey')} END AS transaction_id_raw,
      CASE WHEN o_orderkey % 70 = 2 THEN '' WHEN o_orderkey % 90 = 4 THEN 'ord-' || {s('o_orderkey - 2')} ELSE 'ord-' || {s('o_orderkey')} END AS order_id_raw,
      {ORDER_DATE} AS order_date_raw,
      CASE WHEN o_orderkey % 46 = 6 THEN '' ELSE 'cust-a-' || {s('o_custkey')} END AS customer_id_raw,
      CASE WHEN o_orderkey % 40 = 8 THEN '' ELSE lower(substr(o_orderpriority, 3)) END AS first_name_raw,
      CASE WHEN o_orderkey % 44 = 8 THEN '' ELSE 'smith-JONES' END AS last_name_raw,
      CASE WHEN o_orderkey % 20 = 4 THEN '' WHEN o_orderkey % 20 = 6 THEN 'invalid-email' ELSE 'USER' || {s('o_custkey')} || '@Example.COM' END AS email_raw,
      {METHOD} AS payment_method_raw,
      CASE WHEN o_orderkey % 26 = 14 THEN '' ELSE {_AMOUNT} END AS payment_amount_raw,
      {CURRENCY} AS payment_currency_raw,
      CASE WHEN o_orderkey % 16 = 2 THEN 'gold' WHEN o_orderkey % 16 = 4 THEN 'vip' END AS loyalty_tier_extra,
      CASE WHEN o_orderkey % 18 = 4 THEN '<Source>web</Source>' END AS metadata_extra,
      CASE WHEN o_orderkey % 22 = 6 THEN '<Tag>a</Tag><Tag>b</Tag>' END AS tags_extra,
      CASE WHEN o_orderkey % 26 = 8 THEN 'call back' END AS notes_extra,
      CASE WHEN o_orderkey % 28 = 10 THEN '<Newsletter>no</Newsletter>' END AS preferences_extra,
      CASE WHEN o_orderkey % 32 = 12 THEN '<Vip>yes</Vip>' END AS flags_extra,
      CASE WHEN o_orderkey % 34 = 14 THEN '<Segment>x</Segment>' END AS attributes_extra,
      CASE WHEN o_orderkey % 36 = 16 THEN '<Fee>1.50</Fee>' END AS fees_extra
    {orders_with_sums(0)}"""

_FULL_NAME = "CASE o_orderkey % 20 WHEN 1 THEN 'ada lovelace king' WHEN 11 THEN 'plato' END"
_TIER = "CASE o_custkey % 5 WHEN 0 THEN 'Gold ' WHEN 1 THEN 'vip' WHEN 2 THEN 'silver' WHEN 3 THEN 'BRONZE' ELSE 'none' END"
HEADERS_C = f"""
    SELECT o_orderkey AS o, copy, doc,
      row_number() OVER (PARTITION BY doc ORDER BY o_orderkey) - 1 AS transaction_index,
      'transactions_' || {s('doc')} || '.json' AS source_file_name,
      doc + 1 AS raw_record_id,
      CASE WHEN o_orderkey % 3 = 1 THEN NULL WHEN o_orderkey % 60 = 15 THEN '' WHEN o_orderkey % 60 = 45 THEN '   ' ELSE ' txn-' || {s('o_orderkey')} END AS transaction_id_raw,
      CASE WHEN o_orderkey % 3 = 1 THEN 'txn-' || {s('o_orderkey')} WHEN o_orderkey % 60 = 15 THEN 'alt-' || {s('o_orderkey')} END AS transaction_id_alt_raw,
      CASE WHEN o_orderkey % 70 = 3 THEN '' ELSE 'ord-' || {s('o_orderkey')} END AS order_id_raw,
      {ORDER_DATE} AS order_date_raw,
      {STATUS} AS order_status_raw,
      CASE WHEN o_orderkey % 4 = 1 THEN CASE WHEN o_orderkey % 44 = 5 THEN '' ELSE 'cust-a-' || {s('o_custkey')} END END AS customer_id_raw,
      CASE WHEN o_orderkey % 4 = 3 THEN 'cust-c-' || {s('o_custkey % 50')} END AS customer_id_alt_raw,
      CASE WHEN o_orderkey % 5 = 1 THEN NULL WHEN o_orderkey % 40 = 9 THEN '' ELSE lower(substr(o_orderpriority, 3)) END AS first_name_raw,
      CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE 'mc-DONALD' END AS last_name_raw,
      CASE WHEN o_orderkey % 5 = 1 THEN {_FULL_NAME} END AS full_name_raw,
      CASE WHEN o_orderkey % 20 = 3 THEN '' WHEN o_orderkey % 20 = 5 THEN 'invalid-email' ELSE 'USER' || {s('o_custkey')} || '@Example.COM' END AS email_raw,
      CASE WHEN o_orderkey % 7 < 3 THEN {_TIER} END AS loyalty_tier_raw,
      CASE WHEN o_orderkey % 7 IN (3, 4) THEN {_TIER} END AS tier_alt_raw,
      CASE WHEN o_orderkey % 9 < 5 THEN {METHOD} END AS payment_method_raw,
      CASE WHEN o_orderkey % 9 IN (5, 6, 7) THEN {METHOD} END AS payment_method_alt_raw,
      CASE WHEN o_orderkey % 11 < 6 THEN {_AMOUNT} END AS payment_amount_raw,
      CASE WHEN o_orderkey % 11 IN (6, 7, 8, 9) THEN {_AMOUNT} END AS payment_total_alt_raw,
      {CURRENCY} AS payment_currency_raw
    {orders_with_sums(1)}"""

ITEMS_C = f"""
    SELECT o, line,
      CASE WHEN o % 7 = 2 THEN NULL ELSE sku_text END AS sku_raw,
      CASE WHEN o % 7 = 2 THEN sku_text END AS product_id_raw,
      CASE WHEN o % 7 = 3 THEN NULL ELSE description_text END AS description_raw,
      CASE WHEN o % 7 = 3 THEN description_text END AS name_raw,
      CASE WHEN o % 7 = 1 THEN NULL ELSE quantity_text END AS quantity_raw,
      CASE WHEN o % 7 = 1 THEN quantity_text END AS qty_alt_raw,
      CASE WHEN o % 7 = 1 THEN NULL ELSE unit_price_text END AS unit_price_raw,
      CASE WHEN o % 7 = 1 THEN unit_price_text END AS price_alt_raw,
      currency_text AS currency_raw
    FROM ({ITEM_TEXT}) AS item_text"""
