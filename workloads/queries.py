"""The registered queries. Every one runs over whole tables; ``sql`` is the statement it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerloom import functions as x
from ledgerloom.operators import changes, dates, dims, facts, keys, lookups, quality, seeds, staging_csv, staging_json, staging_xml, unify
from ledgerloom.plans import operations, reports
from ledgerloom.plans.staging import materialize_staging
from ledgerloom.plans.store import TableStore
from ledgerloom.session import configure, fresh_path
from ledgerloom.sources import csv_files, documents, files, formats
from ledgerloom.sources.audit import audit_for_batch, write_audit_log
from ledgerloom.streaming.ingest import file_stream, incremental_file_ingest

from . import oracle as o, truth
from .truth import AS_OF, AS_OF_2, BATCH
from .warehouse import Warehouse, warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
c = F.col


def query(name: str, sql: str | None = None):
    """Register a query; its function gets the warehouse of the scale at hand."""

    def register(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(warehouse(configure(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = o.statement(sql)
        return fn

    return register


def pick(df: DataFrame, columns: str) -> DataFrame:
    """The named columns, 32-bit integers widened."""
    names = [n.strip() for n in columns.split(",")]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[c(n).cast("bigint").alias(n) if isinstance(kinds[n], T.IntegerType) else c(n) for n in names])


def same(name: str, columns: str, table: str, where: str = ""):
    """Register a query whose columns carry the same names as those of a check table."""
    return query(name, f"SELECT {columns} FROM {table} {where}")


# ---- sources --------------------------------------------------------------

_XML_FIELDS = "transaction_id_raw, order_id_raw, order_date_raw, customer_id_raw, payment_method_raw, payment_amount_raw"


@query("read_xml_documents", f"SELECT {_XML_FIELDS.replace('payment_amount_raw', 'nullif(payment_amount_raw, ' + chr(39) * 2 + ') AS payment_amount_raw')}, "
       "(SELECT count(*) FROM raw_lines l WHERE l.o = landed_a.o) AS item_count FROM landed_a")
def read_xml_documents(w):
    flat = staging_xml.extract_xml_fields(staging_xml.read_xml_transactions(w.spark, w.inputs.xml_files(), BATCH, AS_OF))
    counted = flat.withColumn("item_count", F.coalesce(F.size("items"), F.lit(0)))
    return pick(counted, f"{_XML_FIELDS}, item_count")


@query("read_xml_records", "SELECT transaction_id_raw, order_id_raw, customer_id_raw, (SELECT count(*) FROM raw_lines l WHERE l.o = landed_a.o) AS item_count FROM landed_a")
def read_xml_records(w):
    records = documents.read_xml_records(w.spark, w.inputs.xml_files(), BATCH, AS_OF)
    flat = staging_xml.extract_xml_fields(staging_xml.parse_xml_records(records))
    counted = flat.withColumn("item_count", F.coalesce(F.size("items"), F.lit(0)))
    return pick(counted, "transaction_id_raw, order_id_raw, customer_id_raw, item_count")


@query("read_txt_documents", "SELECT transaction_id_raw, order_id_raw, transaction_index FROM landed_a WHERE is_txt = 1 AND is_broken = 0")
def read_txt_documents(w):
    path = w.inputs.document_files(w.inputs.txt_docs, "raw_text_content", "txt")
    flat = staging_xml.read_xml_transactions(w.spark, path, BATCH, AS_OF)
    return pick(staging_xml.extract_xml_fields(flat), "transaction_id_raw, order_id_raw, transaction_index")


@query("parse_txt_xml", "SELECT DISTINCT source_file_name, is_broken = 0 AS xml_parse_success, "
       "CASE WHEN is_broken = 1 THEN 'Failed to parse XML from text content' END AS xml_parse_error FROM landed_a WHERE is_txt = 1")
def parse_txt_xml(w):
    return w.inputs.parsed_txt_docs.select("source_file_name", "xml_parse_success", "xml_parse_error")


_JSON_FIELDS = "transaction_id_raw, transaction_id_alt_raw, order_id_raw, customer_id_alt_raw"


@same("read_json_documents", _JSON_FIELDS, "raw_headers_c")
def read_json_documents(w):
    docs = documents.read_json_documents(w.spark, w.inputs.json_files(), BATCH, AS_OF)
    return pick(staging_json.extract_json_fields(staging_json.flatten_json_transactions(docs)), _JSON_FIELDS)


@same("read_json_lines", _JSON_FIELDS, "raw_headers_c")
def read_json_lines(w):
    docs = documents.read_json_documents(w.spark, w.inputs.json_files(), BATCH, AS_OF, lines=True)
    return pick(staging_json.extract_json_fields(staging_json.flatten_json_transactions(docs)), _JSON_FIELDS)


@query("read_json_array", "SELECT source_file_name, transaction_index AS element_index, order_id_raw AS order_id FROM raw_headers_c WHERE doc % 2 = 1")
def read_json_array(w):
    elements = documents.read_json_array(w.inputs.json_docs)
    return elements.select(
        "source_file_name", c("element_index").cast("bigint").alias("element_index"),
        F.try_variant_get("element", "$.order.order_id", "string").alias("order_id"),
    )


def _read_csv(name: str, reader, sql: str, entity: formats.CsvEntity, table: str) -> None:
    tokens = ", ".join(f"'{t}'" for t in formats.CSV_NULL_TOKENS)
    clean = {n: f"CASE WHEN trim({n}) NOT IN ({tokens}) THEN trim({n}) END" for n in entity.raw_columns}
    columns = ", ".join(f"{e} AS {n}" for n, e in clean.items())
    digest = o.sha(*[clean[f"{h}_raw"] for h in entity.hashed])

    @query(name, f"SELECT {columns}, {digest} AS record_hash FROM {table}")
    def run(w):
        path = w.inputs.csv_files(sql, entity, entity.target)
        return reader(w.spark, path, BATCH, AS_OF).select(*entity.raw_columns, "record_hash")


_read_csv("read_csv_customers", csv_files.read_csv_customers, truth.CUSTOMERS, formats.CUSTOMERS, "raw_customers")
_read_csv("read_csv_orders", csv_files.read_csv_orders, truth.ORDERS, formats.ORDERS, "raw_orders")
_read_csv("read_csv_products", csv_files.read_csv_products, truth.PRODUCTS, formats.PRODUCTS, "raw_products")
_read_csv("read_csv_payments", csv_files.read_csv_payments, truth.PAYMENTS, formats.PAYMENTS, "raw_payments")


@query("read_txt_lines", "SELECT order_id_raw || ';' || status_raw || ';' || total_amount_raw AS value FROM raw_orders")
def read_txt_lines(w):
    path = fresh_path(w.spark, "landing-lines")
    w.inputs.rows(truth.ORDERS).select(F.concat_ws(";", "order_id_raw", "status_raw", "total_amount_raw").alias("value")).write.text(path)
    return documents.read_txt_lines(w.spark, path).select("value")


@query("capture_file_metadata", "SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS misnumbered_rows FROM raw_orders")
def capture_file_metadata(w):
    path = w.inputs.csv_files(truth.ORDERS, formats.ORDERS, "metadata")
    rows = w.spark.read.schema(formats.ORDERS.reader_schema()).options(**formats.CSV_READER_OPTIONS).csv(path)
    numbered = files.capture_file_metadata(rows)
    # in every file the numbers run from 1 to its number of rows
    per_file = numbered.groupBy("source_file_path").agg(
        F.count(F.lit(1)).alias("n"), F.min("file_row_number").alias("lo"), F.max("file_row_number").alias("hi"),
        F.sum("file_row_number").alias("total"),
    )
    wrong = (c("lo") != 1) | (c("hi") != c("n")) | (c("total") * 2 != c("n") * (c("n") + 1))
    return per_file.agg(F.sum("n").alias("total_rows"), F.coalesce(F.sum(F.when(wrong, c("n")).otherwise(0)), F.lit(0)).alias("misnumbered_rows"))


_PATH_SQL = """SELECT '/in/' || CAST(o_orderkey AS STRING) || '/' || CASE o_orderkey % 10 WHEN 0 THEN 'ClientA_1.xml' WHEN 1 THEN 'clienta.xml'
    WHEN 2 THEN 'ClientB.xml' WHEN 3 THEN 'Orders.csv' WHEN 4 THEN 'order.CSV' WHEN 5 THEN 'Customer_new.csv' WHEN 6 THEN 'payments.Csv'
    WHEN 7 THEN 'products.csv.bak' WHEN 8 THEN 'transactions.json' ELSE 'ClientA_4.txt' END AS path,
    o_orderkey % 1000 AS length, o_orderdate AS modification_time, o_orderkey AS k FROM {orders}"""
_ROUTES = {
    "raw_xml_transactions": formats.XML_PATTERN, "raw_txt_xml_transactions": formats.TXT_PATTERN,
    "raw_json_transactions": formats.JSON_PATTERN, "raw_csv_customers": formats.CUSTOMERS.pattern,
    "raw_csv_orders": formats.ORDERS.pattern, "raw_csv_products": formats.PRODUCTS.pattern,
    "raw_csv_payments": formats.PAYMENTS.pattern,
}
_PATHS = _PATH_SQL.format(orders="orders")


@query("select_files_by_pattern", " UNION ALL ".join(
    f"SELECT path, '{t}' AS target_table FROM ({_PATHS}) p WHERE regexp_full_match(path, '{p}')" for t, p in _ROUTES.items()))
def select_files_by_pattern(w):
    listed = w.inputs.rows(_PATH_SQL)
    routed = [files.select_files_by_pattern(listed, p).select("path", F.lit(t).alias("target_table")) for t, p in _ROUTES.items()]
    out = routed[0]
    for part in routed[1:]:
        out = out.unionByName(part)
    return out


@query("skip_loaded_files", f"SELECT path, length FROM ({_PATHS}) f WHERE NOT (k % 3 = 0)")
def skip_loaded_files(w):
    listed = w.inputs.rows(_PATH_SQL)
    # a third is loaded; another third was loaded when the file had another size
    ledger = listed.filter("k % 3 = 0").unionByName(listed.filter("k % 3 = 1").withColumn("length", c("length") + 1))
    return files.skip_loaded_files(listed, ledger).select("path", "length")


@query("hash_document", "SELECT doc_id, sha256(text) AS record_hash FROM documents")
def hash_document(w):
    return w.inputs.table("documents").select("doc_id", documents.hash_document(c("text")).alias("record_hash"))


for _name, _entity, _sql in (
    ("customers", formats.CUSTOMERS, truth.CUSTOMERS), ("orders", formats.ORDERS, truth.ORDERS),
    ("products", formats.PRODUCTS, truth.PRODUCTS), ("payments", formats.PAYMENTS, truth.PAYMENTS),
):
    @query(f"hash_{_name}", f"SELECT raw_record_id, {o.sha(*[h + '_raw' for h in _entity.hashed])} AS record_hash FROM raw_{_name}")
    def _hash(w, name=_name, sql=_sql):
        return getattr(csv_files, f"hash_{name}")(w.inputs.rows(sql)).select("raw_record_id", "record_hash")


@query("write_audit_log", f"""SELECT '{BATCH}' AS batch_id, source_file_name, 'raw.raw_csv_orders' AS target_table,
    {o.big("sum(CASE WHEN order_id_raw <> '' THEN 1 ELSE 0 END)")} AS rows_loaded, {o.big("sum(CASE WHEN order_id_raw = '' THEN 1 ELSE 0 END)")} AS rows_rejected,
    CASE WHEN sum(CASE WHEN order_id_raw = '' THEN 1 ELSE 0 END) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status, {o.big('300')} AS duration_seconds
    FROM raw_orders GROUP BY source_file_name""")
def audit_log(w):
    raw = w.inputs.orders
    log = write_audit_log(
        raw.filter("order_id_raw != ''"), "raw.raw_csv_orders", formats.ORDERS.pattern, AS_OF, "2025-01-15 10:05:00",
        raw.filter("order_id_raw = ''"),
    )
    return log.select("batch_id", "source_file_name", "target_table", "rows_loaded", "rows_rejected", "status", "duration_seconds")


def _staging_inputs(w: Warehouse) -> dict[str, DataFrame]:
    i = w.inputs
    return {
        "xml": i.xml_docs, "txt": i.parsed_txt_docs, "json": i.json_docs, "customers": i.customers, "orders": i.orders,
        "products": i.products, "payments": i.payments,
    }


_STAGED = {
    "staging.stg_client_a_transactions": "stg_a", "staging.stg_client_a_transaction_items": "stg_a_items",
    "staging.stg_client_c_transactions": "stg_c", "staging.stg_client_c_transaction_items": "stg_c_items",
    "staging.stg_transactions": "unified", "staging.stg_transaction_items": "unified_items",
    "staging.stg_customers": "stg_customers", "staging.stg_orders": "stg_orders", "staging.stg_products": "stg_products",
    "staging.stg_payments": "stg_payments",
}


@query("materialize_staging", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in _STAGED.items()))
def stage_everything(w):
    staged = materialize_staging(TableStore(w.spark, fresh_path(w.spark, "store")), _staging_inputs(w))
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in staged.items()]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


_REJECT = "source_client, source_file_name, source_format, record_identifier, transaction_id, order_id, customer_id, rejection_reason, rejection_category"


@query("quarantine_rejects", f"""SELECT source_client, source_file_name, source_format, coalesce(transaction_id, order_id, 'UNKNOWN_' || raw_record_id) AS record_identifier,
    transaction_id, order_id, customer_id, 'Transaction ID must not be null or empty' AS rejection_reason, 'COMPLETENESS' AS rejection_category
    FROM unified WHERE is_missing_transaction_id
    UNION ALL SELECT source_client, source_file_name, source_format, transaction_id, transaction_id, order_id, customer_id, 'Transaction ID should be unique', 'UNIQUENESS'
    FROM (SELECT * FROM unified WHERE NOT is_missing_transaction_id QUALIFY row_number() OVER (PARTITION BY source_client, transaction_id ORDER BY source_file_name, raw_record_id, transaction_index) > 1) d
    UNION ALL SELECT DISTINCT 'ClientA', source_file_name, 'TXT_XML', source_file_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'Document cannot be read', 'FORMAT'
    FROM landed_a WHERE is_txt = 1 AND is_broken = 1""")
def quarantine_rejects(w):
    broken = w.inputs.parsed_txt_docs.filter("NOT xml_parse_success").select(
        "source_client", "source_file_name", "source_format", c("raw_text_content").alias("raw_record")
    )
    return pick(quality.quarantine_rejects(w.unified, BATCH, AS_OF, broken), _REJECT)


# ---- client-A staging -----------------------------------------------------


def _flat_a(w: Warehouse) -> DataFrame:
    return staging_xml.flatten_xml_transactions(staging_xml.union_xml_sources(w.inputs.xml_docs, w.inputs.parsed_txt_docs))


@query("union_xml_sources", "SELECT DISTINCT source_file_name, source_format, source_client, raw_record_id FROM stg_a")
def union_xml_sources(w):
    return staging_xml.union_xml_sources(w.inputs.xml_docs, w.inputs.parsed_txt_docs).select(
        "source_file_name", "source_format", "source_client", "raw_record_id"
    )


@same("flatten_xml_transactions", "raw_record_id, source_file_name, source_format, transaction_index, transaction_id_raw", "stg_a")
def flatten_xml_transactions(w):
    flat = _flat_a(w).withColumn("transaction_id_raw", c("transaction")["TransactionID"])
    return pick(flat, "raw_record_id, source_file_name, source_format, transaction_index, transaction_id_raw")


_RAW_A = ("raw_record_id, transaction_index, transaction_id_raw, order_id_raw, order_date_raw, customer_id_raw, first_name_raw, "
          "last_name_raw, email_raw, payment_method_raw, payment_amount_raw, payment_currency_raw")


@same("extract_xml_fields", _RAW_A, "stg_a")
def extract_xml_fields(w):
    return pick(staging_xml.extract_xml_fields(_flat_a(w)), _RAW_A)


_STD = ("raw_record_id, transaction_index, transaction_id, order_id, order_date, customer_id, first_name, last_name, email, "
        "email_validation_status, payment_method, payment_amount, payment_amount_abs, payment_currency")


@same("standardize_client_a", _STD, "stg_a")
def standardize_client_a(w):
    return pick(staging_xml.standardize_client_a(staging_xml.extract_xml_fields(_flat_a(w))), _STD)


_EXTRA_A = ("raw_record_id, transaction_index, loyalty_tier_extra, metadata_extra, tags_extra, preferences_extra, notes_extra, "
            "flags_extra, attributes_extra, fees_extra, extra_fields_summary")


@same("extract_xml_extras", _EXTRA_A, "stg_a")
def extract_xml_extras(w):
    return pick(staging_xml.extract_xml_extras(_flat_a(w)), _EXTRA_A)


_FLAGS = ("is_missing_transaction_id, is_missing_order_id, is_missing_order_date, is_invalid_order_date, is_missing_customer_id, "
          "is_missing_email, is_missing_payment_method, is_missing_payment_amount, is_negative_payment_amount")
_FLAGS_A = f"raw_record_id, transaction_index, {_FLAGS}, is_missing_first_name, is_missing_last_name"


@same("flag_client_a", _FLAGS_A, "stg_a")
def flag_client_a(w):
    standard = staging_xml.standardize_client_a(staging_xml.extract_xml_fields(_flat_a(w)))
    return pick(staging_xml.flag_client_a(standard), _FLAGS_A)


_STAGE_A = f"source_client, source_format, source_file_name, {_STD}, transaction_id_raw, extra_fields_summary, {_FLAGS}, is_missing_first_name, is_missing_last_name"


@same("stage_client_a_transactions", _STAGE_A, "stg_a")
def stage_client_a_transactions(w):
    return pick(staging_xml.stage_client_a_transactions(w.inputs.xml_docs, w.inputs.parsed_txt_docs), _STAGE_A)


@same("flatten_xml_items", "raw_record_id, transaction_index, transaction_id, order_id, line_number, sku_raw", "stg_a_items")
def flatten_xml_items(w):
    items = staging_xml.flatten_xml_items(w.stg_a).withColumn("sku_raw", c("item")["SKU"])
    return pick(items, "raw_record_id, transaction_index, transaction_id, order_id, line_number, sku_raw")


_ITEM_RAW = ("raw_record_id, transaction_index, line_number, sku_raw, description_raw, quantity_raw, unit_price_raw, currency_raw, "
             "attributes_extra, warranty_extra, gift_options_extra, item_extra_fields_summary")


@same("extract_item_fields", _ITEM_RAW, "stg_a_items")
def extract_item_fields(w):
    return pick(staging_xml.extract_item_fields(staging_xml.flatten_xml_items(w.stg_a)), _ITEM_RAW)


_ITEM_STD = ("raw_record_id, transaction_index, line_number, sku, description, quantity, quantity_abs, unit_price, unit_price_abs, "
             "currency, line_total, line_total_abs")


@same("standardize_items", _ITEM_STD, "stg_a_items")
def standardize_items(w):
    return pick(staging_xml.standardize_items(staging_xml.extract_item_fields(staging_xml.flatten_xml_items(w.stg_a))), _ITEM_STD)


_ITEM_FLAGS = ("is_missing_sku, is_missing_description, is_missing_quantity, is_negative_quantity, is_zero_quantity, "
               "is_missing_unit_price, is_negative_unit_price, is_zero_unit_price")


@same("flag_client_a_items", f"raw_record_id, transaction_index, line_number, {_ITEM_FLAGS}", "stg_a_items")
def flag_client_a_items(w):
    standard = staging_xml.standardize_items(staging_xml.extract_item_fields(staging_xml.flatten_xml_items(w.stg_a)))
    return pick(staging_xml.flag_client_a_items(standard), f"raw_record_id, transaction_index, line_number, {_ITEM_FLAGS}")


_STAGE_A_ITEMS = f"source_client, source_file_name, transaction_id, order_id, customer_id, order_date, {_ITEM_STD}, item_extra_fields_summary, {_ITEM_FLAGS}"


@same("stage_client_a_items", _STAGE_A_ITEMS, "stg_a_items")
def stage_client_a_items(w):
    return pick(staging_xml.stage_client_a_items(w.stg_a), _STAGE_A_ITEMS)


# ---- client-C staging -----------------------------------------------------


def _flat_c(w: Warehouse) -> DataFrame:
    return staging_json.flatten_json_transactions(w.inputs.json_docs)


@same("flatten_json_transactions", "raw_record_id, source_file_name, transaction_index, order_id_raw", "stg_c")
def flatten_json_transactions(w):
    flat = _flat_c(w).withColumn("order_id_raw", F.try_variant_get("transaction", "$.order.order_id", "string"))
    return pick(flat, "raw_record_id, source_file_name, transaction_index, order_id_raw")


_RAW_C = "raw_record_id, transaction_index, " + ", ".join(staging_json.TRANSACTION_PATHS)


@same("extract_json_fields", _RAW_C, "stg_c")
def extract_json_fields(w):
    return pick(staging_json.extract_json_fields(_flat_c(w)), _RAW_C)


@query("coalesce_field_variants", "SELECT raw_record_id, transaction_index, coalesce(transaction_id_raw, transaction_id_alt_raw) AS literal_id, "
       "coalesce(nullif(trim(transaction_id_raw), ''), transaction_id_alt_raw) IS NOT NULL AS has_filled_id FROM raw_headers_c")
def coalesce_field_variants(w):
    rows = staging_json.extract_json_fields(_flat_c(w))
    primary, alternate = c("transaction_id_raw"), c("transaction_id_alt_raw")
    return rows.select(
        "raw_record_id", c("transaction_index").cast("bigint").alias("transaction_index"),
        staging_json.coalesce_field_variants(primary, alternate).alias("literal_id"),
        staging_json.coalesce_field_variants(primary, alternate, empty_as_missing=True).isNotNull().alias("has_filled_id"),
    )


@same("split_full_name", "raw_record_id, transaction_index, full_name_raw, first_name, last_name", "stg_c")
def split_full_name(w):
    rows = staging_json.extract_json_fields(_flat_c(w))
    first, last = staging_json.split_full_name(c("first_name_raw"), c("last_name_raw"), c("full_name_raw"))
    return pick(rows.withColumns({"first_name": first, "last_name": last}), "raw_record_id, transaction_index, full_name_raw, first_name, last_name")


@same("standardize_client_c", f"{_STD}, loyalty_tier", "stg_c")
def standardize_client_c(w):
    return pick(staging_json.standardize_client_c(staging_json.extract_json_fields(_flat_c(w))), f"{_STD}, loyalty_tier")


@query("count_items", "SELECT raw_record_id, transaction_index, items_count FROM stg_c")
def count_items(w):
    rows = staging_json.extract_json_fields(_flat_c(w))
    return pick(rows.withColumn("items_count", staging_json.count_items(c("items"))), "raw_record_id, transaction_index, items_count")


@same("build_transaction_metadata", "raw_record_id, transaction_index, transaction_metadata", "stg_c")
def build_transaction_metadata(w):
    return pick(staging_json.build_transaction_metadata(staging_json.extract_json_fields(_flat_c(w))), "raw_record_id, transaction_index, transaction_metadata")


_FLAGS_C = f"raw_record_id, transaction_index, {_FLAGS}"


@query("flag_client_c", f"SELECT {_FLAGS_C}, items_count = 0 AS has_empty_items FROM stg_c")
def flag_client_c(w):
    standard = staging_json.standardize_client_c(staging_json.extract_json_fields(_flat_c(w)))
    flagged = staging_json.flag_client_c(standard.withColumn("items_count", staging_json.count_items(c("items"))))
    return pick(flagged, f"{_FLAGS_C}, has_empty_items")


_STAGE_C = f"source_client, source_format, source_file_name, {_STD}, loyalty_tier, items_count, transaction_metadata, {_FLAGS}"


@same("stage_client_c_transactions", _STAGE_C, "stg_c")
def stage_client_c_transactions(w):
    return pick(staging_json.stage_client_c_transactions(w.inputs.json_docs), _STAGE_C)


_STAGE_C_ITEMS = ("source_client, source_file_name, transaction_id, order_id, customer_id, order_date, " + _ITEM_STD
                  + ", is_missing_sku, is_missing_description, is_missing_quantity, is_negative_quantity, is_negative_unit_price")


@same("stage_client_c_items", _STAGE_C_ITEMS, "stg_c_items")
def stage_client_c_items(w):
    return pick(staging_json.stage_client_c_items(w.stg_c), _STAGE_C_ITEMS)


# ---- CSV staging and unification ------------------------------------------

_CSV_STAGED = {
    "customers": "customer_id, first_name, last_name, email, email_validation_status, loyalty_tier, signup_source, is_active, "
                 "is_missing_customer_id, is_missing_email, is_missing_first_name, is_missing_last_name",
    "orders": "order_id, customer_id, order_date, status, total_amount, total_amount_abs, currency, is_missing_order_id, "
              "is_missing_customer_id, is_missing_order_date, is_invalid_order_date, is_negative_amount",
    "products": "product_id, sku, product_name, description, category, price, price_abs, currency, is_missing_sku, "
                "is_missing_product_name, is_negative_price",
    "payments": "payment_id, order_id, transaction_id, payment_method, amount, amount_abs, currency, payment_date, status, "
                "is_missing_payment_id, is_missing_order_id, is_negative_amount",
}
for _name, _columns in _CSV_STAGED.items():
    _columns = f"raw_record_id, source_file_name, file_row_number, {_columns}, record_hash"

    @same(f"stage_{_name}", _columns, f"stg_{_name}")
    def _stage(w, name=_name, columns=_columns):
        return pick(getattr(staging_csv, f"stage_{name}")(getattr(w.inputs, name)), columns)


_UNIFIED = (f"source_client, source_format, source_file_name, {_STD}, transaction_id_raw, loyalty_tier, is_missing_transaction_id, is_missing_order_id, "
            "is_missing_order_date, is_missing_customer_id, is_missing_email, is_missing_payment_method, is_missing_payment_amount, "
            "is_negative_payment_amount, dq_status, metadata_json")


@same("unify_transactions", _UNIFIED, "unified")
def unify_transactions(w):
    return pick(unify.unify_transactions(w.stg_a, w.stg_c), _UNIFIED)


@same("unify_transaction_items", f"{o.ITEM_COLS}, dq_status", "unified_items")
def unify_transaction_items(w):
    return pick(unify.unify_transaction_items(w.stg_a_items, w.stg_c_items), f"{o.ITEM_COLS}, dq_status")


@query("classify_header_dq", f"SELECT source_client, raw_record_id, transaction_index, dq_status, {o.header_dq(True)} AS loader_status FROM unified")
def classify_header_dq(w):
    rows = w.unified.withColumns({
        "dq_status": unify.classify_header_dq(), "loader_status": unify.classify_header_dq(payment_method_counts=True),
    })
    return pick(rows, "source_client, raw_record_id, transaction_index, dq_status, loader_status")


@query("classify_item_dq", "SELECT source_client, dq_status, count(*) AS line_count FROM unified_items GROUP BY 1, 2")
def classify_item_dq(w):
    return w.unified_items.groupBy("source_client", unify.classify_item_dq().alias("dq_status")).agg(F.count(F.lit(1)).alias("line_count"))


# ---- scalar expressions over whole tables ---------------------------------


@query("norm_text", f"SELECT raw_record_id, {o.up('customer_id_raw')} AS upper_id, {o.low('email_raw')} AS lower_email, {o.tr('signup_source_raw')} AS trimmed FROM raw_customers")
def norm_text(w):
    return w.inputs.customers.select(
        "raw_record_id", x.norm_upper(c("customer_id_raw")).alias("upper_id"), x.norm_lower(c("email_raw")).alias("lower_email"),
        x.norm_trim(c("signup_source_raw")).alias("trimmed"),
    )


@query("norm_initcap", f"SELECT raw_record_id, {o.initcap('first_name_raw')} AS first_name, {o.initcap('last_name_raw')} AS last_name FROM raw_customers")
def norm_initcap(w):
    return w.inputs.customers.select(
        "raw_record_id", x.norm_initcap(c("first_name_raw")).alias("first_name"), x.norm_initcap(c("last_name_raw")).alias("last_name")
    )


@query("safe_date", f"SELECT raw_record_id, {o.to_date('order_date_raw')} AS order_date FROM raw_orders")
def safe_date(w):
    return w.inputs.orders.select("raw_record_id", x.safe_date(c("order_date_raw")).alias("order_date"))


@query("safe_numbers", f"""SELECT raw_record_id, {o.dec('total_amount_raw')} AS as_decimal, {o.integer('total_amount_raw')} AS as_integer,
    abs({o.dec('total_amount_raw')}) AS as_abs, {o.dec('order_date_raw')} AS not_a_number FROM raw_orders""")
def safe_numbers(w):
    amount = c("total_amount_raw")
    return w.inputs.orders.select(
        "raw_record_id", x.safe_decimal(amount).alias("as_decimal"), x.safe_integer(amount).alias("as_integer"),
        x.abs_value(x.safe_decimal(amount)).alias("as_abs"), x.safe_decimal(c("order_date_raw")).alias("not_a_number"),
    )


@query("email_status", "SELECT customer_id, email, email_validation_status, CASE WHEN email IS NOT NULL THEN split_part(email, '@', 2) END AS email_domain FROM stg_customers")
def email_status(w):
    raw = w.inputs.customers
    email = x.norm_lower(c("email_raw"))
    return raw.select(
        x.norm_upper(c("customer_id_raw")).alias("customer_id"), email.alias("email"),
        x.email_status(c("email_raw")).alias("email_validation_status"), x.email_domain(email).alias("email_domain"),
    )


@query("payment_method_code", f"SELECT {o.method('payment_method_raw')} AS payment_method, count(*) AS payment_count FROM raw_payments GROUP BY 1")
def payment_method_code(w):
    return w.inputs.payments.groupBy(x.payment_method_code(c("payment_method_raw")).alias("payment_method")).agg(F.count(F.lit(1)).alias("payment_count"))


@query("customer_codes", f"SELECT raw_record_id, {o.tier('loyalty_tier_raw')} AS loyalty_tier, {o.boolean('is_active_raw')} AS is_active FROM raw_customers")
def customer_codes(w):
    return w.inputs.customers.select(
        "raw_record_id", x.loyalty_tier_code(c("loyalty_tier_raw")).alias("loyalty_tier"), x.text_to_boolean(c("is_active_raw")).alias("is_active")
    )


@query("default_currency", f"SELECT {o.currency('currency_raw')} AS currency, count(*) AS order_count FROM raw_orders GROUP BY 1")
def default_currency(w):
    return w.inputs.orders.groupBy(x.default_currency(c("currency_raw")).alias("currency")).agg(F.count(F.lit(1)).alias("order_count"))


@query("object_construct", """SELECT event_id, CASE WHEN value > 50 THEN to_json(struct_pack(event_type := event_type, high := true))
    ELSE to_json(struct_pack(event_type := event_type)) END AS without_nulls,
    to_json(struct_pack(event_type := event_type, high := CASE WHEN value > 50 THEN true END)) AS with_nulls FROM events""")
def object_construct(w):
    members = [c("event_type"), F.when(c("value") > 50, True).alias("high")]
    return w.inputs.table("events").select(
        "event_id", x.object_construct(*members).alias("without_nulls"), x.object_construct_keep_null(*members).alias("with_nulls")
    )


@query("json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(w):
    return w.inputs.table("events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "string").alias("k"))


@query("calendar_attributes", """SELECT event_id, CAST(ts AS DATE) AS day, CAST(dayofweek(ts) AS BIGINT) AS day_of_week, left(dayname(ts), 3) AS day_of_week_name,
    CAST(weekofyear(ts) AS BIGINT) AS week_of_year, CAST(ceil(day(ts) / 7.0) AS BIGINT) AS week_of_month, CAST(date_trunc('week', ts) AS DATE) AS week_start_date FROM events""")
def calendar_attributes(w):
    a = dates.calendar_attributes(c("day"))
    days = w.inputs.table("events").select("event_id", F.to_date("ts").alias("day"))
    return days.select("event_id", "day", *[a[n].alias(n) for n in ("day_of_week", "day_of_week_name", "week_of_year", "week_of_month", "week_start_date")])


# ---- joins ----------------------------------------------------------------

_TXN_OK = "WHERE transaction_id IS NOT NULL AND NOT is_missing_transaction_id"


@query("join_dim_customer_current", """SELECT u.source_client, u.raw_record_id, u.transaction_index, u.customer_id, coalesce(d.customer_sk, -1) AS customer_sk
    FROM unified u LEFT JOIN dim_customer d ON d.customer_id = u.customer_id""")
def join_dim_customer_current(w):
    joined = lookups.join_dim_customer_current(w.unified, w.dim_customer, ["raw_record_id", "transaction_index"])
    return pick(joined, "source_client, raw_record_id, transaction_index, customer_id, customer_sk")


@query("join_dim_date", f"SELECT source_client, raw_record_id, transaction_index, {o.date_sk('order_date')} AS order_date_sk FROM unified")
def join_dim_date(w):
    return pick(lookups.join_dim_date(w.unified, w.dim_date, "order_date", "order_date_sk"), "source_client, raw_record_id, transaction_index, order_date_sk")


@query("join_dim_payment_method", f"SELECT source_client, raw_record_id, transaction_index, {o.big('coalesce(m.payment_method_sk, 7)')} AS payment_method_sk "
       "FROM unified u LEFT JOIN dim_payment_method m ON m.payment_method_code = u.payment_method")
def join_dim_payment_method(w):
    return pick(lookups.join_dim_payment_method(w.unified, w.methods), "source_client, raw_record_id, transaction_index, payment_method_sk")


@query("join_dim_order_status", f"SELECT raw_record_id, status, {o.big('order_status_sk')} AS order_status_sk FROM stg_orders LEFT JOIN dim_order_status ON status_code = upper(status)")
def join_dim_order_status(w):
    return lookups.join_dim_order_status(w.stg_orders, w.statuses).select("raw_record_id", "status", "order_status_sk")


@query("join_dim_product_current", """SELECT i.source_client, i.raw_record_id, i.transaction_index, i.line_number, coalesce(p.product_sk, -1) AS product_sk
    FROM unified_items i LEFT JOIN dim_product p ON p.sku = i.sku""")
def join_dim_product_current(w):
    joined = lookups.join_dim_product_current(w.unified_items, w.dim_product, ["raw_record_id", "transaction_index", "line_number"])
    return pick(joined, "source_client, raw_record_id, transaction_index, line_number, product_sk")


@query("join_items_to_header", """SELECT i.source_client, i.raw_record_id, i.transaction_index, i.line_number, h.transaction_sk
    FROM unified_items i JOIN fact_ac h ON h.transaction_id = i.transaction_id AND h.source_client = i.source_client""")
def join_items_to_header(w):
    items = w.unified_items.drop("order_date")
    return pick(lookups.join_items_to_header(items, w.fact_ac), "source_client, raw_record_id, transaction_index, line_number, transaction_sk")


@query("anti_join_existing", "SELECT order_id, raw_record_id FROM stg_orders WHERE order_id IS NOT NULL AND raw_record_id % 10 <> 0")
def anti_join_existing(w):
    rows = w.stg_orders.filter("order_id IS NOT NULL")
    return lookups.anti_join_existing(rows, rows.filter("raw_record_id % 10 = 0"), ["order_id"]).select("order_id", "raw_record_id")


@query("not_in_current", "SELECT DISTINCT customer_id FROM unified WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM csv_first)")
def not_in_current(w):
    known = w.dim_customer.filter("source_client = 'CSV'")
    rows = w.unified.filter("customer_id IS NOT NULL").select("customer_id")
    return lookups.not_in_current(rows, known, "customer_id").distinct()


@query("semi_join_in", "SELECT transaction_item_sk, transaction_sk FROM fact_item WHERE transaction_sk IN (SELECT transaction_sk FROM fact_ac WHERE raw_record_id % 4 = 1)")
def semi_join_in(w):
    batch = w.with_test_batches(w.fact_ac).filter("batch_id = 'BATCH_1'")
    return lookups.semi_join_in(w.fact_item, batch, ["transaction_sk"]).select("transaction_item_sk", "transaction_sk")


_CUST_TX = f"""SELECT d.customer_id, count(f.transaction_sk) AS transaction_count, sum(f.payment_amount_abs) AS total_spend,
    {o.big("coalesce(sum(CASE WHEN f.has_dq_issues THEN 1 ELSE 0 END), 0)")} AS transactions_with_issues, max(f.order_date) AS last_order_date
    FROM dim_customer d LEFT JOIN fact_ac f ON f.customer_sk = d.customer_sk GROUP BY d.customer_id"""
_SPEND = "CAST(total_spend AS DECIMAL(28,4)) AS total_spend"


@query("join_customer_transactions", f"SELECT customer_id, transaction_count, {_SPEND}, last_order_date FROM ({_CUST_TX}) t")
def join_customer_transactions(w):
    joined = lookups.join_customer_transactions(w.dim_customer, w.fact_ac)
    return joined.select(
        "customer_id", F.coalesce("transaction_count", F.lit(0)).alias("transaction_count"),
        c("total_spend").cast("decimal(28,4)").alias("total_spend"), "last_order_date",
    )


@query("trace_backward", "SELECT transaction_id, source_client, source_file_name, raw_record_id FROM fact_ac WHERE source_client = 'ClientC'")
def trace_backward(w):
    traced = lookups.trace_backward(w.fact_ac, w.inputs.json_docs)
    return traced.filter("raw_content IS NOT NULL").select("transaction_id", "source_client", "source_file_name", "raw_record_id")


_FILE = "ClientA_Transactions_0.xml"


@query("trace_forward", f"""SELECT f.transaction_id, f.source_file_name, i.line_number, i.sku, i.line_total FROM fact_ac f
    LEFT JOIN fact_item i ON i.transaction_sk = f.transaction_sk WHERE f.source_file_name = '{_FILE}'""")
def trace_forward(w):
    return lookups.trace_forward(w.fact_ac, w.fact_item, _FILE).select("transaction_id", "source_file_name", "line_number", "sku", "line_total")


@query("lateral_flatten", "SELECT source_client, transaction_id, line_number FROM unified_items")
def lateral_flatten(w):
    a = staging_xml.flatten_xml_items(w.stg_a).select("source_client", "transaction_id", c("line_number").cast("bigint").alias("line_number"))
    flat_c = w.stg_c.select("source_client", "transaction_id", F.posexplode("items").alias("p", "item"))
    return a.unionByName(flat_c.select("source_client", "transaction_id", (c("p") + 1).cast("bigint").alias("line_number")))


# ---- aggregations ---------------------------------------------------------


@same("aggregate_items_per_transaction", "transaction_sk, item_count, total_line_amount, total_line_amount_abs", "item_sums")
def aggregate_items_per_transaction(w):
    return facts.aggregate_items_per_transaction(w.fact_item)


_DUP = "source_client, duplicate_type, duplicate_key, duplicate_key_hash, occurrence_count, first_occurrence_file, all_occurrence_files, resolution_method"


@query("detect_duplicate_keys", """SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS duplicate_key, count(*) AS occurrence_count,
    min(l_returnflag) AS first_occurrence_file, list_sort(list(DISTINCT l_returnflag)) AS all_occurrence_files FROM lineitem GROUP BY 1 HAVING count(*) > 1""")
def detect_duplicate_keys(w):
    rows = w.inputs.table("lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"), c("l_returnflag").alias("source_file_name")
    )
    found = quality.detect_duplicate_keys(rows, "line_key", "LINE", "KEEP_FIRST", "ClientA")
    return found.select("duplicate_key", "occurrence_count", "first_occurrence_file", "all_occurrence_files")


@query("keep_first", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) = 1""")
def keep_first(w):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    kept = keys.keep_first(w.inputs.table("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", c("l_linenumber"), "l_partkey", "l_extendedprice")


@query("assign_surrogate_keys", f"SELECT o_orderkey, {o.big('100 + row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey)')} AS order_sk FROM orders")
def assign_surrogate_keys(w):
    return keys.assign_surrogate_keys(w.inputs.table("orders").select("o_orderkey"), "order_sk", ["o_orderkey"], 100)


# ---- dimensions -----------------------------------------------------------


@query("build_dim_date", """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS DATE) AS date_actual, CAST(dayofweek(d) AS BIGINT) AS day_of_week,
    left(dayname(d), 3) AS day_of_week_name, CAST(day(d) AS BIGINT) AS day_of_month, CAST(dayofyear(d) AS BIGINT) AS day_of_year,
    dayofweek(d) BETWEEN 1 AND 5 AS is_weekday, dayofweek(d) IN (0, 6) AS is_weekend, CAST(weekofyear(d) AS BIGINT) AS week_of_year,
    CAST(ceil(day(d) / 7.0) AS BIGINT) AS week_of_month, CAST(date_trunc('week', d) AS DATE) AS week_start_date,
    CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS week_end_date, CAST(month(d) AS BIGINT) AS month_actual, left(monthname(d), 3) AS month_name,
    CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date, CAST(quarter(d) AS BIGINT) AS quarter_actual,
    'Q' || quarter(d) AS quarter_name, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
    CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date, CAST(year(d) AS BIGINT) AS year_actual,
    CAST(date_trunc('year', d) AS DATE) AS year_start_date, CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date,
    CAST(year(d) AS BIGINT) AS fiscal_year, CAST(quarter(d) AS BIGINT) AS fiscal_quarter, false AS is_holiday, d = last_day(d) AS is_last_day_of_month, n AS order_count
    FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) days""")
def build_dim_date(w):
    """The calendar joined to the orders of each day."""
    per_day = w.inputs.table("orders").groupBy(F.to_date("o_orderdate").alias("date_actual")).agg(F.count(F.lit(1)).alias("order_count"))
    return per_day.join(F.broadcast(w.dim_date.filter("date_sk != -1")), "date_actual").select(
        "date_sk", "date_actual", "day_of_week", "day_of_week_name", "day_of_month", "day_of_year", "is_weekday", "is_weekend",
        "week_of_year", "week_of_month", "week_start_date", "week_end_date", "month_actual", "month_name", "month_start_date",
        "month_end_date", "quarter_actual", "quarter_name", "quarter_start_date", "quarter_end_date", "year_actual", "year_start_date",
        "year_end_date", "fiscal_year", "fiscal_quarter", "is_holiday", "is_last_day_of_month", "order_count",
    )


@query("seed_dim_payment_method", f"SELECT m.payment_method_code, {o.big('m.payment_method_sk')} AS payment_method_sk, count(p.payment_id) AS payment_count, "
       "CAST(sum(p.amount_abs) AS DECIMAL(28,4)) AS amount FROM dim_payment_method m LEFT JOIN stg_payments p ON p.payment_method = m.payment_method_code GROUP BY 1, 2")
def seed_dim_payment_method(w):
    """Payments per seeded method, methods without payments included."""
    used = w.stg_payments.groupBy("payment_method").agg(F.count("payment_id").alias("payment_count"), F.sum("amount_abs").alias("amount"))
    joined = seeds.seed_dim_payment_method(w.spark).join(used, c("payment_method_code") == c("payment_method"), "left")
    return joined.select(
        "payment_method_code", "payment_method_sk", F.coalesce("payment_count", F.lit(0)).alias("payment_count"),
        c("amount").cast("decimal(28,4)").alias("amount"),
    )


@query("seed_dim_order_status", f"SELECT d.status_code, {o.big('d.order_status_sk')} AS order_status_sk, count(s.raw_record_id) AS order_count "
       "FROM dim_order_status d LEFT JOIN stg_orders s ON s.status = d.status_code GROUP BY 1, 2")
def seed_dim_order_status(w):
    used = w.stg_orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"))
    joined = seeds.seed_dim_order_status(w.spark).join(used, c("status_code") == c("status"), "left")
    return joined.select("status_code", "order_status_sk", F.coalesce("order_count", F.lit(0)).alias("order_count"))


@query("seed_dim_currency", "SELECT d.currency_code, count(s.raw_record_id) AS order_count FROM (VALUES ('USD'), ('EUR'), ('GBP'), ('UNKNOWN')) d(currency_code) "
       "LEFT JOIN stg_orders s ON s.currency = d.currency_code GROUP BY 1")
def seed_dim_currency(w):
    used = w.stg_orders.groupBy("currency").agg(F.count(F.lit(1)).alias("order_count"))
    joined = seeds.seed_dim_currency(w.spark).join(used, c("currency_code") == c("currency"), "left")
    return joined.select("currency_code", F.coalesce("order_count", F.lit(0)).alias("order_count"))


_CHANGED = "(d.record_hash IS DISTINCT FROM n.record_hash)"
_HIST = "customer_sk, customer_id, email, record_hash, is_current, version_number, effective_from, effective_to"
_TS = "TIMESTAMP '{0}'".format
_EXPIRED = f"""SELECT d.customer_sk, d.customer_id, d.email, d.record_hash, NOT {_CHANGED} AS is_current, CAST(1 AS BIGINT) AS version_number,
    {_TS(AS_OF)} AS effective_from, CASE WHEN {_CHANGED} THEN {_TS(AS_OF_2)} ELSE {_TS('9999-12-31 23:59:59')} END AS effective_to
    FROM csv_dim d JOIN csv_day_2 n ON n.customer_id = d.customer_id"""


def _history(df: DataFrame) -> DataFrame:
    times = {n: c(n).cast("timestamp_ntz") for n in ("effective_from", "effective_to")}
    return df.filter("customer_sk != -1").withColumns(times).select(*[n.strip() for n in _HIST.split(",")])


def _day_1(w: Warehouse) -> DataFrame:
    return dims.scd2_apply(w.new_customers(), dims.customers_from_csv(w.stg_customers), dims.CUSTOMER, AS_OF)


@query("scd2_apply", f"""{_EXPIRED} UNION ALL SELECT {o.big("(SELECT count(*) FROM csv_dim) + row_number() OVER (ORDER BY md5(n.customer_id), n.customer_id)")},
    n.customer_id, n.email, n.record_hash, true, CAST(2 AS BIGINT), {_TS(AS_OF_2)}, {_TS('9999-12-31 23:59:59')}
    FROM csv_dim d JOIN csv_day_2 n ON n.customer_id = d.customer_id WHERE {_CHANGED}""")
def scd2_apply(w):
    day_2 = dims.customers_from_csv(staging_csv.stage_customers(w.inputs.customers_day_2))
    return _history(dims.scd2_apply(_day_1(w), day_2, dims.CUSTOMER, AS_OF_2))


@query("scd2_merge_dim_customer", _EXPIRED)
def scd2_merge_dim_customer(w):
    return _history(dims.scd2_merge_dim_customer(_day_1(w), staging_csv.stage_customers(w.inputs.customers_day_2), AS_OF_2))


_CUST = "customer_sk, customer_id, first_name, last_name, full_name, email, email_domain, email_validation_status, loyalty_tier, signup_source, is_active, source_client, source_file_name, record_hash"
for _client, _letter in (("ClientA", "a"), ("ClientC", "c")):
    _attributes = _CUST.removeprefix("customer_sk, ")

    @query(f"insert_customers_from_client_{_letter}", f"""SELECT {o.big("(SELECT count(*) FROM csv_dim) + row_number() OVER (ORDER BY md5(customer_id), customer_id)")} AS customer_sk,
        customer_id, loyalty_tier, source_client, email, email_validation_status FROM (SELECT * FROM customer_candidates WHERE source_client = '{_client}' AND customer_id NOT IN (SELECT customer_id FROM csv_dim)
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_file_name, rec, pos) = 1) x""")
    def _insert(w, letter=_letter):
        target = _day_1(w)
        new = getattr(dims, f"insert_customers_from_client_{letter}")(target, getattr(w, f"stg_{letter}"), AS_OF)
        return new.select("customer_sk", "customer_id", "loyalty_tier", "source_client", "email", "email_validation_status")


@same("load_dim_customer", _CUST, "dim_customer")
def load_dim_customer(w):
    return pick(w.load_dim_customer().filter("customer_sk != -1"), _CUST)


_PROD = "product_sk, sku, product_id, product_name, description, category, price, currency, source_client, source_file_name, record_hash"


@same("load_dim_product", _PROD, "dim_product")
def load_dim_product(w):
    return pick(w.load_dim_product().filter("product_sk != -1"), _PROD)


@query("dimension_load_counts", "SELECT 'MERGED' AS action, count(*) AS row_count FROM dim_customer WHERE source_client = 'CSV' "
       "UNION ALL SELECT 'INSERTED', count(*) FROM dim_customer WHERE source_client <> 'CSV'")
def dimension_load_counts(w):
    return dims.dimension_load_counts(w.dim_customer, AS_OF)


# ---- facts ----------------------------------------------------------------

_FACT = ("transaction_sk, transaction_id, order_id, customer_sk, order_date_sk, payment_method_sk, customer_id, order_date, payment_amount, payment_amount_abs, "
         "payment_currency, source_client, source_file_name, source_format, dq_status, dq_issues, dq_issue_count, has_dq_issues, raw_record_id")


@same("load_fact_transaction_client_a", _FACT, "fact_a")
def load_fact_transaction_client_a(w):
    return pick(w.load_fact_a(), _FACT)


@same("load_fact_transaction_client_c", _FACT, "fact_c")
def load_fact_transaction_client_c(w):
    return pick(w.load_fact_c(), _FACT)


_ITEM = ("transaction_item_sk, transaction_sk, product_sk, order_date_sk, transaction_id, line_number, sku, quantity, quantity_abs, unit_price, unit_price_abs, "
         "line_total, line_total_abs, currency, description, dq_status, has_negative_quantity, has_negative_price, is_missing_sku, is_missing_description, "
         "source_file_name, source_client, item_metadata")


@same("load_fact_transaction_item", _ITEM, "fact_item")
def load_fact_transaction_item(w):
    only_a = F.when(c("source_client") == "ClientA", c("item_metadata"))
    return pick(w.load_fact_item().withColumn("item_metadata", only_a), _ITEM)


_AGG = "transaction_sk, transaction_id, payment_amount_abs, item_count, total_line_amount, total_line_amount_abs, amount_variance, has_amount_variance"


@same("update_transaction_aggregates", _AGG, "fact")
def update_transaction_aggregates(w):
    return pick(w.update_aggregates(), _AGG)


_ORDER = ("order_sk, order_id, customer_sk, order_date_sk, order_status_sk, customer_id, order_date, total_amount, currency, status, source_file_name, "
          "dq_status, has_dq_issues, raw_record_id, record_hash")


@same("load_fact_order", _ORDER, "fact_order")
def load_fact_order(w):
    return pick(w.load_fact_order(), _ORDER)


_PAYMENT = ("payment_sk, payment_id, order_id, transaction_id, payment_method_sk, payment_date_sk, amount, amount_abs, currency, status, payment_date, "
            "source_file_name, dq_status, is_negative_amount, raw_record_id")


@same("load_fact_payment", _PAYMENT, "fact_payment")
def load_fact_payment(w):
    return pick(w.load_fact_payment(), _PAYMENT)


def _loaded(w: Warehouse) -> tuple[TableStore, dict[str, DataFrame], DataFrame]:
    from ledgerloom.plans.loading import create_dimensions, load_all

    store = TableStore(w.spark, fresh_path(w.spark, "store"))
    staged = materialize_staging(store, _staging_inputs(w))
    create_dimensions(store, AS_OF, "1995-01-01", "2002-12-31")
    return store, staged, load_all(store, staged, AS_OF)


@query("load_all", """SELECT 'dim_customer' AS step, 'Completed' AS result UNION ALL SELECT 'dim_product', 'Completed'
    UNION ALL SELECT 'fact_transaction_client_a', 'ClientA transactions loaded: ' || (SELECT count(*) FROM fact_a) || ' rows'
    UNION ALL SELECT 'fact_transaction_client_c', 'ClientC transactions loaded: ' || (SELECT count(*) FROM fact_c) || ' rows'
    UNION ALL SELECT 'fact_transaction_item', 'Transaction items loaded: ' || (SELECT count(*) FROM fact_item) || ' rows'
    UNION ALL SELECT 'transaction_aggregates', 'Transaction aggregates updated: ' || (SELECT count(*) FROM item_sums) || ' rows'
    UNION ALL SELECT 'fact_order', 'Orders loaded: ' || (SELECT count(*) FROM fact_order) || ' rows'
    UNION ALL SELECT 'fact_payment', 'Payments loaded: ' || (SELECT count(*) FROM fact_payment) || ' rows'""")
def load_everything(w):
    return _loaded(w)[2].select("step", "result")


@query("run_pipeline", """SELECT 'fact_transaction' AS table_name, source_client || '|' || transaction_id AS row_key, CAST(1 AS BIGINT) AS times FROM fact_ac
    UNION ALL SELECT 'fact_transaction_item', source_client || '|' || transaction_id || '|' || line_number, 1 FROM fact_item
    UNION ALL SELECT 'fact_order', order_id, 1 FROM fact_order UNION ALL SELECT 'fact_payment', payment_id, 1 FROM fact_payment""")
def run_pipeline(w):
    """The given tables as files in an inbox, through two runs: the second one finds nothing new."""
    from ledgerloom.plans.loading import FACT_ITEM, FACT_ORDER, FACT_PAYMENT, FACT_TRANSACTION, create_dimensions, read_fact
    from ledgerloom.plans.pipeline import Pipeline

    inbox = [
        w.inputs.xml_files("is_txt = 0"), w.inputs.txt_files(), w.inputs.json_files(),
        *[w.inputs.csv_inbox(sql, entity, name) for sql, entity, name in (
            (truth.CUSTOMERS, formats.CUSTOMERS, "Customer.csv"), (truth.ORDERS, formats.ORDERS, "Orders.csv"),
            (truth.PRODUCTS, formats.PRODUCTS, "Products.csv"), (truth.PAYMENTS, formats.PAYMENTS, "Payments.csv"),
        )],
    ]
    store = TableStore(w.spark, fresh_path(w.spark, "pipeline-store"))
    create_dimensions(store, AS_OF, "1995-01-01", "2002-12-31")
    pipeline = Pipeline(w.spark, store, inbox)
    pipeline.run(BATCH, AS_OF)
    pipeline.run("BATCH_2", AS_OF_2)
    facts_of = {
        "fact_transaction": (FACT_TRANSACTION, F.concat_ws("|", "source_client", "transaction_id")),
        "fact_transaction_item": (FACT_ITEM, F.concat_ws("|", "source_client", "transaction_id", "line_number")),
        "fact_order": (FACT_ORDER, c("order_id")), "fact_payment": (FACT_PAYMENT, c("payment_id")),
    }
    parts = [read_fact(store, n).select(F.lit(label).alias("table_name"), k.alias("row_key")) for label, (n, k) in facts_of.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "row_key").agg(F.count(F.lit(1)).alias("times"))


@query("check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(w):
    return keys.check_unique(w.inputs.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_referential", "SELECT transaction_id, source_client FROM fact_ac WHERE customer_sk = -1")
def check_referential(w):
    return keys.check_referential(w.fact_ac, "customer_sk", w.dim_customer, "customer_sk").select("transaction_id", "source_client")


@query("append_rows", "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def append_rows(w):
    orders = w.inputs.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return changes.append_rows(orders, orders.filter("o_orderstatus = 'F'")).drop("o_orderstatus")


@query("update_rows", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def update_rows(w):
    orders = w.inputs.table("orders").select("o_orderkey", "o_orderstatus")
    return changes.update_rows(orders, c("o_orderstatus") == "F", {"o_orderstatus": F.lit("COMPLETED")})


@query("delete_rows", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'")
def delete_rows(w):
    return changes.delete_rows(w.inputs.table("orders").select("o_orderkey", "o_orderstatus"), c("o_orderstatus") == "P").select("o_orderkey")


@query("overwrite_table", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def overwrite_table(w):
    store = TableStore(w.spark, fresh_path(w.spark, "store"))
    store.overwrite("canonical.orders", w.inputs.table("orders").select("o_orderkey", "o_orderstatus"))
    return store.overwrite("canonical.orders", store.read("canonical.orders").filter("o_orderstatus != 'P'"))


# ---- data quality ---------------------------------------------------------


@query("detect_duplicate_transactions", f"SELECT batch_id, {_DUP} FROM tracker")
def detect_duplicate_transactions(w):
    return pick(w.detect_duplicates(), f"batch_id, {_DUP}")


_ISSUE = ("batch_id, source_client, source_file_name, source_table, target_table, issue_type, issue_category, issue_severity, issue_description, "
          "record_identifier, field_name, field_value_raw, field_value_expected")


@same("duplicate_issues", _ISSUE, "dup_issues")
def duplicate_issues(w):
    return pick(quality.duplicate_issues(w.tracker, BATCH, AS_OF), _ISSUE)


@same("log_issues_client_a", _ISSUE, "issues_a")
def log_issues_client_a(w):
    return pick(quality.log_issues_client_a(w.stg_a, w.stg_a_items, BATCH, AS_OF), _ISSUE)


@same("log_issues_client_c", _ISSUE, "issues_c")
def log_issues_client_c(w):
    return pick(quality.log_issues_client_c(w.stg_c, w.stg_c_items, BATCH, AS_OF), _ISSUE)


@same("detect_amount_mismatches", _ISSUE, "mismatches")
def detect_amount_mismatches(w):
    return pick(quality.detect_amount_mismatches(w.fact, BATCH, AS_OF), _ISSUE)


_METRIC = ("batch_id, metric_date, source_client, total_records_received, total_records_processed, total_records_loaded, total_records_rejected, "
           "total_records_warning, missing_field_count, invalid_format_count, invalid_value_count, negative_value_count, duplicate_count, "
           "rejection_rate, warning_rate, data_quality_score")


@same("calculate_dq_metrics", _METRIC, "metrics")
def calculate_dq_metrics(w):
    return pick(w.calculate_metrics(), _METRIC)


@query("run_all_dq_checks", f"""SELECT 'Duplicate Detection' AS check_name, 'Duplicate detection completed. Found ' || (SELECT count(*) FROM tracker) || ' duplicate groups.' AS result
    UNION ALL SELECT 'ClientA Issues', 'ClientA DQ issues logged: ' || (SELECT count(*) FROM issues_a) || ' issues'
    UNION ALL SELECT 'ClientC Issues', 'ClientC DQ issues logged: ' || (SELECT count(*) FROM issues_c) || ' issues'
    UNION ALL SELECT 'Amount Mismatches', 'Amount mismatch detection completed. Found ' || (SELECT count(*) FROM mismatches) || ' mismatches.'
    UNION ALL SELECT 'Metrics Calculation', 'DQ metrics calculated for batch {BATCH}'""")
def run_all_dq_checks(w):
    from ledgerloom.plans.checks import run_all_dq_checks as run

    store, staged, _ = _loaded(w)
    return run(store, staged, BATCH, AS_OF).select("check_name", "result")


_RULE = "SELECT '{code}' AS rule_code, '{sev}' AS severity, '{act}' AS action_on_failure, {ident} AS record_identifier, CAST({col} AS VARCHAR) AS field_value FROM {table} WHERE {cond}"
_HID = "coalesce(transaction_id, order_id, 'UNKNOWN_' || raw_record_id)"
_IID = "coalesce(transaction_id, '') || '-' || line_number"


def _rules_sql() -> str:
    blank = "coalesce(trim(CAST({0} AS VARCHAR)), '') = ''".format
    parts = [
        ("R001", "CRITICAL", "REJECT", "transaction_id", "unified", blank("transaction_id"), _HID),
        ("R002", "HIGH", "LOG", "order_id", "unified", blank("order_id"), _HID),
        ("R003", "HIGH", "LOG", "customer_id", "unified", blank("customer_id"), _HID),
        ("R004", "MEDIUM", "LOG", "email", "dim_customer", f"email IS NOT NULL AND NOT regexp_matches(email, '{o._EMAIL}')", "customer_id"),
        ("R005", "HIGH", "LOG", "payment_amount", "unified", "payment_amount < 0", _HID),
        ("R006", "HIGH", "LOG", "quantity", "unified_items", "quantity < 0", _IID),
        ("R007", "HIGH", "LOG", "unit_price", "unified_items", "unit_price < 0", _IID),
        ("R008", "MEDIUM", "LOG", "sku", "unified_items", blank("sku"), _IID),
        ("R009", "CRITICAL", "REJECT", "transaction_id", "unified",
         "trim(transaction_id) <> '' AND (source_client, transaction_id) IN (SELECT (source_client, transaction_id) FROM unified GROUP BY source_client, transaction_id HAVING count(*) > 1)", _HID),
        ("R010", "MEDIUM", "LOG", "order_date", "unified", blank("order_date"), _HID),
    ]
    return " UNION ALL ".join(_RULE.format(code=a, sev=b, act=d, col=e, table=t, cond=f, ident=i) for a, b, d, e, t, f, i in parts)


@query("apply_validation_rules", _rules_sql())
def apply_validation_rules(w):
    tables = {"fact_transaction": w.unified, "fact_transaction_item": w.unified_items, "dim_customer": w.dim_customer.filter("customer_sk != -1")}
    ids = {
        "fact_transaction": "coalesce(transaction_id, order_id, 'UNKNOWN_' || cast(raw_record_id AS string))",
        "fact_transaction_item": "coalesce(transaction_id, '') || '-' || cast(line_number AS string)", "dim_customer": "customer_id",
    }
    broken = quality.apply_validation_rules(tables, ids, seeds.VALIDATION_RULES)
    return broken.select("rule_code", "severity", "action_on_failure", "record_identifier", "field_value")


@query("track_anomaly_patterns", """SELECT issue_type AS pattern_name, issue_category AS pattern_category, list_sort(list(DISTINCT source_client)) AS affected_clients,
    count(*) AS occurrence_count, count(DISTINCT batch_id) AS affected_batches FROM issues GROUP BY 1, 2""")
def track_anomaly_patterns(w):
    patterns = quality.track_anomaly_patterns(w.issues)
    return patterns.select("pattern_name", "pattern_category", "affected_clients", "occurrence_count", "affected_batches")


_GAP = "SELECT 'REFERENCE' AS kind, '{key}' AS name, {record} AS record, '-1' AS value FROM {fact} WHERE {key} = -1"


@query("run_validation", "SELECT 'RULE' AS kind, rule_code AS name, record_identifier AS record, field_value AS value FROM ("
       + _rules_sql().replace(_IID, "coalesce(transaction_id, '') || '-LINE_' || line_number") + ") UNION ALL "
       + " UNION ALL ".join(_GAP.format(fact=fact, key=key, record=record) for fact, key, record in (
           ("fact_ac", "customer_sk", "transaction_id"), ("fact_item", "product_sk", "transaction_id || '-LINE_' || line_number"), ("fact_order", "customer_sk", "order_id")))
       + """ UNION ALL SELECT 'PATTERN', issue_type, array_to_string(list_sort(list(DISTINCT source_client)), ' '), CAST(count(*) AS VARCHAR) FROM issues GROUP BY issue_type, issue_category""")
def run_validation(w):
    """A loaded and checked batch: broken rules, facts without a known parent, repeated keys (none) and patterns."""
    from ledgerloom.plans import checks

    store, staged, _ = _loaded(w)
    checks.run_all_dq_checks(store, staged, BATCH, AS_OF)
    checks.run_validation(store, staged, BATCH, AS_OF)
    rules = store.read(checks.VIOLATIONS).select(F.lit("RULE").alias("kind"), c("rule_code").alias("name"), c("record_identifier").alias("record"), c("field_value").alias("value"))
    gaps = store.read(checks.INTEGRITY).select(c("check_type").alias("kind"), c("key_columns").alias("name"), c("record_identifier").alias("record"), c("key_value").alias("value"))
    patterns = checks.anomaly_patterns(store).select(
        F.lit("PATTERN").alias("kind"), c("pattern_name").alias("name"), F.array_join("affected_clients", " ").alias("record"), c("occurrence_count").cast("string").alias("value")
    )
    return rules.unionByName(gaps).unionByName(patterns)


@query("resolve_issues", "SELECT issue_type, source_client, issue_severity = 'CRITICAL' AS is_resolved, count(*) AS issue_count FROM issues GROUP BY 1, 2, 3")
def resolve_issues(w):
    done = quality.resolve_issues(w.issues, c("issue_severity") == "CRITICAL", "FIXED", "checked by hand", "steward", AS_OF_2)
    return done.groupBy("issue_type", "source_client", "is_resolved").agg(F.count(F.lit(1)).alias("issue_count"))


# ---- reports --------------------------------------------------------------


@query("report_issue_summary", f"""SELECT batch_id, source_client, issue_category, issue_type, issue_severity, count(*) AS issue_count,
    count(DISTINCT source_file_name) AS affected_files, count(DISTINCT record_identifier) AS affected_records, CAST(0 AS BIGINT) AS resolved_count
    FROM issues GROUP BY 1, 2, 3, 4, 5""")
def report_issue_summary(w):
    return reports.report_issue_summary(w.issues).drop("first_detected", "last_detected")


@query("report_duplicate_summary", f"""SELECT batch_id, source_client, duplicate_type, count(*) AS duplicate_groups, {o.big('sum(occurrence_count)')} AS total_duplicate_records,
    {o.big('sum(occurrence_count) - count(*)')} AS excess_records FROM tracker GROUP BY 1, 2, 3""")
def report_duplicate_summary(w):
    return reports.report_duplicate_summary(w.tracker).drop("first_detected", "last_detected")


@query("report_transaction_quality", f"""SELECT source_client, dq_status, count(*) AS transaction_count, CAST(sum(payment_amount_abs) AS DECIMAL(28,4)) AS total_amount,
    CAST(avg(payment_amount_abs) AS DECIMAL(18,4)) AS avg_amount, min(order_date) AS min_order_date, max(order_date) AS max_order_date,
    {o.big('sum(CASE WHEN has_dq_issues THEN 1 ELSE 0 END)')} AS issues_flagged, {o.big('sum(dq_issue_count)')} AS total_issue_count FROM fact GROUP BY 1, 2""")
def report_transaction_quality(w):
    return reports.report_transaction_quality(w.fact)


_LINES_OF = "(SELECT count(*) FROM fact_item i WHERE i.transaction_sk = fact.transaction_sk AND i.{0})".format


@query("report_anomaly_detail", f"""SELECT transaction_id, order_id, customer_id, source_client, source_file_name, order_date, dq_status, dq_issues, dq_issue_count,
    payment_amount, payment_amount_abs, coalesce(payment_amount < 0, false) AS has_negative_payment, has_amount_variance, amount_variance, item_count,
    {_LINES_OF('has_negative_quantity')} AS negative_quantity_lines, {_LINES_OF('has_negative_price')} AS negative_price_lines, {_LINES_OF('is_missing_sku')} AS missing_sku_lines
    FROM fact WHERE has_dq_issues OR dq_status <> 'VALID' OR has_amount_variance""")
def report_anomaly_detail(w):
    return reports.report_anomaly_detail(w.fact, w.fact_item).drop("ingestion_timestamp", "created_at")


def _status_count(s: str) -> str:
    return o.big(f"sum(CASE WHEN dq_status = '{s}' THEN 1 ELSE 0 END)") + f" AS {s.lower()}_count"


@query("report_file_quality", f"""SELECT source_file_name, source_client, source_format, count(*) AS total_transactions, {_status_count('VALID')}, {_status_count('WARNING')},
    {_status_count('INVALID')}, {_status_count('CRITICAL')}, {o.pct("sum(CASE WHEN dq_status = 'VALID' THEN 1 ELSE 0 END)", 'count(*)')} AS valid_percentage,
    {o.pct("sum(CASE WHEN dq_status IN ('INVALID', 'CRITICAL') THEN 1 ELSE 0 END)", 'count(*)')} AS error_percentage,
    CAST(sum(payment_amount_abs) AS DECIMAL(28,4)) AS total_amount, {o.big('sum(item_count)')} AS total_items FROM fact GROUP BY 1, 2, 3""")
def report_file_quality(w):
    return reports.report_file_quality(w.fact).drop("first_ingested", "last_ingested")


_BATCH_Q = """SELECT m.batch_id, m.metric_date, m.source_client, m.total_records_received, m.total_records_loaded, m.total_records_rejected, m.total_records_warning,
    m.missing_field_count, m.invalid_format_count, m.negative_value_count, m.duplicate_count, m.rejection_rate, m.warning_rate, m.data_quality_score,
    (SELECT count(*) FROM issues i WHERE i.batch_id = m.batch_id AND i.source_client = m.source_client) AS total_issues_logged,
    (SELECT count(*) FROM tracker t WHERE t.batch_id = m.batch_id AND t.source_client = m.source_client) AS duplicate_groups FROM metrics m"""


@query("report_batch_quality", _BATCH_Q)
def report_batch_quality(w):
    return reports.report_batch_quality(w.metrics, w.issues, w.tracker).drop("calculated_at")


@query("correlated_counts", f"SELECT transaction_sk, {_LINES_OF('has_negative_quantity')} AS negative_quantity_lines, {_LINES_OF('has_negative_price')} AS negative_price_lines, "
       f"{_LINES_OF('is_missing_sku')} AS missing_sku_lines FROM fact_ac AS fact")
def correlated_counts(w):
    counted = w.fact_ac.select("transaction_sk").join(reports.item_issue_counts(w.fact_item), "transaction_sk", "left")
    return counted.na.fill(0)


@query("report_issue_trend", f"SELECT DATE '{AS_OF[:10]}' AS issue_date, source_client, issue_category, issue_severity, count(*) AS issue_count FROM issues GROUP BY 2, 3, 4")
def report_issue_trend(w):
    return reports.report_issue_trend(w.issues)


@query("report_customer_quality", f"""SELECT d.customer_id, d.full_name, d.email, d.email_validation_status, d.loyalty_tier, d.source_client, t.transaction_count,
    CAST(t.total_spend AS DECIMAL(28,4)) AS total_spend, t.transactions_with_issues, t.last_order_date FROM dim_customer d JOIN ({_CUST_TX}) t ON t.customer_id = d.customer_id""")
def report_customer_quality(w):
    return reports.report_customer_quality(w.dim_customer, w.fact_ac)


_LAYERS = {
    "raw.raw_xml_transactions": "(SELECT DISTINCT doc FROM landed_a WHERE is_txt = 0)", "raw.raw_txt_xml_transactions": "(SELECT DISTINCT doc FROM landed_a WHERE is_txt = 1)",
    "raw.raw_json_transactions": "(SELECT DISTINCT doc FROM raw_headers_c)", "raw.raw_csv_customers": "raw_customers", "raw.raw_csv_orders": "raw_orders",
    "raw.raw_csv_products": "raw_products", "raw.raw_csv_payments": "raw_payments", "staging.stg_client_a_transactions": "stg_a",
    "staging.stg_client_c_transactions": "stg_c", "canonical.fact_transaction": "fact_ac", "canonical.fact_transaction_item": "fact_item",
    "data_quality.dq_issue_log": "issues", "data_quality.dq_duplicate_tracker": "tracker",
}
_RECON = " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{n}' AS table_name, count(*) AS record_count FROM {_LAYERS[n]} AS t" for layer, n in reports.RECONCILED)


def _layers(w: Warehouse) -> dict[str, DataFrame]:
    i = w.inputs
    found = [i.xml_docs, i.txt_docs, i.json_docs, i.customers, i.orders, i.products, i.payments, w.stg_a, w.stg_c, w.fact, w.fact_item, w.issues, w.tracker]
    return dict(zip(_LAYERS, found))


@query("report_reconciliation", _RECON)
def report_reconciliation(w):
    return reports.report_reconciliation(_layers(w))


@query("global_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS record_count FROM {t}" for t in ("customer", "orders", "lineitem", "part")))
def global_counts(w):
    parts = [w.inputs.table(t).agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(t).alias("table_name"), "record_count") for t in ("customer", "orders", "lineitem", "part")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("report_ingestion_summary", f"""SELECT 'raw_xml_transactions' AS table_name, count(*) AS total_records, count(DISTINCT source_file_name) AS files_loaded FROM (SELECT DISTINCT doc, source_file_name FROM landed_a WHERE is_txt = 0) t
    UNION ALL SELECT 'raw_txt_xml_transactions', count(*), count(DISTINCT source_file_name) FROM (SELECT DISTINCT doc, source_file_name FROM landed_a WHERE is_txt = 1) t
    UNION ALL SELECT 'raw_json_transactions', count(*), count(DISTINCT source_file_name) FROM (SELECT DISTINCT doc, source_file_name FROM raw_headers_c) t
    UNION ALL SELECT 'raw_csv_customers', count(*), count(DISTINCT source_file_name) FROM raw_customers
    UNION ALL SELECT 'raw_csv_orders', count(*), count(DISTINCT source_file_name) FROM raw_orders
    UNION ALL SELECT 'raw_csv_products', count(*), count(DISTINCT source_file_name) FROM raw_products
    UNION ALL SELECT 'raw_csv_payments', count(*), count(DISTINCT source_file_name) FROM raw_payments""")
def report_ingestion_summary(w):
    i = w.inputs
    return reports.report_ingestion_summary({
        "raw_xml_transactions": i.xml_docs, "raw_txt_xml_transactions": i.txt_docs, "raw_json_transactions": i.json_docs,
        "raw_csv_customers": i.customers, "raw_csv_orders": i.orders, "raw_csv_products": i.products, "raw_csv_payments": i.payments,
    }, BATCH)


@query("report_txt_parse_status", f"""SELECT 'TXT XML Parse Results' AS check_type, {o.big('sum(CASE WHEN is_broken = 0 THEN 1 ELSE 0 END)')} AS success_count,
    {o.big('sum(is_broken)')} AS failure_count FROM (SELECT DISTINCT doc, is_broken FROM landed_a WHERE is_txt = 1) t""")
def report_txt_parse_status(w):
    return reports.report_txt_parse_status(w.inputs.parsed_txt_docs, BATCH)


@query("report_run_summary", f"SELECT 'reconciliation' AS report, count(*) AS row_count FROM ({_RECON}) r UNION ALL SELECT 'batch_quality', count(*) FROM metrics "
       "UNION ALL SELECT 'file_quality', count(DISTINCT source_file_name) FROM fact_ac")
def report_run_summary(w):
    parts = reports.report_run_summary(_layers(w), w.metrics, w.issues, w.tracker, w.fact, BATCH)
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("report"), "row_count") for n, df in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("report_lineage_counts", """SELECT 'RAW' AS layer, count(*) AS record_count FROM (SELECT DISTINCT doc FROM landed_a) t
    UNION ALL SELECT 'STAGING', count(*) FROM stg_a UNION ALL SELECT 'CANONICAL', count(*) FROM fact_a
    UNION ALL SELECT 'DQ_ISSUES', count(*) FROM issues WHERE source_client = 'ClientA'""")
def report_lineage_counts(w):
    shared = ["source_client", "batch_id", "source_file_name"]
    raw = w.inputs.xml_docs.select(*shared).unionByName(w.inputs.txt_docs.select(*shared))
    return reports.report_lineage_counts(raw, w.stg_a, w.fact, w.issues, "ClientA")


_AUDIT_SQL = f"""SELECT source_file_name, 'raw.raw_csv_customers' AS target_table, count(*) AS rows_loaded, 1 AS hour FROM raw_customers GROUP BY 1
    UNION ALL SELECT DISTINCT source_file_name, 'raw.raw_xml_transactions', 1, 2 FROM landed_a WHERE is_txt = 0
    UNION ALL SELECT DISTINCT source_file_name, 'raw.raw_json_transactions', 1, 3 FROM raw_headers_c"""


@query("report_recent_loads", f"SELECT source_file_name, target_table, rows_loaded FROM ({_AUDIT_SQL}) a ORDER BY hour DESC, target_table, source_file_name LIMIT 10")
def report_recent_loads(w):
    return reports.report_recent_loads(w.audit).select("source_file_name", "target_table", "rows_loaded")


@query("audit_for_batch", f"SELECT '{BATCH}' AS batch_id, source_file_name, target_table, rows_loaded FROM ({_AUDIT_SQL}) a")
def audit_of_batch(w):
    return audit_for_batch(w.audit, BATCH).select("batch_id", "source_file_name", "target_table", "rows_loaded")


@query("report_metrics_last_7_days", f"SELECT batch_id, metric_date, source_client, data_quality_score FROM metrics WHERE metric_date >= DATE '{AS_OF[:10]}' - 7")
def report_metrics_last_7_days(w):
    old = w.metrics.withColumn("metric_date", F.date_sub("metric_date", 8))
    quality_rows = reports.report_batch_quality(w.metrics.unionByName(old), w.issues, w.tracker)
    recent = reports.report_metrics_last_7_days(quality_rows, AS_OF)
    return recent.select("batch_id", "metric_date", "source_client", "data_quality_score")


@query("report_open_critical", "SELECT count(*) AS critical_issues FROM issues WHERE issue_severity = 'CRITICAL'")
def report_open_critical(w):
    return reports.report_open_critical(w.issues)


@query("report_batch_status_by_file", "SELECT source_file_name, dq_status, count(*) AS transaction_count FROM fact_ac WHERE raw_record_id % 4 = 1 GROUP BY 1, 2")
def report_batch_status_by_file(w):
    return reports.report_batch_status_by_file(w.with_test_batches(w.fact_ac), "BATCH_1")


# ---- operations and incremental ingest ------------------------------------


@query("rollback_batch", """SELECT 'fact_transaction' AS table_name, transaction_sk AS row_key FROM fact_ac WHERE raw_record_id % 4 <> 1
    UNION ALL SELECT 'fact_transaction_item', transaction_item_sk FROM fact_item WHERE transaction_sk NOT IN (SELECT transaction_sk FROM fact_ac WHERE raw_record_id % 4 = 1)""")
def rollback_batch(w):
    headers, items, _ = operations.rollback_batch(w.with_test_batches(w.fact_ac), w.fact_item, w.issues, "BATCH_1")
    return headers.select(F.lit("fact_transaction").alias("table_name"), c("transaction_sk").alias("row_key")).unionByName(
        items.select(F.lit("fact_transaction_item").alias("table_name"), c("transaction_item_sk").alias("row_key"))
    )


@query("replay_batch", f"""SELECT 'canonical.fact_transaction' AS table_name, count(*) AS row_count, {o.big('sum(transaction_sk)')} AS key_sum FROM fact_ac
    UNION ALL SELECT 'canonical.fact_transaction_item', count(*), {o.big('sum(transaction_item_sk)')} FROM fact_item""")
def replay_batch(w):
    """Load, take the batch out, load again: the result is that of a single load."""
    from ledgerloom.plans.loading import FACT_ITEM, FACT_TRANSACTION, load_all

    store, staged, _ = _loaded(w)
    operations.replay_batch(store, lambda: load_all(store, staged, AS_OF_2), BATCH)
    parts = [
        store.read(n).agg(F.count(F.lit(1)).alias("row_count"), F.sum(k).alias("key_sum")).select(F.lit(n).alias("table_name"), "row_count", "key_sum")
        for n, k in ((FACT_TRANSACTION, "transaction_sk"), (FACT_ITEM, "transaction_item_sk"))
    ]
    return parts[0].unionByName(parts[1])


@query("erase_from_raw_documents", """SELECT transaction_id_raw, order_id_raw, customer_id_raw FROM landed_a
    WHERE is_broken = 0 AND coalesce(upper(trim(customer_id_raw)), '') <> (SELECT min(customer_id) FROM fact_ac)""")
def erase_from_raw_documents(w):
    """All client-A documents, XML and text, without the transactions of one customer."""
    person = w.fact.agg(F.min("customer_id")).first()[0]
    docs = [operations.erase_from_raw(d, person, w.spark.createDataFrame([], "_id string")) for d in (w.inputs.xml_docs, w.inputs.parsed_txt_docs)]
    flat = staging_xml.extract_xml_fields(staging_xml.flatten_xml_transactions(staging_xml.union_xml_sources(*docs)))
    return flat.select("transaction_id_raw", "order_id_raw", "customer_id_raw")


@query("reprocess_file", f"SELECT raw_record_id, source_file_name FROM raw_orders WHERE source_file_name <> 'Order.csv'")
def reprocess_file(w):
    raw = w.inputs.orders
    ledger = raw.select(F.concat(F.lit("/in/"), "source_file_name").alias("path")).distinct()
    return operations.reprocess_file(raw, ledger, "Order.csv")[0].select("raw_record_id", "source_file_name")


@query("trace_transaction", "SELECT transaction_id, source_file_name, raw_record_id FROM fact_a WHERE source_format = 'XML'")
def trace_transaction(w):
    from_xml = w.fact_ac.filter("source_format = 'XML'")
    traced = operations.trace_transaction(from_xml, w.inputs.xml_docs)
    return traced.filter(F.instr("raw_content", "<SalesData") > 0).select("transaction_id", "source_file_name", "raw_record_id")


@query("erase_customer", """SELECT 'dim_customer' AS table_name, customer_id AS row_key FROM dim_customer WHERE customer_id <> 'CUST-A-7'
    UNION ALL SELECT 'fact_transaction', source_client || transaction_id FROM fact_ac WHERE customer_id IS DISTINCT FROM 'CUST-A-7'
    UNION ALL SELECT 'fact_order', order_id FROM fact_order WHERE customer_id IS DISTINCT FROM 'CUST-A-7'
    UNION ALL SELECT 'fact_transaction_item', CAST(transaction_item_sk AS VARCHAR) FROM fact_item i
      WHERE transaction_sk NOT IN (SELECT transaction_sk FROM fact_ac WHERE customer_id = 'CUST-A-7')
    UNION ALL SELECT 'fact_payment', payment_id FROM fact_payment p
      WHERE EXISTS (SELECT 1 FROM fact_order f WHERE f.order_id = p.order_id AND f.customer_id IS DISTINCT FROM 'CUST-A-7')
         OR NOT (EXISTS (SELECT 1 FROM fact_order f WHERE f.order_id = p.order_id) OR EXISTS (SELECT 1 FROM fact_ac t WHERE t.order_id = p.order_id AND t.customer_id = 'CUST-A-7')
            OR (EXISTS (SELECT 1 FROM fact_ac t WHERE t.transaction_id = p.transaction_id AND t.customer_id = 'CUST-A-7')
                AND NOT EXISTS (SELECT 1 FROM fact_ac t WHERE t.transaction_id = p.transaction_id AND t.customer_id IS DISTINCT FROM 'CUST-A-7')))""")
def erase_customer(w):
    tables = {"dim_customer": w.dim_customer.filter("customer_sk != -1"), "fact_transaction": w.fact_ac, "fact_order": w.fact_order, "fact_payment": w.fact_payment,
              "fact_transaction_item": w.fact_item}
    left = operations.erase_customer(tables, "CUST-A-7")
    keys_of = {
        "dim_customer": c("customer_id"), "fact_transaction": F.concat("source_client", "transaction_id"), "fact_order": c("order_id"),
        "fact_payment": c("payment_id"), "fact_transaction_item": c("transaction_item_sk").cast("string"),
    }
    parts = [left[n].select(F.lit(n).alias("table_name"), k.alias("row_key")) for n, k in keys_of.items()]
    return reduce(DataFrame.unionByName, parts)


@query("incremental_file_ingest", "SELECT order_id_raw, customer_id_raw, CAST(1 AS BIGINT) AS times_loaded FROM raw_orders WHERE order_id_raw <> ''")
def incremental_ingest(w):
    """New files only: the second run over the same folder adds nothing."""
    path = w.inputs.csv_files(truth.ORDERS, formats.ORDERS, "stream")
    sink, checkpoint = fresh_path(w.spark, "stream-sink"), fresh_path(w.spark, "stream-checkpoint")
    schema = formats.ORDERS.reader_schema()

    def write(step: DataFrame, number: int) -> None:
        step.select("order_id_raw", "customer_id_raw").write.mode("overwrite").parquet(f"{sink}/step={number}")

    for _ in range(2):
        stream = file_stream(w.spark, path, schema=schema, options=formats.CSV_READER_OPTIONS, files_per_step=4)
        incremental_file_ingest(stream, checkpoint, write)
    loaded = w.spark.read.parquet(sink).filter("order_id_raw IS NOT NULL")
    blank = F.coalesce("customer_id_raw", F.lit(""))
    return loaded.groupBy("order_id_raw", blank.alias("customer_id_raw")).agg(F.count(F.lit(1)).alias("times_loaded"))


from . import format_queries  # noqa: E402, F401  registers its queries in the tables above
