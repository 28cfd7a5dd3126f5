"""Client-A staging: XML documents to flagged transaction headers and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import functions as x
from ..functions.parse import abs_integer
from ..sources import documents
from ..sources.formats import CORRUPT, XML_OPTIONS

_AMOUNT = "struct<_VALUE:string,_currency:string>"
_ITEM = (
    f"struct<SKU:string,Description:string,Quantity:string,UnitPrice:{_AMOUNT},"
    "Attributes:string,Warranty:string,GiftOptions:string>"
)
_CUSTOMER = (
    "struct<CustomerID:string,Name:struct<FirstName:string,LastName:string>,Email:string,LoyaltyTier:string,"
    "Metadata:string,Tags:string,Notes:string,Preferences:string,Flags:string,Attributes:string>"
)
TRANSACTION = (
    "TransactionID:string,"
    f"Order:struct<OrderID:string,OrderDate:string,Customer:{_CUSTOMER}>,"
    f"Items:struct<Item:array<{_ITEM}>>,"
    f"Payment:struct<Method:string,Amount:{_AMOUNT},Fees:string>"
)
DOCUMENT_SCHEMA = f"Transaction array<struct<{TRANSACTION}>>, {CORRUPT} string"

LINEAGE = [
    "raw_record_id", "source_file_name", "source_client", "source_format",
    "ingestion_timestamp", "batch_id", "file_hash",
]


def union_xml_sources(xml_docs: DataFrame, txt_docs: DataFrame) -> DataFrame:
    """Client-A XML documents and the successfully parsed text documents, in one shape."""
    shared = [c for c in LINEAGE if c not in ("file_hash", "source_format")]

    def shape(df: DataFrame, fmt: Column) -> DataFrame:
        return df.select(
            *shared, fmt.alias("source_format"), F.col("record_hash").alias("file_hash"),
            F.col("raw_xml_content").alias("xml_doc"),
        )

    from_xml = shape(xml_docs.filter(F.col("source_client") == "ClientA"), F.col("source_format"))
    from_txt = shape(txt_docs.filter("xml_parse_success"), F.lit("XML_FROM_TXT"))
    return from_xml.unionByName(from_txt)


def flatten_xml_transactions(sources: DataFrame) -> DataFrame:
    """One row per ``<Transaction>`` with its position among them."""
    parsed = F.from_xml(F.col("xml_doc"), DOCUMENT_SCHEMA, XML_OPTIONS)
    return sources.select(*LINEAGE, F.posexplode(parsed["Transaction"]).alias("transaction_index", "transaction"))


def malformed_xml(sources: DataFrame) -> DataFrame:
    """Documents that do not parse."""
    parsed = F.from_xml(F.col("xml_doc"), f"Transaction array<string>, {CORRUPT} string", XML_OPTIONS)
    return sources.filter(parsed[CORRUPT].isNotNull())


def parse_xml_records(records: DataFrame) -> DataFrame:
    """The same shape from single-transaction records."""
    parsed = F.from_xml(F.col("transaction_xml"), f"struct<{TRANSACTION}>", XML_OPTIONS)
    usable = records.filter(~F.col("crosses_comment"))
    # the generator keeps the parse from being repeated for every extracted field
    return usable.select(*LINEAGE, "transaction_index", F.explode(F.array(parsed)).alias("transaction"))


def read_xml_transactions(spark: SparkSession, path, batch_id: str, as_of: str) -> DataFrame:
    """All transactions of the XML and text files of a folder."""
    xml = documents.read_xml_documents(spark, path, batch_id, as_of)
    txt = documents.parse_txt_xml(documents.read_txt_documents(spark, path, batch_id, as_of))
    return flatten_xml_transactions(union_xml_sources(xml, txt))


def extract_xml_fields(flat: DataFrame) -> DataFrame:
    t = F.col("transaction")
    customer = t["Order"]["Customer"]
    return flat.withColumns({
        "transaction_id_raw": t["TransactionID"],
        "order_id_raw": t["Order"]["OrderID"],
        "order_date_raw": t["Order"]["OrderDate"],
        "customer_id_raw": customer["CustomerID"],
        "first_name_raw": customer["Name"]["FirstName"],
        "last_name_raw": customer["Name"]["LastName"],
        "email_raw": customer["Email"],
        "payment_method_raw": t["Payment"]["Method"],
        "payment_amount_raw": t["Payment"]["Amount"]["_VALUE"],
        "payment_currency_raw": t["Payment"]["Amount"]["_currency"],
        "items": t["Items"]["Item"],
    })


def standardize_client_a(extracted: DataFrame) -> DataFrame:
    c = F.col
    amount = x.safe_decimal(c("payment_amount_raw"))
    return extracted.withColumns({
        "transaction_id": x.norm_upper(c("transaction_id_raw")),
        "order_id": x.norm_upper(c("order_id_raw")),
        "order_date": x.safe_date(c("order_date_raw")),
        "customer_id": x.norm_upper(c("customer_id_raw")),
        "first_name": x.norm_initcap(c("first_name_raw")),
        "last_name": x.norm_initcap(c("last_name_raw")),
        "email": x.norm_lower(c("email_raw")),
        "email_validation_status": x.email_status(c("email_raw")),
        "payment_method": x.payment_method_code(c("payment_method_raw")),
        "payment_amount": amount,
        "payment_amount_abs": x.abs_value(amount),
        "payment_currency": x.default_currency(c("payment_currency_raw")),
    })


def extract_xml_extras(extracted: DataFrame) -> DataFrame:
    """Optional structures kept as payload, and a summary of which are present."""
    customer = F.col("transaction")["Order"]["Customer"]
    fees = F.col("transaction")["Payment"]["Fees"]
    extras = {
        "metadata": customer["Metadata"], "tags": customer["Tags"], "preferences": customer["Preferences"],
        "notes": customer["Notes"], "flags": customer["Flags"], "attributes": customer["Attributes"], "fees": fees,
    }
    summary = x.object_construct_keep_null(
        customer["LoyaltyTier"].alias("loyalty_tier"),
        *[value.isNotNull().alias(f"has_{name}") for name, value in extras.items()],
    )
    columns = {"loyalty_tier_extra": customer["LoyaltyTier"]}
    columns.update({f"{name}_extra": value for name, value in extras.items()})
    return extracted.withColumns({**columns, "extra_fields_summary": summary})


def flag_client_a(standard: DataFrame) -> DataFrame:
    c = F.col
    return standard.withColumns({
        "is_missing_transaction_id": x.missing_flag(c("transaction_id_raw")),
        "is_missing_order_id": x.missing_flag(c("order_id_raw")),
        "is_missing_order_date": x.missing_flag(c("order_date_raw")),
        "is_invalid_order_date": c("order_date").isNull() & ~x.missing_flag(c("order_date_raw")),
        "is_missing_customer_id": x.missing_flag(c("customer_id_raw")),
        "is_missing_email": x.missing_flag(c("email_raw")),
        "is_missing_first_name": x.missing_flag(c("first_name_raw")),
        "is_missing_last_name": x.missing_flag(c("last_name_raw")),
        "is_missing_payment_method": x.missing_flag(c("payment_method_raw")),
        "is_missing_payment_amount": x.missing_flag(c("payment_amount_raw")),
        "is_negative_payment_amount": x.negative_flag(c("payment_amount")),
    })


def stage_flat_client_a(flat: DataFrame) -> DataFrame:
    staged = flag_client_a(extract_xml_extras(standardize_client_a(extract_xml_fields(flat))))
    payload = F.to_xml(F.col("transaction"), {"rowTag": "Transaction"})
    return staged.withColumn("raw_transaction_xml", payload).drop("transaction")


def stage_client_a_transactions(xml_docs: DataFrame, txt_docs: DataFrame) -> DataFrame:
    return stage_flat_client_a(flatten_xml_transactions(union_xml_sources(xml_docs, txt_docs)))


# ---- items ----------------------------------------------------------------

ITEM_PARENT = [
    "raw_record_id", "source_file_name", "source_client", "transaction_index", "transaction_id", "transaction_id_raw",
    "order_id", "customer_id", "order_date", "ingestion_timestamp", "batch_id",
]


def flatten_xml_items(staged: DataFrame) -> DataFrame:
    """One row per ``<Item>`` with its 1-based line number."""
    flat = staged.select(*ITEM_PARENT, F.posexplode("items").alias("item_index", "item"))
    return flat.withColumn("line_number", F.col("item_index") + 1)


def extract_item_fields(flat: DataFrame) -> DataFrame:
    item = F.col("item")
    extras = {"attributes": item["Attributes"], "warranty": item["Warranty"], "gift_options": item["GiftOptions"]}
    return flat.withColumns({
        "sku_raw": item["SKU"],
        "description_raw": item["Description"],
        "quantity_raw": item["Quantity"],
        "unit_price_raw": item["UnitPrice"]["_VALUE"],
        "currency_raw": item["UnitPrice"]["_currency"],
        **{f"{name}_extra": value for name, value in extras.items()},
        "item_extra_fields_summary": x.object_construct_keep_null(
            *[value.isNotNull().alias(f"has_{name}") for name, value in extras.items()]
        ),
    })


def standardize_item_values(df: DataFrame, sku: Column, description: Column, quantity: Column, price: Column, currency: Column) -> DataFrame:
    """Typed item columns, absolute values and line totals; shared by both clients."""
    typed = df.withColumns({
        "sku": x.norm_upper(sku),
        "description": x.norm_trim(description),
        "quantity": x.safe_integer(quantity),
        "unit_price": x.safe_decimal(price),
        "currency": x.default_currency(currency),
    })
    q, p = F.col("quantity"), F.col("unit_price")
    return typed.withColumns({
        "quantity_abs": abs_integer(q),
        "unit_price_abs": x.abs_value(p),
        "line_total": x.line_total(q, p),
        "line_total_abs": x.abs_value(x.line_total(q, p)),
    })


def standardize_items(extracted: DataFrame) -> DataFrame:
    c = F.col
    return standardize_item_values(
        extracted, c("sku_raw"), c("description_raw"), c("quantity_raw"), c("unit_price_raw"), c("currency_raw")
    )


def flag_client_a_items(standard: DataFrame) -> DataFrame:
    c = F.col
    return standard.withColumns({
        "is_missing_sku": x.missing_flag(c("sku_raw")),
        "is_missing_description": x.missing_flag(c("description_raw")),
        "is_missing_quantity": c("quantity").isNull(),
        "is_negative_quantity": x.negative_flag(c("quantity")),
        "is_zero_quantity": x.zero_flag(c("quantity")),
        "is_missing_unit_price": c("unit_price").isNull(),
        "is_negative_unit_price": x.negative_flag(c("unit_price")),
        "is_zero_unit_price": x.zero_flag(c("unit_price")),
    })


def stage_client_a_items(staged: DataFrame) -> DataFrame:
    items = flag_client_a_items(standardize_items(extract_item_fields(flatten_xml_items(staged))))
    return items.withColumn("raw_item_xml", F.to_xml(F.col("item"), {"rowTag": "Item"})).drop("item")
