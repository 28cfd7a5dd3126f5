"""Client-C staging: JSON documents with varying field names to flagged headers and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as x
from ..sources.formats import null_if_token
from .staging_xml import ITEM_PARENT, LINEAGE, standardize_item_values

# Paths read from a transaction and from an item (raw column -> path).
TRANSACTION_PATHS = {
    "transaction_id_raw": "$.transaction_id",
    "transaction_id_alt_raw": "$.txn_id",
    "order_id_raw": "$.order.order_id",
    "order_date_raw": "$.order.order_date",
    "order_status_raw": "$.order.status",
    "customer_id_raw": "$.order.customer.customer_id",
    "customer_id_alt_raw": "$.order.customer.id",
    "first_name_raw": "$.order.customer.first_name",
    "last_name_raw": "$.order.customer.last_name",
    "full_name_raw": "$.order.customer.name",
    "email_raw": "$.order.customer.email",
    "loyalty_tier_raw": "$.order.customer.loyalty_tier",
    "tier_alt_raw": "$.order.customer.tier",
    "payment_method_raw": "$.payment.method",
    "payment_method_alt_raw": "$.payment.payment_method",
    "payment_amount_raw": "$.payment.amount",
    "payment_total_alt_raw": "$.payment.total",
    "payment_currency_raw": "$.payment.currency",
}
ITEM_PATHS = {
    "sku_raw": "$.sku",
    "product_id_raw": "$.product_id",
    "description_raw": "$.description",
    "name_raw": "$.name",
    "quantity_raw": "$.quantity",
    "qty_alt_raw": "$.qty",
    "unit_price_raw": "$.unit_price",
    "price_alt_raw": "$.price",
    "currency_raw": "$.currency",
}

# The members read, in one cast: a path is looked up and cast by itself for each column. Names are in the order of JSON text.
_TEXTS = "map<string,string>"
_MEMBERS = (
    f"struct<order:struct<customer:{_TEXTS},order_date:string,order_id:string,status:string>,payment:{_TEXTS},"
    "transaction_id:string,txn_id:string>"
)


def _schema(*members: tuple[str, str]) -> str:
    """Pattern of the schema of an object with some of the members, in this order."""
    return "OBJECT<" + "".join(f"(?:{name}: {kind}(?:, |(?=>)))?" for name, kind in members) + ">"


# An object whose members are strings or null; the bound keeps the pattern from recursing, more members are written the long way
_FLAT = r"OBJECT<(?:\w+: (?:STRING|VOID)(?:, |(?=>))){0,64}>"
_KNOWN = _schema(
    ("items", f"ARRAY<{_FLAT}>"),
    ("order", _schema(("customer", _FLAT), ("order_date", "STRING"), ("order_id", "STRING"), ("status", "STRING"))),
    ("payment", _FLAT), ("transaction_id", "STRING"), ("txn_id", "STRING"),
)


def _plain(document: str, schema: str) -> Column:
    """All of the document is in the cast, and all its values are strings, so that the JSON text of the cast is that of the
    document. Text of a variant makes a new JSON writer for every string and name."""
    return F.schema_of_variant(document).rlike(f"^{schema}$")


def _text(members: Column, path: str) -> Column:
    for name in path.removeprefix("$.").split("."):
        members = members[name]
    return members


def flatten_json_transactions(docs: DataFrame) -> DataFrame:
    """One row per transaction; the list is the root or its ``transactions`` member."""
    lineage = [c for c in LINEAGE if c != "file_hash"]
    parsed = docs.filter(F.col("source_client") == "ClientC").select(
        *lineage, F.col("record_hash").alias("file_hash"),
        F.explode(F.array(F.try_parse_json("raw_json_content"))).alias("document"),
    )
    listed = F.coalesce(
        F.try_variant_get("document", "$.transactions", "array<variant>"),
        F.try_variant_get("document", "$", "array<variant>"),
    )
    flat = parsed.select(*LINEAGE, F.posexplode(listed).alias("transaction_index", "transaction"))
    return flat.filter(F.col("transaction").isNotNull() & ~F.is_variant_null("transaction"))


def malformed_json(docs: DataFrame) -> DataFrame:
    return docs.filter(F.try_parse_json("raw_json_content").isNull())


def _extracted(flat: DataFrame, null_tokens: list | None = None) -> DataFrame:
    """Fields, with the cast as ``_t`` and whether it holds all of the transaction as ``_plain``."""
    # the generator keeps the cast from being repeated for every column
    parsed = F.struct(F.try_variant_get("transaction", "$", _MEMBERS).alias("t"), _plain("transaction", _KNOWN).alias("plain"))
    told = flat.select("*", F.explode(F.array(parsed)).alias("_p")).select(*flat.columns, F.col("_p.t").alias("_t"), F.col("_p.plain").alias("_plain"))
    columns = {name: _text(F.col("_t"), path) for name, path in TRANSACTION_PATHS.items()}
    if null_tokens:
        columns = {name: null_if_token(F.trim(text), null_tokens) for name, text in columns.items()}
    columns["items"] = F.try_variant_get("transaction", "$.items", "array<variant>")
    for name, path in (("customer_json", "$.order.customer"), ("payment_json", "$.payment")):
        whole = F.to_json(F.try_variant_get("transaction", path, "variant"))
        columns[name] = F.when(F.col("_plain"), F.to_json(_text(F.col("_t"), path))).otherwise(whole)
    return told.withColumns(columns)


def extract_json_fields(flat: DataFrame, null_tokens: list | None = None) -> DataFrame:
    """Fields as text; with ``null_tokens``, values that are one of them but for blanks are NULL."""
    return _extracted(flat, null_tokens).drop("_t", "_plain")


def coalesce_field_variants(primary: Column, alternate: Column, empty_as_missing: bool = False) -> Column:
    """The primary field, else the alternate. An empty primary hides the alternate unless told otherwise."""
    if empty_as_missing:
        primary = F.when(F.trim(primary) != "", primary)
    return F.coalesce(primary, alternate)


def _variants(empty_as_missing: bool) -> dict[str, Column]:
    c = F.col

    def pick(primary: str, alternate: str) -> Column:
        return coalesce_field_variants(c(primary), c(alternate), empty_as_missing)

    return {
        "_transaction_id": pick("transaction_id_raw", "transaction_id_alt_raw"),
        "_customer_id": pick("customer_id_raw", "customer_id_alt_raw"),
        "_tier": pick("loyalty_tier_raw", "tier_alt_raw"),
        "_method": pick("payment_method_raw", "payment_method_alt_raw"),
        "_amount": pick("payment_amount_raw", "payment_total_alt_raw"),
    }


def split_full_name(first: Column, last: Column, full: Column) -> tuple[Column, Column]:
    return x.first_name_from(first, full), x.last_name_from(last, full)


def standardize_client_c(extracted: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    c = F.col
    picked = extracted.withColumns(_variants(empty_as_missing))
    first, last = split_full_name(c("first_name_raw"), c("last_name_raw"), c("full_name_raw"))
    amount = x.safe_decimal(c("_amount"))
    return picked.withColumns({
        "transaction_id": x.norm_upper(c("_transaction_id")),
        "order_id": x.norm_upper(c("order_id_raw")),
        "order_date": x.safe_date(c("order_date_raw")),
        "customer_id": x.norm_upper(c("_customer_id")),
        "first_name": first,
        "last_name": last,
        "email": x.norm_lower(c("email_raw")),
        "email_validation_status": x.email_status(c("email_raw")),
        "loyalty_tier": x.loyalty_tier_code(c("_tier")),
        "payment_method": x.payment_method_code(c("_method")),
        "payment_amount": amount,
        "payment_amount_abs": x.abs_value(amount),
        "payment_currency": x.default_currency(c("payment_currency_raw")),
    })


def count_items(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def build_transaction_metadata(extracted: DataFrame) -> DataFrame:
    tier = F.try_variant_get("transaction", "$.order.customer.loyalty_tier", "variant")
    return extracted.withColumn("transaction_metadata", x.object_construct_keep_null(
        F.col("source_file_name").alias("source_file"),
        tier.isNotNull().alias("has_loyalty_tier"),
        F.col("order_status_raw").alias("order_status"),
    ))


def flag_client_c(standard: DataFrame) -> DataFrame:
    c = F.col
    return standard.withColumns({
        "is_missing_transaction_id": x.missing_flag(c("_transaction_id")),
        "is_missing_order_id": x.missing_flag(c("order_id_raw")),
        "is_missing_order_date": x.missing_flag(c("order_date_raw")),
        "is_invalid_order_date": c("order_date").isNull() & ~x.missing_flag(c("order_date_raw")),
        "is_missing_customer_id": x.missing_flag(c("_customer_id")),
        "is_missing_email": x.missing_flag(c("email_raw")),
        "is_missing_payment_method": x.missing_flag(c("_method")),
        "is_missing_payment_amount": x.missing_flag(c("_amount")),
        "is_negative_payment_amount": x.negative_flag(c("payment_amount")),
        "has_empty_items": c("items_count") == 0,
    })


def stage_client_c_transactions(docs: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    extracted = _extracted(flatten_json_transactions(docs))
    standard = standardize_client_c(extracted, empty_as_missing).withColumn("items_count", count_items(F.col("items")))
    staged = flag_client_c(build_transaction_metadata(standard))
    items = F.try_variant_get("transaction", "$.items", f"array<{_TEXTS}>")
    text = F.when(F.col("_plain"), F.to_json(F.struct(items.alias("items"), "_t.*"))).otherwise(F.to_json("transaction"))
    staged = staged.withColumn("raw_transaction_json", text)
    return staged.drop("transaction", "_t", "_plain", "_transaction_id", "_customer_id", "_tier", "_method", "_amount")


def stage_client_c_items(staged: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    flat = staged.select(*ITEM_PARENT, F.posexplode("items").alias("item_index", "item"))
    flat = flat.filter(F.col("item").isNotNull() & ~F.is_variant_null("item"))
    flat = flat.withColumn("line_number", F.col("item_index") + 1)
    flat = flat.select("*", F.explode(F.array(F.try_variant_get("item", "$", _TEXTS))).alias("_t"))
    raw = flat.withColumns({name: _text(F.col("_t"), path) for name, path in ITEM_PATHS.items()})

    def pick(primary: str, alternate: str) -> Column:
        return coalesce_field_variants(F.col(primary), F.col(alternate), empty_as_missing)

    raw = raw.withColumns({
        "_sku": pick("sku_raw", "product_id_raw"),
        "_description": pick("description_raw", "name_raw"),
        "_quantity": pick("quantity_raw", "qty_alt_raw"),
        "_price": pick("unit_price_raw", "price_alt_raw"),
    })
    c = F.col
    typed = standardize_item_values(raw, c("_sku"), c("_description"), c("_quantity"), c("_price"), c("currency_raw"))
    flagged = typed.withColumns({
        "is_missing_sku": x.missing_flag(c("_sku")),
        "is_missing_description": x.missing_flag(c("_description")),
        "is_missing_quantity": c("quantity").isNull(),
        "is_negative_quantity": x.negative_flag(c("quantity")),
        "is_negative_unit_price": x.negative_flag(c("unit_price")),
        "item_metadata_json": F.when(_plain("item", _FLAT), F.to_json("_t")).otherwise(F.to_json("item")),
    })
    return flagged.drop("item", "_t", "_sku", "_description", "_quantity", "_price")
