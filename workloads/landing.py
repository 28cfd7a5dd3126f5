"""Landing data for the registered queries: rows, documents and files made from the driver tables by Spark."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ledgerloom.session import configure, fresh_path, materialize
from ledgerloom.sources import csv_files, formats
from ledgerloom.sources.documents import hash_document, parse_txt_xml
from ledgerloom.sources.files import stamp

from . import truth
from .truth import AS_OF, BATCH

TABLES = ["customer", "orders", "lineitem", "part", "events", "documents", "nation", "region", "supplier"]
# rows dealt by document serve joins and groups on further columns; what comes sorted is grouped row by row, without a table of groups
SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}
# the order of lines in truth.LINES. Lines that agree in these columns are the same row of the result, so the
# later columns of the statement's order need not go through the shuffle
LINE_ORDER = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
# rows of a file of raw CSV rows
RAW_ROWS_PER_FILE = 50_000
# orders from -511 to this key are in documents from 0 on, whose numbers neither other orders nor copies have
NEAR = 512 * 500_000_000


def _element(tag: str, value: Column) -> Column:
    """``<tag>value</tag>``, or nothing for NULL."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))).otherwise("")


def _numbered(items: DataFrame, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Lines with their number in the order; ``dealt`` are columns that orders are dealt by."""
    return items.select(
        *dealt, F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p"),
        F.row_number().over(W.partitionBy(*dealt, "l_orderkey").orderBy(*LINE_ORDER)).alias("line"),
        F.col("l_quantity").cast("decimal(18,0)").alias("qty"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )


class Landing:
    """Inputs at rest for one scale. Documents are written once and shared by the queries of a session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        for key, value in SETTINGS.items():
            self.spark.conf.set(key, value)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """The rows of ``truth.LINES``, numbered once for all readers."""
        return materialize(_numbered(self.table("lineitem").select("l_orderkey", *LINE_ORDER)), "lines")

    def rows(self, sql: str) -> DataFrame:
        sql = sql.replace(f"({truth.LINES})", "{lines}")
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in sql}
        if "{lines}" in sql:
            used["lines"] = self.lines
        return self.spark.sql(sql, **used)

    # ---- CSV rows ----

    def _csv(self, name: str, sql: str, entity: formats.CsvEntity, as_of: str = AS_OF, batch: str = BATCH) -> DataFrame:
        """A raw CSV table at rest, in files of a size for one task; rows stay with the task that reads them."""
        rows = stamp(csv_files.hash_columns(self.rows(sql), entity), batch, as_of)
        return materialize(rows, name, RAW_ROWS_PER_FILE)

    @cached_property
    def customers(self) -> DataFrame:
        return self._csv("raw-customers", truth.CUSTOMERS, formats.CUSTOMERS)

    @cached_property
    def customers_day_2(self) -> DataFrame:
        return self._csv("raw-customers-2", truth.CUSTOMERS_DAY_2, formats.CUSTOMERS, truth.AS_OF_2, "BATCH_2")

    @cached_property
    def orders(self) -> DataFrame:
        return self._csv("raw-orders", truth.ORDERS, formats.ORDERS)

    @cached_property
    def products(self) -> DataFrame:
        return self._csv("raw-products", truth.PRODUCTS, formats.PRODUCTS)

    @cached_property
    def payments(self) -> DataFrame:
        return self._csv("raw-payments", truth.PAYMENTS, formats.PAYMENTS)

    def csv_files(self, sql: str, entity: formats.CsvEntity, name: str) -> str:
        """Write landing rows as CSV part files in a folder and return its path."""
        path = fresh_path(self.spark, f"landing-csv-{name}")
        rows = self.rows(sql).select(*[F.col(c).alias(c.removesuffix("_raw")) for c in entity.raw_columns])
        rows.write.option("header", True).option("quote", '"').option("escape", '"').option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).option("maxRecordsPerFile", 20000).csv(path)
        return path

    def csv_inbox(self, sql: str, entity: formats.CsvEntity, name: str) -> str:
        """The same, below a folder, in files of the given name."""
        folder = self.csv_files(sql, entity, entity.target)
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
        parts = [f.getPath() for f in fs.listStatus(fs_path(folder)) if f.getPath().getName().startswith("part-")]
        for i, part in enumerate(parts):  # one folder for each part file
            fs.mkdirs(fs_path(f"{folder}/{i}"))
            fs.rename(part, fs_path(f"{folder}/{i}/{name}"))
        return folder

    # ---- documents ----

    def _emitted(self, table: str, key: str, parity: int, near: bool) -> DataFrame:
        """Rows of orders or lines with number of copy and document, as in ``truth.HEADERS_A`` and ``HEADERS_C``.

        Near are the originals, all but some with keys out of the ordinary; the rest are these and the copies, whose documents
        hold other key ranges. No document has rows of both.
        """
        rows, o = self.table(table).filter(F.col(key) % 2 == parity), F.col(key)
        ordinary = (o > -512) & (o < NEAR)

        def copy(chosen: Column, number: int, doc: str) -> DataFrame:
            return rows.filter(chosen).withColumns({"copy": F.lit(number), "doc": F.expr(doc)})

        if near:
            return copy(ordinary, 0, truth.div(key, 512))
        return copy(~ordinary, 0, truth.div(key, 512)).unionByName(copy(o % 97 == parity, 1, f"1000000000 + {truth.div(key, 16384)}"))

    def _headers(self, sql: str, items_sql: str, parity: int, item: Column, near: bool) -> DataFrame:
        """Rows of ``truth.HEADERS_A`` or ``HEADERS_C`` with ``basket``, the ordered list of items (null without lines).

        Orders and lines are dealt by document once. Line numbers, sums, baskets, the join of both and what is grouped by document
        afterwards need no further exchange, so that the texts made here are not shuffled.
        """
        dealt = ("doc",) if near else ("doc", "copy")
        lines = self._emitted("lineitem", "l_orderkey", parity, near).select(*dealt, "l_orderkey", *LINE_ORDER).repartition("doc")
        items = self.spark.sql(
            items_sql.replace(f"({truth.LINES})", "{lines}").replace("SELECT o, line", f"SELECT {', '.join(dealt)}, qty, price, o, line"),
            lines=_numbered(lines, dealt),
        )
        baskets = items.groupBy(*dealt, F.col("o").alias("o_orderkey")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("line", item.alias("item")))), lambda i: i["item"]).alias("basket"),
            F.expr(truth.LINE_SUM).alias("line_sum"),
        )
        orders = self._emitted("orders", "o_orderkey", parity, near).repartition("doc").join(baskets, [*dealt, "o_orderkey"], "left")
        sql = sql.replace(truth.orders_with_sums(parity), "FROM {orders}").replace("SELECT o_orderkey AS o,", "SELECT basket, o_orderkey AS o,", 1)
        return self.spark.sql(sql, orders=orders)

    def _transactions_a_xml(self, near: bool) -> DataFrame:
        """One row per client-A transaction with its XML text."""
        item = F.concat(
            F.lit("<Item>"),
            _element("SKU", F.col("sku_text")), _element("Description", F.col("description_text")),
            _element("Quantity", F.col("quantity_text")),
            F.lit('<UnitPrice currency="'), F.col("currency_text"), F.lit('">'), F.col("unit_price_text"), F.lit("</UnitPrice>"),
            _element("Attributes", F.col("attributes_extra")), _element("Warranty", F.col("warranty_extra")),
            _element("GiftOptions", F.col("gift_options_extra")), F.lit("</Item>"),
        )
        c = F.col
        text = F.concat(
            F.lit("<Transaction>"), _element("TransactionID", c("transaction_id_raw")),
            F.lit("<Order>"), _element("OrderID", c("order_id_raw")), _element("OrderDate", c("order_date_raw")),
            F.lit("<Customer>"), _element("CustomerID", c("customer_id_raw")),
            F.lit("<Name>"), _element("FirstName", c("first_name_raw")), _element("LastName", c("last_name_raw")), F.lit("</Name>"),
            _element("Email", c("email_raw")), _element("LoyaltyTier", c("loyalty_tier_extra")),
            _element("Metadata", c("metadata_extra")), _element("Tags", c("tags_extra")), _element("Notes", c("notes_extra")),
            _element("Preferences", c("preferences_extra")), _element("Flags", c("flags_extra")),
            _element("Attributes", c("attributes_extra")), F.lit("</Customer></Order>"),
            F.lit("<Items>"), F.coalesce(F.array_join("basket", ""), F.lit("")), F.lit("</Items>"),
            F.lit("<Payment>"), _element("Method", c("payment_method_raw")),
            F.lit('<Amount currency="'), c("payment_currency_raw"), F.lit('">'), c("payment_amount_raw"), F.lit("</Amount>"),
            _element("Fees", c("fees_extra")), F.lit("</Payment></Transaction>"),
        )
        headers = self._headers(truth.HEADERS_A, truth.ITEM_TEXT, 0, item, near)
        return headers.select(
            "doc", "is_txt", "is_broken", "source_file_name", "raw_record_id", "transaction_index", text.alias("text")
        )

    def _documents(self, transactions: Callable[[bool], DataFrame], keys: list[str], separator: str) -> DataFrame:
        """The other keys are the same in all rows of a document."""
        ordered = F.array_sort(F.collect_list(F.struct("transaction_index", "text")))
        body = F.array_join(F.transform(ordered, lambda t: t["text"]), separator).alias("body")
        near, rest = (transactions(near).groupBy("doc").agg(*[F.first(k).alias(k) for k in keys], body) for near in (True, False))
        return near.unionByName(rest)

    def _documents_a(self, condition: str = "true") -> DataFrame:
        """Client-A documents; ``condition`` tells which, before their texts are made."""
        keys = ["is_txt", "is_broken", "source_file_name", "raw_record_id"]
        docs = self._documents(lambda near: self._transactions_a_xml(near).filter(condition), keys, "\n")
        xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<SalesData client="ClientA">\n'), "body", F.lit("\n</SalesData>"))
        body = F.when(F.col("is_broken") == 1, F.concat("body", F.lit("<Transaction><Order>"))).otherwise(F.col("body"))
        txt = F.concat(F.lit("Export of the day\n<!-- lines > 0 -->\n"), body, F.lit("\n"))
        return docs.select("doc", *keys, F.when(F.col("is_txt") == 1, txt).otherwise(xml).alias("content"))

    @cached_property
    def documents_a(self) -> DataFrame:
        return materialize(self._documents_a(), "documents-a")

    def txt_files(self) -> str:
        """Write the text documents, one per file; returns the folder. The others are not made for them."""
        return self.document_files(self._documents_a("is_txt = 1"), "content", "txt")

    @property
    def xml_docs(self) -> DataFrame:
        docs = self.documents_a.filter("is_txt = 0").withColumnRenamed("content", "raw_xml_content")
        docs = docs.withColumn("record_hash", hash_document(F.col("raw_xml_content")))
        return stamp(docs.drop("doc", "is_txt", "is_broken"), BATCH, AS_OF, "ClientA", "XML")

    @property
    def txt_docs(self) -> DataFrame:
        """Text documents before parsing."""
        docs = self.documents_a.filter("is_txt = 1").withColumnRenamed("content", "raw_text_content")
        return stamp(docs.drop("doc", "is_txt", "is_broken"), BATCH, AS_OF, "ClientA", "TXT_XML")

    @property
    def parsed_txt_docs(self) -> DataFrame:
        return parse_txt_xml(self.txt_docs)

    def _transactions_c_json(self, near: bool) -> DataFrame:
        """One row per client-C transaction with its JSON text."""
        c = F.col
        item = F.struct(
            c("sku_raw").alias("sku"), c("product_id_raw").alias("product_id"), c("description_raw").alias("description"),
            c("name_raw").alias("name"),
            c("quantity_raw").alias("quantity"), c("qty_alt_raw").alias("qty"), c("unit_price_raw").alias("unit_price"),
            c("price_alt_raw").alias("price"), c("currency_raw").alias("currency"),
        )
        customer = F.struct(
            c("customer_id_raw").alias("customer_id"), c("customer_id_alt_raw").alias("id"),
            c("first_name_raw").alias("first_name"), c("last_name_raw").alias("last_name"), c("full_name_raw").alias("name"),
            c("email_raw").alias("email"), c("loyalty_tier_raw").alias("loyalty_tier"), c("tier_alt_raw").alias("tier"),
        )
        order = F.struct(
            c("order_id_raw").alias("order_id"), c("order_date_raw").alias("order_date"),
            c("order_status_raw").alias("status"), customer.alias("customer"),
        )
        payment = F.struct(
            c("payment_method_raw").alias("method"), c("payment_method_alt_raw").alias("payment_method"),
            c("payment_amount_raw").alias("amount"), c("payment_total_alt_raw").alias("total"),
            c("payment_currency_raw").alias("currency"),
        )
        text = F.to_json(F.struct(
            c("transaction_id_raw").alias("transaction_id"), c("transaction_id_alt_raw").alias("txn_id"),
            order.alias("order"), payment.alias("payment"), c("basket").alias("items"),
        ))
        headers = self._headers(truth.HEADERS_C, truth.ITEMS_C, 1, item, near)
        return headers.select("doc", "source_file_name", "raw_record_id", "transaction_index", text.alias("text"))

    @cached_property
    def documents_c(self) -> DataFrame:
        docs = self._documents(self._transactions_c_json, ["source_file_name", "raw_record_id"], ",")
        listed = F.concat(F.lit('{"transactions":['), "body", F.lit("]}"))
        rooted = F.concat(F.lit("["), "body", F.lit("]"))
        content = F.when(F.col("doc") % 2 == 0, listed).otherwise(rooted)
        return materialize(docs.select("doc", "source_file_name", "raw_record_id", content.alias("raw_json_content")), "documents-c")

    @property
    def json_docs(self) -> DataFrame:
        docs = self.documents_c.drop("doc").withColumn("record_hash", hash_document(F.col("raw_json_content")))
        return stamp(docs, BATCH, AS_OF, "ClientC", "JSON")

    def xml_files(self, condition: str = "true") -> str:
        """Write client-A transactions as XML documents of at most 256 transactions; returns the folder."""
        path = f"{fresh_path(self.spark, 'landing-xml')}/ClientA_Transactions"
        c = F.col
        priced = F.struct(c("unit_price_text").alias("_VALUE"), c("currency_text").alias("_currency"))
        item = F.struct(
            c("sku_text").alias("SKU"), c("description_text").alias("Description"), c("quantity_text").alias("Quantity"),
            priced.alias("UnitPrice"),
        )
        name = F.struct(c("first_name_raw").alias("FirstName"), c("last_name_raw").alias("LastName"))
        customer = F.struct(c("customer_id_raw").alias("CustomerID"), name.alias("Name"), c("email_raw").alias("Email"))
        amount = F.struct(c("payment_amount_raw").alias("_VALUE"), c("payment_currency_raw").alias("_currency"))
        headers = [self._headers(truth.HEADERS_A, truth.ITEM_TEXT, 0, item, near).filter(condition) for near in (True, False)]
        rows = headers[0].unionByName(headers[1]).select(
            c("transaction_id_raw").alias("TransactionID"),
            F.struct(c("order_id_raw").alias("OrderID"), c("order_date_raw").alias("OrderDate"), customer.alias("Customer")).alias("Order"),
            F.struct(c("basket").alias("Item")).alias("Items"),
            F.struct(c("payment_method_raw").alias("Method"), amount.alias("Amount")).alias("Payment"),
        )
        rows.write.option("rowTag", "Transaction").option("rootTag", 'SalesData client="ClientA"').option("maxRecordsPerFile", 256).xml(path)
        return path

    def json_files(self) -> str:
        """Write all client-C transactions as JSON documents, one per file; returns the folder."""
        path = fresh_path(self.spark, "landing-json")
        docs = self.documents_c.select(F.from_json(
            F.when(F.col("doc") % 2 == 0, F.col("raw_json_content")).otherwise(
                F.concat(F.lit('{"transactions":'), "raw_json_content", F.lit("}"))),
            "transactions array<struct<transaction_id:string,txn_id:string,order:struct<order_id:string,order_date:string,status:string,"
            "customer:struct<customer_id:string,id:string,first_name:string,last_name:string,name:string,email:string,loyalty_tier:string,tier:string>>,"
            "payment:struct<method:string,payment_method:string,amount:string,total:string,currency:string>,"
            "items:array<struct<sku:string,product_id:string,description:string,name:string,quantity:string,qty:string,unit_price:string,"
            "price:string,currency:string>>>>",
        ).alias("d"))
        docs.select("d.*").write.option("maxRecordsPerFile", 1).json(path)
        return path

    def document_files(self, docs: DataFrame, content: str, name: str) -> str:
        """Write one file per document (one text row each) and return the folder."""
        path = fresh_path(self.spark, f"landing-{name}")
        docs.select(F.col(content).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
        return path


_SHARED: dict = {}


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SHARED:
        _SHARED[key] = Landing(spark, sf_dir)
    return _SHARED[key]
