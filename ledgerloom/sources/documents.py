"""XML, XML-in-text and JSON documents, one document per row whatever its size; or one record per row on request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import formats as f, nested_records
from .files import matches_pattern, number_file_rows, stamp, with_file_metadata, with_record_ids

# which ids each kind of raw row gets
SERIES = {"xml": 0, "txt": 1, "json": 2, "xml_records": 3}


def hash_document(content: Column) -> Column:
    return F.sha2(content, 256)


def _whole_files(spark, path, pattern) -> DataFrame:
    """One row per file. A file of more than 2 GB does not fit in a row and fails the read; none is left out."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    files = with_file_metadata(files).drop("_block_start")
    return files.filter(matches_pattern(F.col("source_file_path"), pattern)) if pattern else files


def read_xml_documents(
    spark: SparkSession, path, batch_id: str, as_of: str, *, client: str = "ClientA",
    pattern: str | None = f.XML_PATTERN, start_id: int = 0,
) -> DataFrame:
    docs = _whole_files(spark, path, pattern).withColumnRenamed("value", "raw_xml_content")
    docs = docs.withColumn("record_hash", hash_document(F.col("raw_xml_content")))
    return stamp(with_record_ids(docs, start_id, SERIES["xml"]), batch_id, as_of, client, "XML")


def read_txt_documents(
    spark: SparkSession, path, batch_id: str, as_of: str, *, client: str = "ClientA",
    pattern: str | None = f.TXT_PATTERN, start_id: int = 0,
) -> DataFrame:
    docs = _whole_files(spark, path, pattern).withColumnRenamed("value", "raw_text_content")
    return stamp(with_record_ids(docs, start_id, SERIES["txt"]), batch_id, as_of, client, "TXT_XML")


def read_json_documents(
    spark: SparkSession, path, batch_id: str, as_of: str, *, client: str = "ClientC",
    pattern: str | None = f.JSON_PATTERN, start_id: int = 0, lines: bool = False,
) -> DataFrame:
    """One row per JSON file, or per line with ``lines`` (splittable, for very large files)."""
    if lines:
        docs = with_file_metadata(spark.read.option("recursiveFileLookup", "true").text(path)).drop("_block_start")
        docs = docs.filter(F.trim("value") != "")
        if pattern:
            docs = docs.filter(matches_pattern(F.col("source_file_path"), pattern))
    else:
        docs = _whole_files(spark, path, pattern)
    docs = docs.withColumnRenamed("value", "raw_json_content")
    docs = docs.withColumn("record_hash", hash_document(F.col("raw_json_content")))
    return stamp(with_record_ids(docs, start_id, SERIES["json"]), batch_id, as_of, client, "JSON")


def read_json_array(docs: DataFrame, column: str = "raw_json_content") -> DataFrame:
    """One row per element of documents whose root is an array."""
    parsed = F.try_variant_get(F.try_parse_json(F.col(column)), "$", "array<variant>")
    keep = [c for c in docs.columns if c != column]
    return docs.select(*keep, F.posexplode(parsed).alias("element_index", "element"))


def read_txt_lines(spark: SparkSession, path) -> DataFrame:
    """One record per line."""
    return with_file_metadata(spark.read.option("recursiveFileLookup", "true").text(path)).drop("_block_start")


# ---- XML inside text ------------------------------------------------------

COMMENT = r"(?s)<!--.*?-->"
PROLOG = r"(?s)<\?xml.*?\?>"
PARSE_CHECK_SCHEMA = f"Transaction array<string>, {f.CORRUPT} string"


def wrap_fragments(text: Column) -> Column:
    """The text without comments, prolog and leading prose, under one root element."""
    body = F.regexp_replace(F.regexp_replace(text, COMMENT, ""), PROLOG, "")
    body = F.regexp_replace(body, r"^[^<]*", "")
    return F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><SalesData client="ClientA">'), body, F.lit("</SalesData>"))


def well_formed(xml: Column) -> Column:
    checked = F.from_xml(xml, PARSE_CHECK_SCHEMA, f.XML_OPTIONS)
    return checked.getField(f.CORRUPT).isNull()


def parse_txt_xml(docs: DataFrame) -> DataFrame:
    """Turn text holding root-less XML into XML documents, with success flag and error text."""
    # the generators keep the text from being wrapped and parsed again for every filter and column
    wrapped = docs.select("*", F.explode(F.array(wrap_fragments(F.col("raw_text_content")))).alias("_wrapped"))
    checked = wrapped.select("*", F.explode(F.array(well_formed(F.col("_wrapped")))).alias("xml_parse_success"))
    return checked.select(
        *docs.columns,
        F.when(F.col("xml_parse_success"), F.col("_wrapped")).alias("raw_xml_content"),
        "xml_parse_success",
        F.when(~F.col("xml_parse_success"), F.lit("Failed to parse XML from text content")).alias("xml_parse_error"),
        hash_document(F.col("raw_text_content")).alias("record_hash"),
        F.col("ingestion_timestamp").alias("updated_at"),
    )


# ---- XML files record by record --------------------------------------------

RECORD_END = "</Transaction>"


def split_xml_records(pieces: DataFrame, batch_id: str, as_of: str, *, client: str = "ClientA", start_id: int = 0) -> DataFrame:
    """Transactions from text pieces that each end where a ``</Transaction>`` was.

    Records are read without the document around them, so this is for feeds
    known to be well-formed and without comments over record ends;
    ``crosses_comment`` marks the piece in which such a comment opens.
    """
    to_open_tag = r"(?s)^.*?(?=<Transaction[\s>])"
    pieces = pieces.withColumn("_text", F.regexp_replace("value", COMMENT, ""))
    pieces = pieces.filter(F.col("_text").rlike(r"<Transaction[\s>]"))
    records = pieces.select(
        F.concat(F.regexp_replace("_text", to_open_tag, ""), F.lit(RECORD_END)).alias("transaction_xml"),
        (F.instr("_text", "<!--") > 0).alias("crosses_comment"),
        "source_file_name", "source_file_path", "file_size_bytes", "_block_start",
    )
    numbered = with_record_ids(number_file_rows(records), start_id, SERIES["xml_records"])
    numbered = numbered.withColumn("transaction_index", (F.col("file_row_number") - 1).cast("int"))
    numbered = numbered.withColumn("file_hash", hash_document(F.col("transaction_xml")))
    from_text = F.lower("source_file_path").endswith(".txt")
    numbered = numbered.withColumn("source_format", F.when(from_text, "XML_FROM_TXT").otherwise("XML"))
    return stamp(numbered.drop("_block_start", "file_row_number"), batch_id, as_of, client)


def read_xml_records(
    spark: SparkSession, path, batch_id: str, as_of: str, *, client: str = "ClientA",
    pattern: str | None = None, start_id: int = 0,
) -> DataFrame:
    """One row per ``<Transaction>``, for feeds delivered as files of any size.

    The closing tag is the record separator, so a file is split among tasks
    like any text file and no task sees a whole document. The choice is the
    caller's, never one of file size.
    """
    pieces = spark.read.option("recursiveFileLookup", "true").text(path, lineSep=RECORD_END)
    pieces = with_file_metadata(pieces)
    if pattern:
        pieces = pieces.filter(matches_pattern(F.col("source_file_path"), pattern))
    return split_xml_records(pieces, batch_id, as_of, client=client, start_id=start_id)


# ---- documents of any size, split among tasks -------------------------------


def _split_lines(spark: SparkSession, path, sep: str, pattern: str | None) -> DataFrame:
    lines = with_file_metadata(spark.read.option("recursiveFileLookup", "true").text(path, lineSep=sep))
    return lines.filter(matches_pattern(F.col("source_file_path"), pattern)) if pattern else lines


def _with_documents(elements: DataFrame, documents: DataFrame, batch_id: str, as_of: str, client: str, fmt: str, start_id: int, series: int):
    documents = stamp(with_record_ids(documents, start_id, series), batch_id, as_of, client, fmt)
    return elements.join(documents.drop("well_formed"), "source_file_path"), documents


def split_xml_documents(
    spark: SparkSession, path, batch_id: str, as_of: str, *, client: str = "ClientA",
    pattern: str | None = f.XML_PATTERN, start_id: int = 0, fragments: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(transactions, documents)``: what ``read_xml_documents`` and flattening give, for documents of any size.

    One row per ``<Transaction>`` below the root of a well-formed document (``transaction_xml``, ``transaction_index``), and
    one per document with the verdict ``well_formed``. With ``fragments``, the files are texts that hold root-less XML.
    A document is split among tasks; comments, CDATA sections and nesting may go over any number of splits.
    """
    check = lambda text, schema: F.from_xml(text, schema, f.XML_OPTIONS)
    lines = _split_lines(spark, path, RECORD_END, pattern)
    elements, documents = nested_records.xml_elements(lines, fragments, wrap_fragments, check)
    elements = elements.withColumnsRenamed({"text": "transaction_xml", "element_index": "transaction_index"})
    fmt, series = ("XML_FROM_TXT", SERIES["txt"]) if fragments else ("XML", SERIES["xml"])
    rows, documents = _with_documents(elements, documents, batch_id, as_of, client, fmt, start_id, series)
    rows = rows.withColumn("file_hash", hash_document(F.col("transaction_xml"))).withColumn("crosses_comment", F.lit(False))
    return rows, documents


def split_json_documents(
    spark: SparkSession, path, batch_id: str, as_of: str, *, client: str = "ClientC",
    pattern: str | None = f.JSON_PATTERN, start_id: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """``(elements, documents)``: the transactions of JSON documents of any size as variants, and each document's verdict.

    The list is the root, or its member ``transactions``, as in the whole read; a document is split among tasks.
    """
    elements, documents = nested_records.json_elements(_split_lines(spark, path, "}", pattern))
    rows, documents = _with_documents(elements, documents, batch_id, as_of, client, "JSON", start_id, SERIES["json"])
    rows = rows.withColumns({"file_hash": hash_document(F.col("text")), "transaction": F.parse_json("text")})
    return rows.withColumnRenamed("element_index", "transaction_index").drop("text"), documents
