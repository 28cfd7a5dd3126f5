"""Queries over the file formats: awkward values, other separators, compression, bad bytes and broken records in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators import staging_json, staging_xml
from ledgerloom.session import fresh_path
from ledgerloom.sources import csv_files, documents, formats

from .queries import c, pick, query
from .truth import AS_OF, BATCH

# rows of a file
FILE_ROWS = 4000


def text_files(w, df: DataFrame, key: str, line: Column, name: str, header: str | None, end: Column | None = None, codec: str = "none") -> str:
    """Files of up to ``FILE_ROWS`` consecutive keys, their lines in the order of the key; returns the folder."""
    path = fresh_path(w.spark, f"landing-{name}")
    files = df.select(F.floor(c(key) / FILE_ROWS).alias("file"), F.struct(c(key).alias("k"), line.alias("line")).alias("x")).groupBy("file").agg(F.sort_array(F.collect_list("x")).alias("x"))
    body = F.array_join(F.transform("x", lambda x: x["line"]), "\n")
    parts = [F.lit(f"{header}\n")] * (header is not None) + [body] + ([end] if end is not None else [])
    files.select(F.concat(*parts).alias("value")).write.option("maxRecordsPerFile", 1).option("compression", codec).text(path)
    return path


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))


def _customer() -> tuple[Column, Column, Column]:
    return c("c_custkey").cast("string"), c("c_name"), c("c_mktsegment")


def _messy(sep: str) -> Column:
    """Line feeds, separators, quotes and backslashes in every way a value can hold them."""
    s, (key, name, segment) = F.lit(sep), _customer()
    broken = F.replace(name, F.lit("#"), F.lit('\n#"' + sep))
    escaped = F.concat(segment, F.lit("\\" + sep), key, F.lit("\\\nend"))
    token = F.element_at(F.array(*[F.lit(t) for t in ("N/A", "x", "null", "-", "NULL")]), (c("c_custkey") % 5 + 1).cast("int"))
    stray = F.concat(F.lit('5" '), segment)
    return F.concat(key, s, quoted(broken), s, escaped, s, token, s, stray, s, F.lit("  web\t"), s, F.lit(' "true" '))


def _messy_sql(sep: str, tokens: list[str]) -> str:
    null = ", ".join(f"'{t}'" for t in tokens)
    token = "CASE c_custkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN 'x' WHEN 2 THEN 'null' WHEN 3 THEN '-' ELSE 'NULL' END"
    return f"""SELECT c_custkey::VARCHAR AS customer_id_raw, replace(c_name, '#', chr(10) || '#"{sep}') AS first_name_raw,
        c_mktsegment || '{sep}' || c_custkey || chr(10) || 'end' AS last_name_raw, CASE WHEN {token} NOT IN ({null}) THEN {token} END AS email_raw,
        '5" ' || c_mktsegment AS loyalty_tier_raw, 'web' AS signup_source_raw, 'true' AS is_active_raw, c_custkey % {FILE_ROWS} + 1 AS file_row_number FROM customer"""


def _read_messy(w, fmt: formats.CsvFormat, name: str) -> DataFrame:
    path = text_files(w, w.inputs.table("customer"), "c_custkey", _messy(fmt.sep), name, "h" if fmt.header else None)
    rows = csv_files.read_csv(w.spark, path, formats.CUSTOMERS, BATCH, AS_OF, fmt=fmt)
    return rows.select(*formats.CUSTOMERS.raw_columns, "file_row_number")


@query("csv_standard", _messy_sql(",", formats.CSV_NULL_TOKENS))
def csv_standard(w):
    return _read_messy(w, formats.CSV_STANDARD, "csv-standard")


@query("csv_no_header", _messy_sql(",", formats.SHORT_NULL_TOKENS))
def csv_no_header(w):
    return _read_messy(w, formats.CSV_NO_HEADER, "csv-no-header")


@query("csv_pipe", _messy_sql("|", formats.SHORT_NULL_TOKENS))
def csv_pipe(w):
    return _read_messy(w, formats.CSV_PIPE, "csv-pipe")


_SPLITS = ("20000", "300000", "134217728")


@query("csv_splits", " UNION ALL ".join(f"SELECT '{n}' AS split_bytes, first_name_raw, file_row_number FROM ({_messy_sql(',', formats.CSV_NULL_TOKENS)})" for n in _SPLITS))
def csv_splits(w):
    """The same files read in splits of three sizes."""
    path = text_files(w, w.inputs.table("customer"), "c_custkey", _messy(","), "csv-splits", "h")
    name, found = "spark.sql.files.maxPartitionBytes", None
    before = w.spark.conf.get(name)
    try:
        for size in _SPLITS:
            w.spark.conf.set(name, size)
            rows = csv_files.read_csv_customers(w.spark, path, BATCH, AS_OF).select(F.lit(size).alias("split_bytes"), "first_name_raw", "file_row_number")
            found = rows if found is None else found.unionByName(rows)
    finally:
        w.spark.conf.set(name, before)
    return found


@query("compressed_files", "SELECT c_custkey::VARCHAR AS customer_id_raw, c_name AS first_name_raw, c_custkey % 4000 + 1 AS file_row_number FROM customer")
def compressed_files(w):
    path = text_files(w, w.inputs.table("customer"), "c_custkey", F.concat_ws(",", *_customer()[:2]), "csv-gz", "h", codec="gzip")
    return csv_files.read_csv_customers(w.spark, path, BATCH, AS_OF).select("customer_id_raw", "first_name_raw", "file_row_number")


@query("bad_utf8", "SELECT c_custkey::VARCHAR AS customer_id_raw, c_name || chr(65533) || 'é' AS first_name_raw FROM customer")
def bad_utf8(w):
    """Bytes that are no UTF-8 become replacement characters; the row is loaded."""
    bad = F.concat(F.concat_ws(",", *_customer()[:2]).cast("binary"), F.unhex(F.lit("FF")), F.lit("é").cast("binary")).cast("string")
    path = text_files(w, w.inputs.table("customer"), "c_custkey", bad, "csv-bad-utf8", "h")
    return csv_files.read_csv_customers(w.spark, path, BATCH, AS_OF).select("customer_id_raw", "first_name_raw")


_LONG = ",".join(str(i) for i in range(12))


@query("continue_on_error", f"""SELECT CASE WHEN c_custkey % 7 = 3 THEN c_custkey || ',{_LONG}' END AS reject, c_custkey::VARCHAR AS customer_id_raw FROM customer
    UNION ALL SELECT unnest(['"never closed,' || file, 'lost ' || file]), NULL FROM (SELECT DISTINCT c_custkey // {FILE_ROWS} AS file FROM customer)""")
def continue_on_error(w):
    """Records that are too long, and an end of file inside quotes: the others are loaded, every bad line is kept."""
    key, name, _ = _customer()
    line = F.when(c("c_custkey") % 7 == 3, F.concat(key, F.lit(f",{_LONG}"))).otherwise(F.concat_ws(",", key, name))
    file = c("file").cast("string")
    end = F.concat(F.lit('\n"never closed,'), file, F.lit("\nlost "), file)
    path = text_files(w, w.inputs.table("customer"), "c_custkey", line, "csv-errors", "h", end)
    rows = csv_files.read_csv_customers(w.spark, path, BATCH, AS_OF)
    loaded = rows.filter(c(formats.CORRUPT).isNull()).select(F.lit(None).cast("string").alias("reject"), "customer_id_raw")
    return loaded.unionByName(csv_files.csv_overflow(rows).select(c(formats.CORRUPT).alias("reject"), "customer_id_raw"))


@query("json_null_tokens", """SELECT CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'TX' || c_custkey END AS transaction_id_raw,
    CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE c_mktsegment END AS order_id_raw, c_custkey::VARCHAR AS customer_id_raw FROM customer""")
def json_null_tokens(w):
    """Tokens that stand for NULL in JSON feeds, as a list that a reader is given."""
    token = F.element_at(F.array(*[F.lit(t) for t in formats.JSON_NULL_TOKENS]), (c("c_custkey") % len(formats.JSON_NULL_TOKENS) + 1).cast("int"))
    key, _, segment = _customer()
    row = F.to_json(F.struct(
        F.when(c("c_custkey") % 3 == 0, token).otherwise(F.concat(F.lit("TX"), key)).alias("transaction_id"),
        F.struct(F.when(c("c_custkey") % 4 == 1, token).otherwise(segment).alias("order_id"), F.struct(key.alias("customer_id")).alias("customer")).alias("order"),
    ))
    path = text_files(w, w.inputs.table("customer"), "c_custkey", row, "json-tokens", None)
    docs = documents.read_json_documents(w.spark, path, BATCH, AS_OF, lines=True, pattern=None)
    docs = docs.withColumn("raw_json_content", F.concat(F.lit("["), "raw_json_content", F.lit("]")))
    found = staging_json.extract_json_fields(staging_json.flatten_json_transactions(docs), formats.JSON_NULL_TOKENS)
    return found.select("transaction_id_raw", "order_id_raw", "customer_id_raw")


# ---- documents split among tasks ---------------------------------------------


@query("split_xml_documents", "SELECT transaction_id_raw, order_id_raw, customer_id_raw, (SELECT count(*) FROM raw_lines l WHERE l.o = landed_a.o) AS item_count FROM landed_a")
def split_xml_documents(w):
    records, _ = documents.split_xml_documents(w.spark, w.inputs.xml_files(), BATCH, AS_OF)
    flat = staging_xml.extract_xml_fields(staging_xml.parse_xml_records(records))
    return pick(flat.withColumn("item_count", F.coalesce(F.size("items"), F.lit(0))), "transaction_id_raw, order_id_raw, customer_id_raw, item_count")


@query("split_txt_documents", "SELECT transaction_id_raw, order_id_raw, transaction_index FROM landed_a WHERE is_txt = 1 AND is_broken = 0")
def split_txt_documents(w):
    path = w.inputs.document_files(w.inputs.txt_docs, "raw_text_content", "txt")
    records, _ = documents.split_xml_documents(w.spark, path, BATCH, AS_OF, pattern=formats.TXT_PATTERN, fragments=True)
    return pick(staging_xml.extract_xml_fields(staging_xml.parse_xml_records(records)), "transaction_id_raw, order_id_raw, transaction_index")


@query("split_txt_verdicts", "SELECT is_broken = 0 AS well_formed, count(*) AS documents FROM (SELECT DISTINCT source_file_name, is_broken FROM landed_a WHERE is_txt = 1) GROUP BY 1")
def split_txt_verdicts(w):
    path = w.inputs.document_files(w.inputs.txt_docs, "raw_text_content", "txt")
    _, docs = documents.split_xml_documents(w.spark, path, BATCH, AS_OF, pattern=formats.TXT_PATTERN, fragments=True)
    return docs.groupBy("well_formed").agg(F.count(F.lit(1)).alias("documents"))


_JSON_FIELDS = "transaction_id_raw, transaction_id_alt_raw, order_id_raw, customer_id_alt_raw, transaction_index"


@query("split_json_documents", f"SELECT {_JSON_FIELDS} FROM raw_headers_c")
def split_json_documents(w):
    rows, _ = documents.split_json_documents(w.spark, w.inputs.json_files(), BATCH, AS_OF)
    return pick(staging_json.extract_json_fields(rows), _JSON_FIELDS)

