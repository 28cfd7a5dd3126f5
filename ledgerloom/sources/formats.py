"""Reader options per file format, and the entity layouts of the CSV files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Tokens that stand for NULL, per format.
CSV_NULL_TOKENS = ["", "NULL", "null", "N/A", "n/a", "-", "NA", "na", "#N/A"]
SHORT_NULL_TOKENS = ["", "NULL", "null"]
JSON_NULL_TOKENS = ["", "NULL", "null", "None", "none", "NONE"]

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class CsvFormat:
    """Values end at ``sep`` and may be enclosed in double quotes; ``\\`` takes the next character of an unenclosed value as it is."""

    sep: str
    header: bool
    null_tokens: list


CSV_STANDARD = CsvFormat(",", True, CSV_NULL_TOKENS)
CSV_NO_HEADER = CsvFormat(",", False, SHORT_NULL_TOKENS)
CSV_PIPE = CsvFormat("|", True, SHORT_NULL_TOKENS)

# of Spark's own reader, for streams of files without line feeds inside values
CSV_READER_OPTIONS = {
    "sep": ",", "header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
}

XML_OPTIONS = {"ignoreSurroundingSpaces": "true", "attributePrefix": "_", "valueTag": "_VALUE"}


@dataclass(frozen=True)
class CsvEntity:
    """Positional columns of one master-data file, its spare columns, hash subset and file name pattern."""

    target: str
    columns: tuple
    spare: int
    hashed: tuple
    pattern: str

    @property
    def raw_columns(self) -> list[str]:
        return [f"{c}_raw" for c in self.columns]

    @property
    def spare_columns(self) -> list[str]:
        return [f"extra_col_{i + 1}" for i in range(self.spare)]

    def reader_schema(self) -> T.StructType:
        names = self.raw_columns + self.spare_columns + [CORRUPT]
        return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column order, hash subset and file name pattern per entity.
CUSTOMERS = CsvEntity(
    "raw_csv_customers",
    ("customer_id", "first_name", "last_name", "email", "loyalty_tier", "signup_source", "is_active"),
    3,
    ("customer_id", "first_name", "last_name", "email", "loyalty_tier"),
    r".*[Cc]ustomer.*\.[Cc][Ss][Vv]",
)
ORDERS = CsvEntity(
    "raw_csv_orders",
    ("order_id", "customer_id", "order_date", "status", "total_amount", "currency"),
    2,
    ("order_id", "customer_id", "order_date", "total_amount"),
    r".*[Oo]rder[s]?\.[Cc][Ss][Vv]",
)
PRODUCTS = CsvEntity(
    "raw_csv_products",
    ("product_id", "sku", "product_name", "description", "category", "price", "currency"),
    2,
    ("product_id", "sku", "product_name", "price"),
    r".*[Pp]roduct[s]?\.[Cc][Ss][Vv]",
)
PAYMENTS = CsvEntity(
    "raw_csv_payments",
    ("payment_id", "order_id", "transaction_id", "payment_method", "amount", "currency", "payment_date", "status"),
    2,
    ("payment_id", "order_id", "amount", "payment_method"),
    r".*[Pp]ayment[s]?\.[Cc][Ss][Vv]",
)
# File name patterns of the document sources.
XML_PATTERN = r".*[Cc]lient[Aa].*\.xml"
TXT_PATTERN = r".*\.txt"
JSON_PATTERN = r".*\.json"


def null_if_token(c: Column, tokens: list[str]) -> Column:
    return F.when(~c.isin(tokens), c)


def apply_null_tokens(df: DataFrame, columns: list[str], tokens: list[str]) -> DataFrame:
    return df.withColumns({c: null_if_token(F.col(c), tokens) for c in columns})
