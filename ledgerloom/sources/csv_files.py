"""CSV master data: all-string landing rows, loaded by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import sha256_of
from . import formats as f
from .csv_records import read_lines, split_records, values_of
from .files import matches_pattern, stamp, with_record_ids


def hash_columns(df: DataFrame, entity: f.CsvEntity, columns: tuple | None = None) -> DataFrame:
    parts = [F.col(f"{c}_raw") for c in (columns or entity.hashed)]
    return df.withColumn("record_hash", sha256_of(*parts))


def hash_customers(df: DataFrame, columns: tuple | None = None) -> DataFrame:
    return hash_columns(df, f.CUSTOMERS, columns)


def hash_orders(df: DataFrame, columns: tuple | None = None) -> DataFrame:
    return hash_columns(df, f.ORDERS, columns)


def hash_products(df: DataFrame, columns: tuple | None = None) -> DataFrame:
    return hash_columns(df, f.PRODUCTS, columns)


def hash_payments(df: DataFrame, columns: tuple | None = None) -> DataFrame:
    return hash_columns(df, f.PAYMENTS, columns)


def csv_rows(lines: DataFrame, entity: f.CsvEntity, fmt: f.CsvFormat, start_id: int = 0, series: int = 0) -> DataFrame:
    """Landing rows, without hash and stamp, from text lines with file metadata.

    ``_corrupt_record`` holds the record where it has more values than the layout,
    or cannot be read; then all values are NULL. Records of fewer values end in NULLs.
    """
    records = split_records(lines, fmt.sep, fmt.header, lambda df: with_record_ids(df, start_id, series))
    names = entity.raw_columns + entity.spare_columns
    values = F.when(~F.col("unreadable"), values_of(F.col("value"), fmt.sep))
    rows = records.withColumn("_values", values).select(
        *[F.get("_values", F.lit(i)).alias(n) for i, n in enumerate(names)],
        F.when(F.col("unreadable") | (F.size("_values") > len(names)), F.col("value")).alias(f.CORRUPT),
        *[c for c in records.columns if c not in ("value", "unreadable")],
    )
    return f.apply_null_tokens(rows, names, fmt.null_tokens)


def read_csv(
    spark: SparkSession,
    path,
    entity: f.CsvEntity,
    batch_id: str,
    as_of: str,
    *,
    fmt: f.CsvFormat = f.CSV_STANDARD,
    pattern: str | None = None,
    start_id: int = 0,
) -> DataFrame:
    """Landing rows of one entity; ``csv_overflow`` finds those that did not fit or could not be read."""
    lines = read_lines(spark, path)
    if pattern:
        lines = lines.filter(matches_pattern(F.col("source_file_path"), pattern))
    return stamp(hash_columns(csv_rows(lines, entity, fmt, start_id), entity), batch_id, as_of)


def read_csv_customers(spark, path, batch_id, as_of, **kw) -> DataFrame:
    return read_csv(spark, path, f.CUSTOMERS, batch_id, as_of, **kw)


def read_csv_orders(spark, path, batch_id, as_of, **kw) -> DataFrame:
    return read_csv(spark, path, f.ORDERS, batch_id, as_of, **kw)


def read_csv_products(spark, path, batch_id, as_of, **kw) -> DataFrame:
    return read_csv(spark, path, f.PRODUCTS, batch_id, as_of, **kw)


def read_csv_payments(spark, path, batch_id, as_of, **kw) -> DataFrame:
    return read_csv(spark, path, f.PAYMENTS, batch_id, as_of, **kw)


def csv_overflow(rows: DataFrame) -> DataFrame:
    """Records with more values than the layout has columns, and records that cannot be read."""
    return rows.filter(F.col(f.CORRUPT).isNotNull())
