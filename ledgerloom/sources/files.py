"""File listing, pattern routing, load ledger, per-file row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import materialize


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, modification_time) per file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modification_time"))
    )


def matches_pattern(path: Column, pattern: str) -> Column:
    """The pattern must cover the whole path."""
    return path.rlike(f"^(?:{pattern})\\z")


def select_files_by_pattern(files: DataFrame, pattern: str, path_column: str = "path") -> DataFrame:
    return files.filter(matches_pattern(F.col(path_column), pattern))


LEDGER_KEY = ["path", "length", "modification_time"]


def skip_loaded_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose path, size and modification time are not in the ledger yet."""
    return files.join(ledger.select(*LEDGER_KEY), LEDGER_KEY, "left_anti")


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Add file name, path, size and split start next to the data columns."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file_name"),
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_block_start").alias("_block_start"),
    )


def stamp(df: DataFrame, batch_id: str, as_of: str, client: str | None = None, fmt: str | None = None) -> DataFrame:
    """One batch id and one ingestion time for the whole run."""
    out = df.withColumn("batch_id", F.lit(batch_id)).withColumn("ingestion_timestamp", F.lit(as_of).cast("timestamp"))
    if client is not None:
        out = out.withColumn("source_client", F.lit(client))
    if fmt is not None:
        out = out.withColumn("source_format", F.lit(fmt))
    return out


_TASK_SLOTS = 1 << 24  # tasks of one scan; a scan with more fails instead of giving one id twice
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a task in its lower 33 bits


_SERIES = 16  # raw tables that number their rows side by side


def with_record_ids(df: DataFrame, last_id: int = 0, series: int = 0) -> DataFrame:
    """Unique ids above ``last_id``, with gaps, given without a shuffle or a second read.

    Row r of task t gets the number ``r * slots + t``, so ids stay small even
    though the number of rows per task is not known beforehand. Tables with
    different ``series`` never share an id. A scan of more tasks than there are
    slots is refused.
    """
    numbered = df.withColumn("_scan_id", F.monotonically_increasing_id())
    row = F.col("_scan_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    task = F.shiftright("_scan_id", _ROW_BITS)
    slot = F.when(task < _TASK_SLOTS, task).otherwise(F.raise_error(F.lit("more scan tasks than record ids have room for")).cast("bigint"))
    number = row * _TASK_SLOTS + slot + F.lit(last_id // _SERIES + 1)
    return numbered.withColumn("raw_record_id", number * _SERIES + series).drop("_scan_id")


def number_file_rows(df: DataFrame) -> DataFrame:
    """``file_row_number``: the 1-based position of a row in its file.

    The input is scanned once: the rows are written with the scan id of their
    split, and both the counts per split and the numbers come from that one
    table. (A second scan may be cut into other splits, for instance when
    executors come and go between two jobs, and would not match the first.) Scan
    ids grow by one from row to row inside a split, so a position is the number of
    rows in earlier splits of the file plus the distance to the split's first id.
    The rows are neither shuffled nor sorted, whatever the size of the largest
    file; one line per split is aggregated.
    """
    rows = materialize(df.withColumn("_scan_id", F.monotonically_increasing_id()), "numbered")
    splits = rows.groupBy("source_file_path", "_block_start").agg(
        F.min("_scan_id").alias("_first_id"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = W.partitionBy("source_file_path").orderBy("_block_start").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    # a written table has a known size, from which the optimizer chooses a broadcast or a shuffled join
    known = materialize(splits, "splits")
    return (
        rows.join(known, ["source_file_path", "_block_start"])
        .withColumn("file_row_number", F.col("_scan_id") - F.col("_first_id") + F.col("_offset") + 1)
        .drop("_first_id", "_offset", "_scan_id")
    )


def capture_file_metadata(df: DataFrame) -> DataFrame:
    """Rows of a file source with file name, path, size and file row number."""
    return number_file_rows(with_file_metadata(df)).drop("_block_start")
