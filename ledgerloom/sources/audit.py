"""Batch ids and the ingestion audit log."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F


def new_batch_id(now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return f"BATCH_{now:%Y%m%d_%H%M%S}_{now.microsecond // 1000:03d}"


def write_audit_log(
    raw: DataFrame, target_table: str, pattern: str, started: str, ended: str, rejected: DataFrame | None = None
) -> DataFrame:
    """One audit row per batch, target and file. ``rejected`` holds batch_id and source_file_name per bad row."""
    loaded = raw.groupBy("batch_id", "source_file_name").agg(F.count(F.lit(1)).alias("rows_loaded"))
    if rejected is not None:
        bad = rejected.groupBy("batch_id", "source_file_name").agg(F.count(F.lit(1)).alias("rows_rejected"))
        loaded = loaded.join(bad, ["batch_id", "source_file_name"], "full")
    else:
        loaded = loaded.withColumn("rows_rejected", F.lit(0).cast("bigint"))
    start, end = F.lit(started).cast("timestamp"), F.lit(ended).cast("timestamp")
    rows = loaded.withColumns({
        "rows_loaded": F.coalesce("rows_loaded", F.lit(0)),
        "rows_rejected": F.coalesce("rows_rejected", F.lit(0)),
    })
    status = F.when(F.col("rows_rejected") == 0, "SUCCESS").when(F.col("rows_loaded") == 0, "FAILED").otherwise("PARTIAL")
    return rows.select(
        "batch_id",
        "source_file_name",
        F.lit(pattern).alias("source_file_pattern"),
        F.lit(target_table).alias("target_table"),
        F.lit("RAW").alias("target_schema"),
        start.alias("ingestion_start_time"),
        end.alias("ingestion_end_time"),
        (F.unix_timestamp(end) - F.unix_timestamp(start)).alias("duration_seconds"),
        "rows_loaded",
        "rows_rejected",
        (F.col("rows_loaded") + F.col("rows_rejected")).alias("rows_parsed"),
        status.alias("status"),
        end.alias("created_at"),
    )


def audit_for_batch(audit: DataFrame, batch_id: str) -> DataFrame:
    return audit.filter(F.col("batch_id") == batch_id)
