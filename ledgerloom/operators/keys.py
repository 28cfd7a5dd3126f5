"""Surrogate keys and first-occurrence selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window as W, functions as F

from ..session import fresh_path

# rows of a file in which keys are counted
ROWS_PER_FILE = 250_000


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row per key.

    A rank filter of one lets every map task keep at most one row per key
    before the shuffle, so a key with a huge number of copies is no hot spot.
    """
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def max_key(table: DataFrame, column: str) -> int:
    """The largest key handed out so far, 0 for none."""
    return max(table.agg(F.max(column)).first()[0] or 0, 0)


def assign_surrogate_keys(df: DataFrame, name: str, key: list[str], start: int = 0, at_most: int | None = None) -> DataFrame:
    """Dense ids ``start+1 … start+n`` in the order of the key's MD5 digest.

    The number of rows, not a setting, gives the number of partitions: ``at_most``, where
    the caller knows a bound from tables at rest; else the rows are written and counted
    first. Digests spread evenly, so the leading digits place each row in one of n ordered
    partitions of like size, without sampling. The partitions are sorted and written, one
    file each; an id is then the number of rows in earlier files plus the row's position in
    its own. This takes one shuffle, which the digest itself does not go through, and
    computes ``df`` once. The result is at rest; its ids depend on the keys only, and stay the same
    when a task is repeated or the result is read again.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if at_most is None:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/rows")
        at_most, df = seen.get.get("n", 0), spark.read.schema(df.schema).parquet(f"{path}/rows")
    partitions, path = max(1, -(-at_most // ROWS_PER_FILE)), f"{path}/sorted"
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))
    # the first 32 bits of the digest, scaled to the number of partitions
    slot = F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") * partitions, 32).cast("int")
    placed = df.withColumn("_slot", slot).repartitionById(partitions, F.col("_slot"))
    placed = placed.withColumn("_digest", digest).sortWithinPartitions("_digest", *key).drop("_digest")
    placed.write.option("maxRecordsPerFile", 0).parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    before = W.orderBy("_first").rowsBetween(W.unboundedPreceding, -1)
    per_file = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first"))
    offsets = per_file.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    # at most one line per partition
    numbered = rows.join(F.broadcast(offsets), "_file")
    return numbered.withColumn(name, F.col("_offset") + F.col("_row") + F.lit(start + 1)).drop(
        "_slot", "_file", "_row", "_offset"
    )


# ---- schema checks --------------------------------------------------------


def check_unique(table: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row, with their count."""
    counts = table.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter("row_count > 1")


def check_referential(table: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent, or refers to the unknown member.

    Rows of the unknown member are many and known beforehand, so they take no part in the join.
    """
    key = F.col(foreign_key)
    unknown = table.filter(key.isNull() | (key == -1))
    parents = parent.select(F.col(parent_key).alias(foreign_key))
    dangling = table.filter(key != -1).join(parents, foreign_key, "left_anti")
    return unknown.unionByName(dangling.select(*table.columns))
