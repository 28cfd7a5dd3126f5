"""Scratch tables, guarded broadcasts and connected components shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..session import fresh_path

# a side is broadcast only when its measured size stays below this many bytes
BROADCAST_BYTES = 16 << 20

# one word: a run of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """Tables of one query below the shared work folder.

    Each table is written once and read by later steps, so a lost executor costs
    no recomputation. ``drop`` deletes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_path(spark, label)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        return self.save_counted(df, name)[0]

    def save_counted(self, df: DataFrame, name: str, **more: Column) -> tuple[DataFrame, dict]:
        """The table read back, and its figures (``n`` rows and ``more``) counted while it was written."""
        seen = Observation()
        figures = [F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in more.items()]]
        df.observe(seen, *figures).write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}"), dict(seen.get)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` rows of ``row_bytes`` bytes are within the bound, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def fresh_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    low = {t.lower() for t in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def connected_components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``u``, ``v``); root is the smallest node of its component.

    Alternating large-star and small-star steps: every step hangs nodes below a
    smaller neighbour, and after a number of steps that grows with the logarithm
    of the longest path each component is a star around its smallest node. Only
    links take part; each step is two joins and a distinct.
    """
    # links point from the larger to the smaller node; loops link nothing
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    mark = {"mark": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    now, seen = scratch.save_counted(now, f"{label}-0", **mark)
    step = 0
    while seen["n"]:
        step += 1
        # one exchange serves the smallest neighbour and the join with it
        both = now.union(now.select("v", "u")).toDF("u", "v").repartition("u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).repartition("u")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        step_edges = down.union(least.select("u", F.col("m").alias("v"))).distinct()
        before = seen
        # few links need few files
        now, seen = scratch.save_counted(step_edges.coalesce(max(8, seen["n"] // 100_000)), f"{label}-{step}", **mark)
        scratch.drop(f"{label}-{step - 1}")
        if seen == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
