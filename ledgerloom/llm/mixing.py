"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a token budget. Whole epochs are taken first; the rest of the
budget is a sample without replacement: every document draws an exponential key
``-ln(u) / weight`` with ``u`` from a hash of the document and ``weight`` its
quality, and the documents of smallest key are taken until their sizes, summed
in key order, reach the budget. The random numbers are hashes, so reruns agree.

The sums in key order are taken in two levels: keys are cut into buckets of like
numbers of documents, sums of buckets are added up first, and documents are
summed inside their bucket only. A source with a third of all documents has a
third of all buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, Scratch, small

# documents of one bucket, on average
BUCKET_ROWS = 5000
# the sources, in order, take these weights in turn
WEIGHTS = (3, 1, 2)
# the mix is this share of all words, and no source is repeated more often than this
SHARE, REPEATS = 1.5, 2.0


def quality_weight(text: str = "text") -> Column:
    """A document's sampling weight from its text: the share of letters and spaces in it, at least 0.05."""
    plain = F.length(F.regexp_replace(text, r"[!-/:-@\[-`{-~0-9]", "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(plain, F.lit(0.0)), F.lit(0.05))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """``sizes`` (``source``, ``source_size`` and more, one row per source) with its ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` of all words. No target exceeds ``repeats`` times its source; what
    exceeds it is shared again among the others by weight. That has a closed
    form: sources are full up to a level of size per weight, and the first level
    at which the rest of the budget fits the rest of the sources is the answer.
    """
    order = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * repeats
    ranked = sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("level", F.col("cap") / F.col("weight"))
    by_level = W.orderBy("level", F.asc_nulls_last("source"))
    full = F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1))
    light = F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing))
    all_ = F.sum("source_size").over(W.partitionBy())
    ranked = ranked.withColumn("reach", (all_ * share - F.coalesce(full, F.lit(0.0))) / light)
    # the level of the sources that are not full; above all levels if every source is
    level = F.max(F.when(F.col("reach") <= F.col("level"), F.col("reach"))).over(W.partitionBy())
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return ranked.select(*sizes.columns, F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def mix(docs: DataFrame, size: Column, weight: Column, id_column: str = "doc_id", source_column: str = "source", seed: int = 1,
        weights: tuple = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """``(id, source, size, source_size, target, copies, taken)`` for every row of ``docs``.

    ``copies`` is how often the mix holds the document, ``taken`` its words times
    copies. The last document of a source's fractional part is taken if that
    brings the source nearer to its target. Documents of equal key are ordered by
    id, and rows equal in id, size and key share one place in the order.

    A null source is a source of its own, the last one. Documents without words
    (null or empty texts) have size 0 and no copies; a null or non-positive weight
    counts as 0.05. A null id draws by the other columns given. An empty table
    gives no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    w = F.when(weight > 0, weight).otherwise(0.05)
    rows = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), w.alias("weight"))
    drawn = F.xxhash64(F.lit(seed), "id", "source", "size", "weight")
    unit = (F.shiftrightunsigned(drawn, 11).cast("double") + 0.5) / float(1 << 53)
    rows = scratch.save(rows.select("*", (-F.log(unit) / F.col("weight")).alias("key")), "rows")
    per_source = scratch.save(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"), F.avg("weight").alias("mean")), "sources"
    )
    targets = source_targets(per_source, weights, share, repeats).withColumnRenamed("source", "source_")
    targets, seen = scratch.save_counted(
        targets.withColumn("epochs", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).cast("int"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("buckets", F.ceil(F.col("rows") / BUCKET_ROWS)), "targets"
    )
    placed = rows.join(small(targets, seen["n"], 256), F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    # an exponential key of mean weight falls evenly into these buckets
    bucket = F.floor((1 - F.exp(-F.col("key") * F.col("mean"))) * F.col("buckets")).cast("bigint")
    placed = placed.withColumn("bucket", F.least(bucket, F.col("buckets") - 1))
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = F.sum("words").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    sums, n = scratch.save_counted(sums.select(F.col("source").alias("s_"), F.col("bucket").alias("b_"), F.coalesce(earlier, F.lit(0)).alias("earlier")), "sums")
    inside = W.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(W.unboundedPreceding, -1)
    joined = placed.join(small(sums, n["n"], 64), F.col("source").eqNullSafe(F.col("s_")) & (F.col("bucket") == F.col("b_")))
    before = F.col("earlier") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    chosen = joined.withColumn("before", before).withColumn(
        # nearer to the target with the document than without it
        "copies", F.when(F.col("size") > 0, F.col("epochs") + (2 * F.col("before") + F.col("size") <= 2 * F.col("rest")).cast("int")).otherwise(0)
    )
    return chosen.select(
        F.col("id").alias(id_column), F.col("source").alias(source_column), "size", F.col("source_size").cast("bigint").alias("source_size"), "target",
        "copies", (F.col("size") * F.col("copies")).alias("taken"),
    )
