"""The trie of conversation prefixes, by ROLLUP over positional columns of turn ids.

A conversation is laid out in rows of eight columns, one turn id each; longer ones
continue in further rows keyed by the node they continue. One

    GROUP BY level, node, ROLLUP (t1, ..., t8)

over all rows counts all prefixes of all conversations at once, and ``grouping_id``
tells their depth. What adds up over subtrees needs no walk: as prefixes grow their
member sets shrink, so every conversation is the smallest member of one run of
nodes that ends with its last turn. It owns these. A node's subtree consists of
what its members own, but of its own smallest member only what lies at its depth or
below; so a second ROLLUP over totals of what is owned gives all subtree sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, Scratch

# turn ids in a row
COLUMNS = 8
# conversation ids hashed as one piece lie in one range of 2 to this power numbers
RANGE_BITS = 13
EMPTY = hashlib.sha256(b"").hexdigest()
_IDS = [f"t{i}" for i in range(1, COLUMNS + 1)]


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of role and text, and the words of the text; null is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.concat(F.substring(digest, 1, 32), F.lit(":"), F.regexp_count(text, F.lit(WORD)).cast("string"))


def _words(turn: Column) -> Column:
    return F.substring_index(turn, ":", -1).cast("bigint")


def _terms(place: Column, turn: Column) -> list[Column]:
    """What a turn adds to the two 64-bit sums that name a prefix."""
    return [F.xxhash64(place.cast("bigint"), turn).cast("decimal(38,0)"), F.xxhash64(turn, F.lit("second"), place.cast("bigint")).cast("decimal(38,0)")]


def _laid_out(turns: DataFrame, members: DataFrame) -> DataFrame:
    """``(conv_id, level, k1, k2, t1..t8)``: rows of eight turns, keyed by the sums over all turns before them."""
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")
    placed = turns.select("conv_id", "id", F.row_number().over(order).cast("bigint").alias("place"))
    one, two = _terms(F.col("place"), F.col("id"))
    before = W.partitionBy("conv_id").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    nothing = F.lit(0).cast("decimal(38,0)")
    summed = placed.withColumn("k1", F.coalesce(F.sum(one).over(before), nothing)).withColumn("k2", F.coalesce(F.sum(two).over(before), nothing))
    level, column = F.floor((F.col("place") - 1) / COLUMNS).cast("bigint"), (F.col("place") - 1) % COLUMNS
    cells = [F.max(F.when(column == i, F.col("id"))).alias(t) for i, t in enumerate(_IDS)]
    opens = [F.max(F.when(column == 0, F.col(k))).alias(k) for k in ("k1", "k2")]
    rows = summed.groupBy("conv_id", level.alias("level")).agg(*opens, *cells)
    silent = members.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    silent = silent.select("conv_id", F.lit(0).cast("bigint"), nothing, nothing, *[F.lit(None).cast("string") for _ in _IDS])
    return rows.union(silent)


def _rolled(rows: DataFrame, figures: str) -> DataFrame:
    """One row per prefix that some conversation has: ``(level, k1, k2, t1..t8, d, ...)``, ``d`` turns beyond its key."""
    sql = f"""
        SELECT * FROM (
            SELECT level, k1, k2, {", ".join(_IDS)}, cast({COLUMNS} - bit_count(grouping_id()) AS bigint) AS d, {figures}
            FROM {{rows}} GROUP BY level, k1, k2, ROLLUP ({", ".join(_IDS)})
        ) WHERE CASE WHEN d = 0 THEN level = 0 ELSE element_at(array({", ".join(_IDS)}), cast(d AS int)) IS NOT NULL END
    """
    return rows.sparkSession.sql(sql, rows=rows)


def _named(rolled: DataFrame, *more: str) -> DataFrame:
    """Prefixes by depth and key, with their parent's key and the words of their last text."""
    at = lambda i: F.col("level") * COLUMNS + i + 1
    terms = [_terms(at(i), F.col(t)) for i, t in enumerate(_IDS)]
    nothing = F.lit(0).cast("decimal(38,0)")

    def key(side: int, upto: Column) -> Column:
        parts = [F.when(i < upto, pair[side]).otherwise(nothing) for i, pair in enumerate(terms)]
        return reduce(lambda a, b: (a + b).cast("decimal(38,0)"), parts, F.col(f"k{side + 1}"))

    last = F.element_at(F.array(*_IDS), F.greatest(F.col("d"), F.lit(1)).cast("int"))
    d = F.col("d")
    return rolled.select(
        (F.col("level") * COLUMNS + d).alias("depth"), key(0, d).alias("a"), key(1, d).alias("b"), key(0, d - 1).alias("pa"), key(1, d - 1).alias("pb"),
        F.when(d > 0, _words(last)).otherwise(0).cast("bigint").alias("words"), *more,
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the id lists of nodes whose pieces follow each other in order; holds one piece at a time."""
    now, state, first = None, None, True
    for batch in batches:
        out = []
        for node, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != now:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state, first = node, hashlib.sha256(), True
            if not first:
                state.update(b",")
            state.update(piece.encode())
            first = False
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["node", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def prefix_trie(turns: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one included.

    ``turns`` has ``conv_id``, ``turn`` and ``id`` (``turn_id``); a conversation's turns are in
    the order of ``turn`` (null first), ties by id; repeated rows are turns each; other
    columns are ignored. ``members`` (``conv_id``, default those of ``turns``) are all
    conversations, also those without a turn. Rows with a null ``conv_id`` belong to no
    conversation and are left out; a null ``id`` is an empty turn. No conversations, no nodes.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` as in the query's contract. Prefixes are
    told apart by two 64-bit sums over hashes of place and 128-bit turn id.

    Every aggregate is reduced before its shuffle, so copies of one conversation and
    a first turn that many share cost one row per task. The list of ids that end at
    a node is one SHA-256, sequential by definition: pieces of at most 8,192 ids pass
    through one task in order, which holds one piece.
    """
    scratch = Scratch(turns.sparkSession, "prefix-trie")
    blank = turn_id(F.lit(""), F.lit(""))
    turns = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("id", blank).alias("id"))
    members = turns if members is None else members.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"))
    rows = scratch.save(_laid_out(turns, members.select("conv_id").distinct()), "rows")
    nodes = scratch.save(_named(_rolled(rows, "count(*) AS n, min(conv_id) AS m"), "n", "m"), "nodes")

    # where conversations end: the last row's key and turns name the node
    length = F.col("level") * COLUMNS + reduce(lambda a, b: a + b, [F.col(t).isNotNull().cast("bigint") for t in _IDS])
    end = F.max(F.struct(length.alias("depth"), "level", "k1", "k2", *_IDS)).alias("e")
    ends = rows.groupBy("conv_id").agg(end).select("conv_id", "e.*").withColumn("d", F.col("depth") - F.col("level") * COLUMNS)
    ends = _named(ends, "conv_id").select("conv_id", "depth", "a", "b")
    piece = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    ends = ends.groupBy("depth", "a", "b", F.shiftright("conv_id", RANGE_BITS).alias("no"))
    ends = scratch.save(ends.agg(piece.alias("piece"), F.count(F.lit(1)).alias("n_ends")), "ends")
    listed = ends.select(F.concat_ws("/", "depth", "a", "b").alias("node"), "no", "piece").repartition("node").sortWithinPartitions("node", "no")
    digests = listed.select("node", "piece").mapInArrow(_digests, "node string, ends_sha256 string")
    named = F.split("node", "/")
    digests = digests.select(named[0].cast("bigint").alias("depth"), named[1].cast("decimal(38,0)").alias("a"), named[2].cast("decimal(38,0)").alias("b"), "ends_sha256")
    digests = digests.join(ends.groupBy("depth", "a", "b").agg(F.sum("n_ends").alias("n_ends")), ["depth", "a", "b"])
    known = nodes.join(digests, ["depth", "a", "b"], "left").withColumn("leaf", (F.col("n") == F.coalesce("n_ends", F.lit(0))).cast("bigint"))
    own = ((F.col("n") - 1) * F.col("words")).alias("own")
    known = scratch.save(known.select("depth", "a", "b", "pa", "pb", "n", "m", own, "leaf", "ends_sha256"), "known")

    # what each conversation owns, summed over subtrees by the same prefixes
    owned = known.groupBy(F.col("m").alias("conv_id")).agg(F.sum("own").alias("own"), F.sum("leaf").alias("leaf"))
    totals = rows.join(owned, "conv_id", "left")
    totals = _rolled(totals, "sum(own) AS own_sum, sum(leaf) AS leaf_sum, min(conv_id) AS m").select("m", (F.col("level") * COLUMNS + F.col("d")).alias("depth"), "own_sum", "leaf_sum")
    # an owner's first node hangs below a node of another; all others below one of its own
    path = W.partitionBy("m").orderBy("depth")
    known = known.withColumn("top", F.row_number().over(path) == 1)
    known = known.withColumn("above", F.coalesce(F.sum("own").over(path.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    known = known.withColumn("goes_on", F.lead("depth").over(path).isNotNull().cast("bigint"))
    tops = known.filter("top AND depth > 0").select("m", F.col("depth").alias("top_depth"), F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth"))
    hung = tops.join(nodes.select("depth", "a", "b", F.col("m").alias("parent")), ["depth", "a", "b"])
    hung = scratch.save(hung.select("m", "top_depth", "depth", "parent"), "hung")
    children = hung.groupBy(F.col("parent").alias("m"), "depth").agg(F.count(F.lit(1)).alias("branches"))
    found = known.join(totals, ["m", "depth"]).join(children, ["m", "depth"], "left")
    found = found.join(hung.select("m", F.col("top_depth").alias("depth"), "parent"), ["m", "depth"], "left")
    return found.select(
        F.col("m").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "m")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("goes_on") + F.coalesce("branches", F.lit(0))).alias("n_children"), F.col("leaf_sum").alias("n_leaves"),
        (F.coalesce("own_sum", F.lit(0)) - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
