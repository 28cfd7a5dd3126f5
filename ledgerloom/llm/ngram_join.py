"""Near-duplicate documents by Jaccard similarity of word n-grams, with adaptive multi-match prefixes.

Two sets of similarity t share all but ``slack = n - ceil(t * n)`` tokens of
either side. Under one global token order, the first ``slack + l`` tokens of
both sides therefore share at least ``l`` tokens. Each document picks its own
``l``: a longer prefix costs more postings but must be shared ``l`` times before
a pair is verified, and the ``l`` of least estimated cost is taken. A pair is a
candidate when it shares the smaller of both ``l``.

The token order puts tokens of few documents first. Counting the documents of
every token would move the whole corpus several times, so counts are taken over
a fixed part of the token space (all documents, tokens whose hash is below a
bound): tokens of that part with few documents come first. Documents whose
prefix is not filled by them - they consist mostly of shared passages, or are
very short - are read again with all their tokens, which are counted among
those documents. Any order gives the same links; this one gives few candidates.

Documents with equal sets are one class throughout. A large group of near copies
is first linked through hubs (one class per token), a number of pairs in
proportion to the postings; then only pairs from different components are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..operators.keys import keep_first
from . import textkit
from .common import Scratch, connected_components, fresh_name, small

# prefixes are lengthened by at most this many tokens
LONGEST = 4
# tokens of this many classes or more go behind all others
COMMON = 32
# estimated cost of one verification, in postings read
VERIFY_COST = 8
# the part of the token space that is counted, in percent of the share a prefix needs
COUNTED = 170
# bits of a token hash
_BITS = 63


def _set_rows(k: int, below: int, only_full: bool):
    """Arrow batches of (id, text) to (id, class, set size, tokens below a bound or all, in rising order)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in textkit.pieces(batch.column(1)):
                nodes, sizes, tokens = [], [], []
                for _, tokens_of in textkit.shingle_sets(part, k):
                    total = np.sum(textkit.mix(tokens_of.view(np.uint64)), dtype=np.uint64)
                    nodes.append(int(textkit.mix(np.array([total + np.uint64(len(tokens_of))]))[0] >> np.uint64(1)))
                    sizes.append(len(tokens_of))
                    tokens.append(tokens_of if only_full else tokens_of[: np.searchsorted(tokens_of, below)])
                lengths = np.array([0, *map(len, tokens)], np.int32)
                flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(part)),
                        pa.array(nodes, pa.int64()),
                        pa.array(sizes, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(flat, pa.int64())),
                    ],
                    names=["id", "node", "n", "tokens"],
                )

    return rows


def _sets(docs: DataFrame, k: int, below: int = 0, only_full: bool = True) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(_set_rows(k, below, only_full), f"id {kind}, node bigint, n int, tokens array<bigint>")


def _full_sets(docs: DataFrame, wanted: DataFrame, rows: int, k: int) -> DataFrame:
    """(node, tokens) with all tokens for the classes ``wanted`` (node, id), read again from their texts."""
    ids = small(wanted.select("id").distinct(), rows, 16)
    texts = docs.join(ids, docs["id"].eqNullSafe(ids["id"]), "left_semi")
    found = _sets(texts, k).join(small(wanted.select("node"), rows, 16), "node", "left_semi")
    return found.groupBy("node").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, rows: int, docs: DataFrame, classes: DataFrame, k: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """Those pairs (u, v) whose whole sets reach the threshold."""
    nodes = pairs.select("u").union(pairs.select("v")).distinct().toDF("node")
    wanted, seen = scratch.save_counted(classes.join(small(nodes, 2 * rows, 16), "node").select("node", F.col("min_id").alias("id")), f"{name}-nodes")
    sets = scratch.save(_full_sets(docs, wanted, seen["n"], k), f"{name}-sets")
    left, right = sets.toDF("u", "a"), sets.toDF("v", "b")
    both = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - F.col("shared")
    linked = pairs.join(left, "u").join(right, "v").withColumn("shared", both)
    return linked.filter(100 * F.col("shared").cast("bigint") >= percent * union.cast("bigint")).select("u", "v")


def _reaches(overlap: Column, n_u: Column, n_v: Column, percent: int) -> Column:
    """An intersection of this size would make sets of these sizes similar enough."""
    return overlap.cast("bigint") * (100 + percent) >= percent * (n_u + n_v).cast("bigint")


def _fits(n_u: Column, lone_u: Column, n_v: Column, lone_v: Column, percent: int) -> Column:
    """Sizes, and the tokens of either side that the other cannot hold, do not rule the pair out."""
    return _reaches(F.least(n_u - lone_u, n_v - lone_v), n_u, n_v, percent)


def _choice(n: int, counts: np.ndarray, percent: int) -> tuple[int, int]:
    """(prefix length, l) of least estimated cost; ``counts`` are the classes per token in prefix order."""
    slack = n + (-percent * n // 100)
    most = min(LONGEST, n - slack)
    read = np.cumsum(counts - 1)[slack : slack + most]
    # every posting is read; a candidate uses up l of them and is verified once
    l = int(np.argmin(read * (1 + VERIFY_COST / np.arange(1, most + 1)))) + 1
    return slack + l, l


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(bounds, values) of a list array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.offsets.to_numpy(), column.values


def _prefix_rows(percent: int):
    """Batches of (node, n, min_id, tokens, marks) to (node, n, min_id, l, tokens).

    ``marks`` holds (token, df) for the tokens of two classes or more. The tokens
    given back are the prefix; where rare tokens do not fill it, ``l`` is 0 and the
    tokens are the common ones.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, values = _lists(batch.column(3))
            tokens = values.to_numpy(zero_copy_only=False)
            marked, marks = _lists(batch.column(4))
            mark_token, mark_df = (marks.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ls, out = [], []
            for i, n in enumerate(batch.column(1).to_pylist()):
                own = tokens[bounds[i] : bounds[i + 1]]
                df = np.ones(len(own), np.int64)
                df[np.searchsorted(own, mark_token[marked[i] : marked[i + 1]])] = mark_df[marked[i] : marked[i + 1]]
                rare = df < COMMON
                slack = n + (-percent * n // 100)
                if rare.sum() < slack + min(LONGEST, n - slack):
                    ls.append(0)
                    out.append(own[~rare])
                else:
                    length, l = _choice(n, df[rare], percent)
                    ls.append(l)
                    out.append(own[rare][:length])
            yield _prefix_batch(batch, ls, out)

    return rows


def _whole_rows(percent: int, below: int):
    """Batches of (node, n, min_id, all tokens, marks among these documents, known common tokens) to the same rows.

    Order: rare tokens of the counted part by hash, as all other documents have
    it; then the rare among these documents by hash; then the rest by count.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, values = _lists(batch.column(3))
            tokens = values.to_numpy(zero_copy_only=False)
            marked, marks = _lists(batch.column(4))
            mark_token, mark_df = (marks.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            known, commons = _lists(batch.column(5))
            commons = commons.to_numpy(zero_copy_only=False)
            ls, out = [], []
            for i, n in enumerate(batch.column(1).to_pylist()):
                own = tokens[bounds[i] : bounds[i + 1]]
                df = np.ones(len(own), np.int64)
                df[np.searchsorted(own, mark_token[marked[i] : marked[i + 1]])] = mark_df[marked[i] : marked[i + 1]]
                common = np.zeros(len(own), bool)
                common[np.searchsorted(own, commons[known[i] : known[i + 1]])] = True
                part = np.where((own < below) & ~common, 0, np.where((df < COMMON) & ~common, 1, 2))
                order = np.lexsort((own, np.where(part == 2, df, 0), part))
                length, l = _choice(n, df[order], percent)
                ls.append(l)
                out.append(own[order][:length])
            yield _prefix_batch(batch, ls, out)

    return rows


def _prefix_batch(batch: pa.RecordBatch, ls: list[int], tokens: list[np.ndarray]) -> pa.RecordBatch:
    bounds = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
    flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), batch.column(2), pa.array(ls, pa.int32()), lists], names=["node", "n", "min_id", "l", "tokens"]
    )


def _marks(sets: DataFrame) -> DataFrame:
    """(node, marks): the tokens that two classes or more hold, with the number of classes."""
    postings = sets.select("node", F.explode("tokens").alias("token")).repartition("token")
    counts = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    hits = postings.join(counts.hint("shuffle_hash"), "token")
    return hits.groupBy("node").agg(F.collect_list(F.struct("token", "df")).alias("marks"))


def _prefixes(classes: DataFrame, docs: DataFrame, k: int, percent: int, below: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(place, token, node, n, l)``: the adaptive prefix of every class; and ``(node, min_id)``."""
    none = F.lit([]).cast("array<struct<token:bigint,df:bigint>>")
    kind = classes.schema["min_id"].dataType.simpleString()
    shape = f"node bigint, n int, min_id {kind}, l int, tokens array<bigint>"
    marked = classes.join(_marks(classes), "node", "left").select("node", "n", "min_id", "tokens", F.coalesce("marks", none).alias("marks"))
    chosen, seen = scratch.save_counted(marked.mapInArrow(_prefix_rows(percent), shape), "chosen", lacking=F.count_if(F.col("l") == 0))
    scratch.drop("classes")
    ids = scratch.save(chosen.select("node", "min_id"), "ids")
    prefixes = chosen.filter("l > 0")
    if seen["lacking"]:
        lacking = chosen.filter("l = 0")
        sets = _full_sets(docs, lacking.select("node", F.col("min_id").alias("id")), seen["lacking"], k)
        whole = scratch.save(sets.join(lacking.withColumnRenamed("tokens", "commons"), "node"), "whole")
        ready = whole.join(_marks(whole), "node", "left").select(
            "node", "n", "min_id", "tokens", F.coalesce("marks", none).alias("marks"), "commons"
        )
        prefixes = prefixes.union(scratch.save(ready.mapInArrow(_whole_rows(percent, below), shape), "whole-chosen"))
        scratch.drop("whole")
    return prefixes.select(F.posexplode("tokens").alias("place", "token"), "node", "n", "l"), ids


def ngram_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate groups: ``(id, n_shingles, component_id, group)``, one row per row of ``docs``.

    A document's set holds its distinct runs of ``words`` lower-cased words, or the
    whole sequence when there are fewer. Documents link when 100 * intersection
    reaches ``percent`` * union. ``component_id`` is the smallest id reachable by
    links, ``group`` a number that is equal for rows of one component.

    Null and empty texts have an empty set, link with nothing and are their own
    component (``group`` is null). Rows with equal ids are separate documents.
    A null id takes part in links, but is no component's id unless all are null.
    Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    below = min(1 << _BITS, COUNTED * (100 - percent) * (1 << _BITS) // 10_000) - 1
    base = scratch.save(_sets(docs, words, below, only_full=False), "base")
    classes = scratch.save(
        base.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min("id").alias("min_id"), F.first("tokens").alias("tokens")),
        "classes",
    )
    base = scratch.save(base.select("id", "node", "n"), "rows")
    scratch.drop("base")
    # postings of tokens that at least two prefixes hold; all later steps work on these
    prefixes, classes = _prefixes(classes, docs, words, percent, below, scratch)
    held = prefixes.repartition("token")
    live = held.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    live = scratch.save(held.join(live.hint("shuffle_hash"), "token"), "held")
    # tokens of a prefix that no other prefix holds: a partner that shares a later token lacks them
    own = W.partitionBy("node")
    lone = F.col("place") + 1 - F.row_number().over(own.orderBy("place"))
    live = live.withColumn("lone", lone).withColumn("far", F.max("lone").over(own))
    fits = _reaches(F.col("n") - F.col("lone"), F.col("n"), F.ceil(F.col("n") * percent / 100), percent)
    live, seen = scratch.save_counted(live.filter(fits), "live")
    scratch.drop("held", "chosen", "whole-chosen")
    links = None
    if seen["n"]:
        links = _links(live, docs, classes, words, percent, scratch)
    rows = base.select("id", F.when(F.col("n") > 0, F.col("node")).alias("node"), F.col("n").cast("bigint").alias("n_shingles"))
    least = classes.select("node", "min_id", F.col("node").alias("root"))
    if links is not None:
        parts = connected_components(links, scratch, "final")
        joined = classes.select("node", "min_id").join(parts, "node", "left").withColumn("root", F.coalesce("root", "node"))
        in_part = joined.filter("root is not null").groupBy("root").agg(F.min("min_id").alias("part_id"))
        least = joined.join(in_part, "root").select("node", F.col("part_id").alias("min_id"), "root")
    found = rows.join(least, "node", "left")
    return found.select(
        F.col("id").alias(id_column), "n_shingles", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("min_id")).alias("component_id"),
        F.col("root").alias("group"),
    )


def _links(live: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """Verified links (u, v) that connect every component."""
    # hubs of each token: the classes nearest to all others, with the fewest tokens that nobody shares; ties by two hashes
    rank = lambda h: F.struct("far", h.alias("h"), "node", "n", "l", "lone")
    hubs = live.groupBy("token").agg(F.min(rank(F.xxhash64("node"))).alias("lo"), F.min(rank(-F.xxhash64("node"))).alias("hi"))
    near = live.join(hubs, "token").select("node", "n", "l", "lone", F.explode(F.array("lo", "hi")).alias("hub"))
    near = near.filter(F.col("node") != F.col("hub.node")).filter(_fits(F.col("n"), F.col("lone"), F.col("hub.n"), F.col("hub.lone"), percent))
    pairs = near.select(F.greatest("node", "hub.node").alias("u"), F.least("node", "hub.node").alias("v"), F.least("l", "hub.l").alias("l"))
    pairs = pairs.groupBy("u", "v").agg(F.count(F.lit(1)).alias("shared"), F.min("l").alias("l")).filter("shared >= l").select("u", "v")
    tried, seen = scratch.save_counted(pairs, "hub-pairs")
    first = scratch.save(_verified(tried, seen["n"], docs, classes, k, percent, scratch, "hub"), "hub-links")
    parts = scratch.save(connected_components(first, scratch, "hub-parts"), "hub-roots")
    # what is left: pairs of different components below one token
    placed = live.join(parts, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root", "df")
    mixed = placed.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("token")
    open_, seen = scratch.save_counted(placed.join(mixed, "token", "left_semi"), "open")
    if not seen["n"]:
        return first
    names = ["token", "node", "n", "l", "place", "lone", "part"]
    a, b = open_.select(*[F.col(c).alias(f"{c}_u" if c != "token" else c) for c in names]), open_.select(*[F.col(c).alias(f"{c}_v" if c != "token" else c) for c in names])
    fits = _fits(F.col("n_u"), F.col("lone_u"), F.col("n_v"), F.col("lone_v"), percent)
    # with this token shared, what lies before and behind it bounds the overlap too
    around = F.least("place_u", "place_v") + 1 + F.least(F.col("n_u") - F.col("place_u"), F.col("n_v") - F.col("place_v")) - 1
    crossing = a.join(b, "token").filter(
        (F.col("part_u") != F.col("part_v")) & (F.col("node_u") > F.col("node_v")) & fits & _reaches(around, F.col("n_u"), F.col("n_v"), percent)
    )
    pairs = crossing.groupBy(F.col("node_u").alias("u"), F.col("node_v").alias("v")).agg(
        F.count(F.lit(1)).cast("int").alias("shared"), F.min(F.least("l_u", "l_v")).alias("l"), F.first("n_u").alias("n_u"), F.first("n_v").alias("n_v"),
        F.least(F.min(F.col("n_u") - F.col("place_u")), F.min(F.col("n_v") - F.col("place_v"))).alias("behind"),
    )
    # shared tokens up to the last one in both prefixes, and at most all that follow it
    pairs = pairs.filter((F.col("shared") >= F.col("l")) & _reaches(F.col("shared") + F.col("behind") - 1, F.col("n_u"), F.col("n_v"), percent))
    rest, seen = scratch.save_counted(pairs.select("u", "v").join(tried, ["u", "v"], "left_anti"), "rest-pairs")
    if not seen["n"]:
        return first
    return scratch.save(first.union(_verified(rest, seen["n"], docs, classes, k, percent, scratch, "rest")), "links")


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one of smallest ``doc_id``, null last.

    All columns are kept. Documents without words are all kept. Of rows that
    repeat a ``doc_id`` within a group one stays.
    """
    row = fresh_name("row", docs.columns)
    scratch = Scratch(docs.sparkSession, "near-copies")
    # repeated ids need a number of their own to be told apart
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1 or doc_id is null")
    again, seen = scratch.save_counted(ids.select(F.col("doc_id").alias("id")), "again")
    if not seen["n"]:
        groups = scratch.save(ngram_components(docs, words=words, percent=percent), "groups")
        gone, n = scratch.save_counted(groups.filter("group is not null and doc_id <> component_id").select("doc_id"), "gone")
        return docs.join(small(gone, n["n"], 16), "doc_id", "left_anti").select(docs.columns)
    numbered = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = ngram_components(numbered, id_column=row, words=words, percent=percent).select(row, "group")
    ranked = numbered.select(row, "doc_id").join(groups, row)
    kept = keep_first(ranked.filter("group is not null"), ["group"], [F.asc_nulls_last("doc_id"), F.asc(row)])
    kept, _ = scratch.save_counted(kept.select(row).union(ranked.filter("group is null").select(row)), "kept")
    return numbered.join(kept, row, "left_semi").drop(row)
