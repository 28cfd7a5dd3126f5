"""Removal of repeated runs of lines by winnowing over line hashes, in DataFrame operations only.

A window is a shortest run of lines that holds ``min_words`` words: from each line
on, and back from each line. From each window the line of smallest hash is selected
as its fingerprint. Two equal windows select the same line, so every repeated run
of ``min_words`` words or more shares a fingerprint: a guarantee, with few
fingerprints. Fingerprints found at one place only end the search for their
windows. Where a fingerprint recurs, the windows around its places are compared as
a whole, and the lines of every window that occurred before are deleted. The windows
that run forward carry a match to the right as far as a whole window fits, those that
run back reach its last line, and the same to the left; so a match is extended both
ways over the whole repeated run, and no further. All steps are groupings by a hash,
so a line that a third of all documents share costs no more than others, and no two
places are paired.

Lines and windows are told apart by two independent hashes of 64 bits each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from .common import WORD, Scratch, fresh_name, small

# a repeated run of lines counts from this many words on
MIN_WORDS = 50


def _windows(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, key, start, end, fingerprint, place, content): each window with its fingerprint and the hashes of its lines."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g"), F.regexp_count(line, F.lit(WORD)).alias("words")),
    )
    # rows equal in id and text are one document
    each = docs.filter("text is not null").select("id", "key", lines.alias("lines")).groupBy("id", "key").agg(F.first("lines").alias("lines"))
    each = each.select("id", "key", F.posexplode("lines").alias("no", "line")).select("id", "key", "no", "line.h", "line.g", "line.words").filter("words > 0")
    doc = W.partitionBy("id", "key")
    each = each.withColumn("upto", F.sum("words").over(doc.orderBy("no").rowsBetween(W.unboundedPreceding, 0)))
    each = each.withColumn("before", F.col("upto") - F.col("words"))

    def window(run: WindowSpec) -> Column:
        least = F.min(F.struct("h", "no")).over(run)
        return F.struct(
            F.min("no").over(run).alias("start"), F.max("no").over(run).alias("end"), least["h"].alias("fingerprint"), least["no"].alias("place"),
            F.struct(F.xxhash64(F.collect_list("h").over(run)).alias("h"), F.xxhash64(F.collect_list("g").over(run)).alias("g")).alias("content"),
            F.sum("words").over(run).alias("words"),
        )

    # forward, a line belongs to the window while the words in front of it, from the window's start, are fewer than min_words;
    # back, while the words behind it, up to the window's end, are
    forward = window(doc.orderBy("before").rangeBetween(0, min_words - 1))
    back = window(doc.orderBy("upto").rangeBetween(1 - min_words, 0))
    found = each.select("id", "key", forward.alias("forward"), back.alias("back"))
    found = found.select("id", "key", F.explode(F.array("forward", "back")).alias("w")).select("id", "key", "w.*")
    return found.filter(F.col("words") >= min_words).drop("words")


def repeated_lines(docs: DataFrame, scratch: Scratch, min_words: int) -> DataFrame:
    """(id, key, gone): for documents with repeated lines, the numbers of the lines to delete."""
    windows = scratch.save(_windows(docs, min_words), "windows")
    # winnowing: a fingerprint is one selected place; several windows may select it
    places = windows.select("fingerprint", "id", "key", "place").groupBy("fingerprint").agg(
        F.min(F.struct("id", "key", "place")).alias("lo"), F.max(F.struct("id", "key", "place")).alias("hi")
    )
    recurring, seen = scratch.save_counted(places.filter("not (lo <=> hi)").select("fingerprint"), "recurring")
    matched, _ = scratch.save_counted(windows.join(small(recurring, seen["n"], 16), "fingerprint", "left_semi"), "matched")
    at = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("key").alias("key"), F.col("start").alias("start"))
    first = matched.groupBy("content").agg(F.min(at).alias("first"), F.max(at).alias("latest"))
    first, seen = scratch.save_counted(first.filter("not (first <=> latest)").select("content", "first"), "first")
    later = matched.join(small(first, seen["n"], 64), "content").filter(~F.col("first").eqNullSafe(at))
    lines = later.select("id", "key", F.explode(F.sequence("start", "end")).alias("no"))
    return lines.groupBy("id", "key").agg(F.collect_set("no").alias("gone"))


def drop_repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from the text, and ``n_lines``, ``n_removed``.

    Every run of lines of ``min_words`` words or more that occurred before is deleted as a whole
    where it comes later, in the order of id (null last), then line; between rows
    of one id, in the order of a hash of their texts. Lines are equal when all
    their characters are; lines without words are passed over when runs are
    compared, and go where they lie inside a deleted run. First occurrences stay.

    Null texts stay null (no lines). Rows equal in id and text are one document
    and are treated alike. All other columns are kept as they are; a column named
    ``n_lines`` or ``n_removed`` is replaced. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    slim = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("key"), F.col(text_column).alias("text"))
    gone, seen = scratch.save_counted(repeated_lines(slim, scratch, min_words), "gone", lines=F.sum(F.size("gone")))
    scratch.drop("windows", "matched", "recurring", "first")
    names = {n: fresh_name(n, docs.columns) for n in ("id_", "key_", "gone_", "lines_", "left_")}
    gone = gone.toDF(names["id_"], names["key_"], names["gone_"])
    gone = small(gone, seen["n"], 64 + 8 * ((seen["lines"] or 0) // max(seen["n"], 1) + 1))
    on = F.col(names["id_"]).eqNullSafe(docs[id_column]) & F.col(names["key_"]).eqNullSafe(F.xxhash64(docs[text_column]))
    joined = docs.join(gone, on, "left")
    # a generator keeps the lines as a column of their own, split once per text
    joined = joined.withColumn(names["lines_"], F.explode(F.array(F.split(text_column, "\n"))))
    lines, lost = F.col(names["lines_"]), F.col(names["gone_"])
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    kept = F.array_join(F.transform(left, lambda k: F.element_at(lines, k + 1)), "\n")
    texts = F.when(lost.isNull(), F.col(text_column)).otherwise(kept)
    count = F.coalesce(F.greatest(F.size(lines), F.lit(0)), F.lit(0)).cast("bigint")
    removed = F.coalesce(F.greatest(F.size(lost), F.lit(0)), F.lit(0)).cast("bigint")
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *[texts.alias(c) if c == text_column else F.col(c) for c in others], count.alias("n_lines"), removed.alias("n_removed")
    )
