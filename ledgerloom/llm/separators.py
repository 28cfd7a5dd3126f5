"""Token counts of documents in flat, unindexed token files, by a scan for separators.

A token file is a sequence of fixed-width ids in which an end-of-document id ends
each document; nothing tells where documents begin. The file is read in blocks
of equal size, anywhere in the stream. Each block is searched at once by NumPy;
a document that crosses blocks is put together from their boundaries: a prefix
scan over the blocks of a file carries the number of separators before each
block and the position of the last one. The scan runs in two levels, over groups
of blocks first, so a file with a third of all tokens is no single task's work.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import Scratch, small

# bytes of one block
BLOCK_BYTES = 512 << 10
# blocks of one group of the prefix scan
GROUP = 1024
# where the public vocabularies lie, and the one used; its highest rank plus one ends a document
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the split pattern of the public 50k byte-level BPE vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256


def _encoding(path: str):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_stream(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """Flat token streams of all documents, and the order the documents were written in.

    Returns ``(file, block, payload)`` - one file per partition, cut into blocks of
    BLOCK_BYTES without regard to documents, ids as little-endian uint16 - and
    ``(file, ordinal, id)``. Null texts are written as empty documents; control
    strings inside texts are ordinary text and never the separator.
    """
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary).encode_ordinary
        file, block, ordinal, held, id_type = TaskContext.get().partitionId(), 0, 0, bytearray(), pa.null()

        def cut(size: int) -> pa.RecordBatch:
            nonlocal block
            payload = bytes(held[:size])
            del held[:size]
            block += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block - 1]), pa.array([payload], pa.binary()), pa.array([None], pa.int64()), pa.nulls(1, id_type)],
                names=["file", "block", "payload", "ordinal", "id"],
            )

        for batch in batches:
            id_type = batch.column(0).type
            for text in batch.column(1):
                held += np.array([*encode(text.as_py() or ""), END], "<u2").tobytes()
                while len(held) >= BLOCK_BYTES:
                    yield cut(BLOCK_BYTES)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column(0)],
                names=["file", "block", "payload", "ordinal", "id"],
            )
            ordinal += n
        if held:
            yield cut(len(held))

    stream = slim.mapInArrow(tokenise, f"file bigint, block bigint, payload binary, ordinal bigint, id {kind}")
    stream = scratch.save(stream, "stream")
    blocks = stream.filter("block is not null").select("file", "block", "payload")
    return blocks, stream.filter("ordinal is not null").select("file", "ordinal", "id")


def read_token_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(file, block, payload)`` of binary token files; each file, up to Spark's limit of 2 GB, is read by one task."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / block_bytes))
    cut = F.substring(F.col("content"), (F.col("block") * block_bytes + 1).cast("int"), F.lit(block_bytes))
    return files.select(F.col("path").alias("file"), "content", F.explode(blocks).alias("block")).select("file", "block", cut.alias("payload"))


def scan_separators(blocks: DataFrame, scratch: Scratch, end: int = END, dtype: str = "<u2") -> DataFrame:
    """``(file, ordinal, start, n_tokens, ended)``: every document of every file, in file order.

    ``blocks`` is ``(file, block, payload)``, whole ids in each; block sizes may
    differ. ``start`` is the document's first id in its file. Tokens behind the last
    separator are a document that is not ``ended``; a file that ends with a
    separator has none there. Two separators in a row hold an empty document. Null
    payloads and an empty table give no documents.
    """
    kind = blocks.schema["file"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for payload in batch.column(2):
                ids = np.frombuffer(payload.as_buffer() if payload.is_valid else b"", dtype)
                found.append(np.flatnonzero(ids == end))
                sizes.append(len(ids))
            bounds = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int64()))],
                names=["file", "block", "size", "ends"],
            )

    # a batch holds few payloads, whatever the session's setting for narrow rows
    found = blocks.select("file", "block", "payload").mapInArrow(search, f"file {kind}, block bigint, size bigint, ends array<bigint>")
    found = scratch.save(found, "separators")
    group = F.floor(F.col("block") / GROUP)
    summary = found.select("file", "block", group.alias("group"), "size", F.size("ends").cast("bigint").alias("n"), F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1).alias("last"))
    # level one: inside a group of blocks; level two: over the groups of a file
    inside = W.partitionBy("file", "group").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    local = summary.withColumn("at", F.coalesce(F.sum("size").over(inside), zero)).withColumn("before", F.coalesce(F.sum("n").over(inside), zero))
    local = local.withColumn("previous", F.last(F.col("at") + F.col("last"), ignorenulls=True).over(inside))
    total = summary.groupBy("file", "group").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max("block").alias("tail"))
    ends = local.filter("last is not null").groupBy("file", "group").agg(F.max(F.col("at") + F.col("last")).alias("last"))
    total = total.join(ends, ["file", "group"], "left")
    over = W.partitionBy("file").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    offset = total.withColumn("at0", F.coalesce(F.sum("size").over(over), zero)).withColumn("before0", F.coalesce(F.sum("n").over(over), zero))
    offset = offset.withColumn("previous0", F.last(F.col("at0") + F.col("last"), ignorenulls=True).over(over))
    offset = offset.withColumn("tail_group", F.max("group").over(W.partitionBy("file"))).select(
        "file", "group", "at0", "before0", "previous0", F.when(F.col("group") == F.col("tail_group"), F.col("tail")).alias("tail")
    )
    offset, seen = scratch.save_counted(offset, "offsets")
    places = local.join(small(offset, seen["n"], 128), ["file", "group"]).select(
        "file", "block", (F.col("at0") + F.col("at")).alias("at"), (F.col("before0") + F.col("before")).alias("before"),
        # the first id behind the last separator in front of this block
        (F.coalesce(F.col("at0") + F.col("previous"), F.col("previous0"), F.lit(-1)) + 1).alias("open"), (F.col("block") == F.col("tail")).alias("is_tail"),
    )
    joined = found.join(places, ["file", "block"])
    # documents that end in this block; behind the file's last separator, the open rest
    rest_at = F.when(F.size("ends") > 0, F.col("at") + F.element_at("ends", -1) + 1).otherwise(F.col("open"))
    rest = F.when(F.col("is_tail") & (F.col("at") + F.col("size") > rest_at), F.array(F.struct(
        (F.col("before") + F.size("ends")).cast("bigint").alias("ordinal"), rest_at.alias("start"),
        (F.col("at") + F.col("size") - rest_at).alias("n_tokens"), F.lit(False).alias("ended"),
    )))
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: F.col("at") + e + 1))
    laid = joined.select("file", "at", "before", "ends", F.explode(F.array(starts)).alias("starts"), rest.alias("rest"))
    own = F.transform("ends", lambda e, i: F.struct(
        (F.col("before") + i).cast("bigint").alias("ordinal"), F.get("starts", i).alias("start"), (F.col("at") + e - F.get("starts", i)).alias("n_tokens"), F.lit(True).alias("ended"),
    ))
    documents = F.when(F.col("rest").isNull(), own).otherwise(F.concat(own, F.col("rest")))
    return laid.select("file", F.explode(documents).alias("d")).select("file", "d.ordinal", "d.start", "d.n_tokens", "d.ended")


def count_tokens(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``(id, file, ordinal, start, n_tokens)`` for every row of ``docs``, from token streams of their texts.

    Null and empty texts have 0 tokens. Rows with equal ids are documents each.
    """
    scratch = Scratch(docs.sparkSession, "separators")
    blocks, order = write_token_stream(docs, scratch, id_column, text_column, vocabulary)
    found = scan_separators(blocks, scratch)
    return order.join(found, ["file", "ordinal"]).select(F.col("id").alias(id_column), "file", "ordinal", "start", "n_tokens")
