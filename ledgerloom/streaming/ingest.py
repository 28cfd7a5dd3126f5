"""Incremental file ingest: new files only, through Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import matches_pattern, with_file_metadata

FILES_PER_STEP = 10000

# late and re-sent deliveries are normal: no file is too old to be read
_NO_AGE_LIMIT = "36500d"


def file_stream(
    spark: SparkSession, path: str, *, glob: str = "*", schema=None, options: dict | None = None,
    files_per_step: int = FILES_PER_STEP, separator: str | None = None,
) -> DataFrame:
    """A stream over the files of a folder: whole text documents, text pieces, or CSV rows when a schema is given."""
    reader = (
        spark.readStream.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_step)
        .option("maxFileAge", _NO_AGE_LIMIT)
    )
    if separator is not None:
        return with_file_metadata(reader.text(path, lineSep=separator))
    if schema is None:
        return with_file_metadata(reader.text(path, wholetext=True))
    return with_file_metadata(reader.schema(schema).options(**(options or {})).csv(path))


def start_file_ingest(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], pattern: str | None = None
) -> StreamingQuery:
    """Start processing the files not seen before; the query ends when they are done.

    The checkpoint remembers loaded files. ``write`` gets each step with its
    number, which stays the same if the step is repeated after a failure; a
    writer that replaces the output of that number is therefore exactly-once.
    """
    if pattern:
        stream = stream.filter(matches_pattern(F.col("source_file_path"), pattern))
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def incremental_file_ingest(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], pattern: str | None = None
) -> int:
    """Process the files not seen before and return the number of rows read."""
    query = start_file_ingest(stream, checkpoint, write, pattern)
    query.awaitTermination()
    return sum(int(p["numInputRows"]) for p in query.recentProgress)
