r"""CSV records of files of any size, split among tasks, whatever line feeds their values hold.

A quoted value may hold line feeds, and ``\`` may stand before one in an unenclosed
value, so a line of a file is not always a record, and whether it begins one
depends on all lines before it. That dependence is a state of three values: the
line begins a record, it is inside quotes, or it goes on after ``\``. Every split is
read once, for all three states it could begin with; what its lines do to the
state is one small function per split, and a prefix scan over the splits of each
file tells which of the three was true. Only the lines of records that have more
than one line are shuffled.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, LongType, StructField, StructType

from ..session import materialize
from .files import with_file_metadata

# the functions of this module travel to the executors with the job, which need not have the library installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# a record of several lines longer than this is not put together: fixed value, the longest text value of the source system
LONGEST_RECORD = 16 << 20

BLANKS = " \t\r\n\x0b\x0c"

START, QUOTED, ESCAPED = 0, 1, 2
# what a line without quotes and backslashes makes of each state
_PLAIN = (START, QUOTED, START)

_QUOTED_REST = re.compile(r'[^"]*+(?:""[^"]*+)*+"')
_OPENS = re.compile(r'[ \t]*"')


class Lexer:
    """Values of records with a given separator.

    A value is enclosed if a quote is its first character but for blanks; then two
    quotes are one, and what follows the closing quote up to the separator belongs
    to the value. In an unenclosed value a quote is a character like others and
    ``\\`` takes the next one as it is. Blanks around values go.
    """

    def __init__(self, sep: str):
        self.sep = sep
        self._open_rest = re.compile(rf"[^{re.escape(sep)}\\]*+(?:\\.[^{re.escape(sep)}\\]*+)*+", re.S)

    def after(self, line: str, state: int) -> int:
        """The state in which a line leaves the next one."""
        at, inside = 0, state == QUOTED
        fresh = state == START
        while True:
            if fresh and (opening := _OPENS.match(line, at)):
                at, inside = opening.end(), True
            if inside:
                closing = _QUOTED_REST.match(line, at)
                if closing is None:
                    return QUOTED
                at, inside = closing.end(), False
            at = self._open_rest.match(line, at).end()
            if at == len(line):
                return START
            if line[at] != self.sep:  # a backslash at the end of the line
                return ESCAPED
            at, fresh = at + 1, True

    def fields(self, record: str) -> list[str]:
        at, found = 0, []
        while True:
            value, opening = "", _OPENS.match(record, at)
            if opening:
                closing = _QUOTED_REST.match(record, opening.end())
                end = closing.end() if closing else len(record)
                value = record[opening.end() : end - 1 if closing else end].replace('""', '"')
                at = end
            rest = self._open_rest.match(record, at)
            tail, at = rest[0].strip(BLANKS), rest.end()
            if at < len(record) and record[at] != self.sep:
                at += 1  # a backslash that ends the file
            found.append(value + re.sub(r"\\(.)", r"\1", tail, flags=re.S))
            if at >= len(record):
                return found
            at += 1


def _states(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[pa.RecordBatch]:
    """Every line with the states before and after it and the records begun in its split, for each state the split could begin with.

    Three states are written as one number, in base three.
    """
    lexer = Lexer(sep)
    split, states, records = None, None, None
    for batch in batches:
        values = batch.column("value")
        special = pc.or_(pc.match_substring(values, '"'), pc.match_substring(values, "\\")).to_pylist()
        blank = pc.equal(pc.utf8_trim(values, BLANKS), "").to_pylist()
        texts = values.to_pylist()
        places = zip(batch.column("source_file_path").to_pylist(), batch.column("_block_start").to_pylist())
        before, after, numbers = [], [], []
        for i, place in enumerate(places):
            if place != split:
                split, states, records = place, (START, QUOTED, ESCAPED), [0, 0, 0]
            if special[i]:
                text = texts[i].removesuffix("\r")
                one = {s: lexer.after(text, s) for s in set(states)}
                new = tuple(one[s] for s in states)
            else:
                new = tuple(_PLAIN[s] for s in states)
            for h, s in enumerate(states):
                if s == START and not blank[i]:
                    records[h] += 1
            before.append(states[0] + 3 * states[1] + 9 * states[2])
            after.append(new[0] + 3 * new[1] + 9 * new[2])
            numbers.append(tuple(records))
            states = new
        columns = [*batch.columns, pa.array(before, pa.int8()), pa.array(after, pa.int8()), *[pa.array([n[h] for n in numbers], pa.int64()) for h in range(3)]]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_before", "_after", "_r0", "_r1", "_r2"])


def _scan(splits: pa.Table) -> pa.Table:
    """State and number of records at the start of each split of one file."""
    rows = sorted(zip(*(splits.column(c).to_pylist() for c in ("_block_start", "source_file_path", "_after", "_r0", "_r1", "_r2"))))
    state, records, found = START, 0, []
    for block, path, after, *begun in rows:
        found.append((path, block, state, records))
        records += begun[state]
        state = after // 3**state % 3
    columns = list(zip(*found))
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["source_file_path", "_block_start", "_state", "_earlier"])


def split_records(lines: DataFrame, sep: str, header: bool, record_ids=None) -> DataFrame:
    """One row per record of text ``lines`` that carry file metadata (``value`` without its line feed).

    Columns: ``value`` (the record), ``unreadable``, ``file_row_number`` (from 1, the header
    not counted) and the files' metadata; ``record_ids(lines)`` may add columns, of which a
    record keeps those of its first line. Blank lines between records are no records. A
    record that never ends (its quote is not closed), or that is longer than
    ``LONGEST_RECORD``, is not put together: each of its lines is an unreadable row of
    its own, so nothing is lost and no value is unbounded.
    """
    lines = lines.withColumn("value", F.make_valid_utf8("value")).withColumn("_line", F.monotonically_increasing_id())
    lines = record_ids(lines) if record_ids else lines
    kept = [c for c in lines.columns if c not in ("value", "_line", "_block_start")]
    shape = StructType([*lines.schema.fields, StructField("_before", ByteType()), StructField("_after", ByteType()), *[StructField(r, LongType()) for r in ("_r0", "_r1", "_r2")]])
    # one scan, written once: what follows reads this table, so other splits of a second scan cannot disagree with it
    read = materialize(lines.mapInArrow(lambda b: _states(b, sep), shape), "csv-lines")
    ends = read.groupBy("source_file_path", "_block_start").agg(F.max_by("_after", "_line").alias("_after"), *[F.max(r).alias(r) for r in ("_r0", "_r1", "_r2")])
    # a row per split; the splits of one file meet in one task
    starts = ends.groupBy("source_file_path").applyInArrow(_scan, "source_file_path string, _block_start long, _state int, _earlier long")
    known = materialize(starts, "csv-splits")
    of_state = lambda packed: F.floor(F.col(packed) / F.pow(F.lit(3), F.col("_state"))).cast("int") % 3
    record = F.col("_earlier") + F.when(F.col("_state") == 0, F.col("_r0")).when(F.col("_state") == 1, F.col("_r1")).otherwise(F.col("_r2"))
    told = read.join(known, ["source_file_path", "_block_start"]).withColumns({"_from": of_state("_before"), "_to": of_state("_after"), "_record": record})
    first = 1 if header else 0
    # a caller's condition on values is not to be tried on headers, so it may not pass below the join
    told = told.filter(F.col("_record") > first).withColumn("value", F.when(F.col("_record") > first, F.col("value")))
    single = (F.col("_from") == START) & (F.col("_to") == START)
    number = (F.col("_record") - first).alias("file_row_number")
    clean = F.regexp_replace("value", r"\r$", "")
    alone = told.filter(single & (F.btrim(clean, F.lit(BLANKS)) != "")).select(clean.alias("value"), F.lit(False).alias("unreadable"), number, *kept)

    parts = told.filter(~single)
    key = ["source_file_path", "_record"]
    sizes = parts.groupBy(*key).agg(F.sum(F.length("value") + 1).alias("_size"), F.max_by("_to", F.struct("_block_start", "_line")).alias("_last"))
    sizes = sizes.withColumn("_whole", (F.col("_size") <= LONGEST_RECORD) & (F.col("_last") != QUOTED)).select(*key, "_whole")
    parts = parts.join(sizes, key)
    line = F.struct("_block_start", "_line", "value", *[c for c in kept if c != "source_file_path"])
    whole = parts.filter("_whole").groupBy(*key).agg(F.sort_array(F.collect_list(line)).alias("_lines"))
    text = F.regexp_replace(F.array_join(F.transform("_lines", lambda x: x["value"]), "\n"), r"\r$", "")
    firsts = [F.col("source_file_path") if c == "source_file_path" else F.col("_lines")[0][c].alias(c) for c in kept]
    whole = whole.select(text.alias("value"), F.lit(False).alias("unreadable"), number, *firsts)
    broken = parts.filter("NOT _whole").select(clean.alias("value"), F.lit(True).alias("unreadable"), number, *kept)
    return alone.unionByName(whole).unionByName(broken)


def values_of(record: Column, sep: str) -> Column:
    """The values of a record, without the blanks around them. Records without quotes and backslashes need no lexer."""

    @F.arrow_udf("array<string>")
    def lexed(records: pa.Array) -> pa.Array:
        lexer = Lexer(sep)
        return pa.array([None if r is None else lexer.fields(r) for r in records.to_pylist()], pa.list_(pa.string()))

    special = F.contains(record, F.lit('"')) | F.contains(record, F.lit("\\"))
    plain = F.transform(F.split(record, re.escape(sep)), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.when(special, lexed(F.when(special, record))).otherwise(plain)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Lines of text files with the metadata of their files and splits; a line ends at a line feed only."""
    return with_file_metadata(spark.read.option("recursiveFileLookup", "true").text(path, lineSep="\n"))
