"""Records of nested documents of any size, split among tasks: XML transactions and JSON array elements.

Text files are read in pieces that end where a record could end: at ``</Transaction>``
or at ``}``. Whether that text is markup, or lies in a comment, a CDATA section or a
string, and how deep it is nested, depends on everything before it. Each split is
read once, in order, for every lexical state it could begin in, with depths counted
from its start; a prefix scan over the splits of a file then tells state and depth at
each start. A piece that begins between records and ends a record is one by itself;
the few others are put together. What lies outside records, the skeleton, is checked
as a document of its own, and the verdict on a document is that on its skeleton and
on all its records.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ..session import materialize
from .formats import CORRUPT

# the functions of this module travel to the executors with the job, which need not have the library installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# a record or skeleton longer than this is not put together: fixed value, the longest text value of the source system
LONGEST_RECORD = 16 << 20
OUTSIDE = 0
# marks what stands for a record in a skeleton
STAND_IN = "ledgerloom-stand-in"


class Xml:
    """Pieces that end at ``</Transaction>``; states: markup, comment, CDATA section, processing instruction."""

    sep, states = "</Transaction>", 4
    _ends = (None, "-->", "]]>", "?>")
    _named, _stand_in = re.compile(r"<Transaction[\s/>]"), re.compile(rf'<Transaction {STAND_IN}="(\d+)"/>$')
    _token = re.compile(
        r"""<!--(?:.*?-->|(?P<comment>.*))|<!\[CDATA\[(?:.*?\]\]>|(?P<cdata>.*))|<\?(?:.*?\?>|(?P<pi>.*))"""
        r"""|(?P<close></[^>]*>)|(?P<open><[^\s"'<>/!?][^"'<>]*+(?:"[^"]*+"[^"'<>]*+|'[^']*+'[^"'<>]*+)*+>)""",
        re.S,
    )

    def piece(self, text: str, state: int) -> tuple[int, int, list[int]]:
        """State at the end, depth gained, and the places of the tags opened here, before the separator."""
        at = 0
        if state:
            at = text.find(self._ends[state])
            if at < 0:
                return state, 0, []
            at += 3 if state < 3 else 2
        depth, open_ = 0, []
        for token in self._token.finditer(text, at):
            kind = token.lastgroup
            if kind == "open":
                if text[token.end() - 2] != "/":
                    depth += 1
                    open_.append(token.start())
            elif kind == "close":
                depth -= 1
                if open_:
                    open_.pop()
            elif kind:  # not closed in this piece
                return {"comment": 1, "cdata": 2, "pi": 3}[kind], depth, open_
        return OUTSIDE, depth, open_

    def children(self, document: str) -> list[dict]:
        """The ``<Transaction>`` children of the root in order; ``k`` numbers stand-ins and is None for others."""
        depth, start, found = 0, None, []
        for token in self._token.finditer(document):
            if token.lastgroup == "open":
                named = self._named.match(token[0])
                if token[0].endswith("/>"):
                    if depth == 1 and named:
                        stand_in = self._stand_in.match(token[0])
                        found.append({"k": int(stand_in[1]) if stand_in else None, "text": token[0]})
                else:
                    if depth == 1:
                        start = token.start() if named else None
                    depth += 1
            elif token.lastgroup == "close":
                depth -= 1
                if depth == 1 and start is not None:
                    found.append({"k": None, "text": document[start : token.end()]})
                    start = None
        return found

    def segment(self, pieces: pa.Array, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per piece, its separator included: state and depth after it, and where the element it ends begins (-1: before the piece)."""
        states, depths, opens, depth = [], [], [], 0
        for text in pieces.to_pylist():
            state, gained, open_ = self.piece(text, state)
            depth += gained
            if state == OUTSIDE:
                depth -= 1
            states.append(state)
            depths.append(depth)
            opens.append(open_[-1] if open_ and state == OUTSIDE else -1)
        return np.array(states, np.int8), np.array(depths, np.int32), np.array(opens, np.int64)


class Json:
    """Pieces that end at ``}``; states: outside of strings, in a string. All places are found at once in the bytes of many pieces."""

    sep, states = "}", 2

    def segment(self, pieces: pa.Array, state: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        joined = b"}".join(pieces.cast(pa.binary()).to_pylist()) + b"}"
        raw = np.frombuffer(joined, np.uint8)
        lengths = pa.compute.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(lengths) - 1
        place = np.arange(len(raw), dtype=np.int64)
        # a character is escaped if an odd number of backslashes stands before it
        last_other = np.maximum.accumulate(np.where(raw != 92, place, -1))
        before = np.concatenate(([-1], last_other[:-1]))
        escaped = (place - 1 - before) % 2 == 1
        quotes = (raw == 34) & ~escaped
        inside = (np.cumsum(quotes, dtype=np.int64) + state) % 2 == 1  # after the character
        outside = ~inside & ~quotes
        step = np.zeros(len(raw), np.int8)
        step[outside & ((raw == 123) | (raw == 91))] = 1
        step[outside & ((raw == 125) | (raw == 93))] = -1
        depth = np.cumsum(step, dtype=np.int32)
        after, states = depth[ends], inside[ends].astype(np.int8)
        opens = np.full(len(ends), -1, np.int64)
        starts = ends - lengths + 1
        opening = np.flatnonzero(step == 1)
        for level in np.unique(after[states == OUTSIDE]):
            # the last opening from this depth is what a closing back to it ends
            here = opening[depth[opening] == level + 1]
            want = np.flatnonzero((after == level) & (states == OUTSIDE))
            k = np.searchsorted(here, ends[want]) - 1
            found = np.where(k >= 0, here[np.maximum(k, 0)] if len(here) else -1, -1)
            opens[want] = np.where(found >= starts[want], found - starts[want], -1)
        return states, after, opens


_TOLD = ("from", "to", "before", "after", "n", "open")


def _pieces(batches: Iterator[pa.RecordBatch], grammar) -> Iterator[pa.RecordBatch]:
    """Every piece with state and depth before and after it, the number of pieces up to it that end outside at its depth,
    and the start of the element it ends; all for each state its split could begin in, with depths counted from there."""
    split = None
    now: list[tuple[int, int]] = []
    counts: list[dict[int, int]] = []
    for batch in batches:
        keys = list(zip(batch.column("source_file_path").to_pylist(), batch.column("_block_start").to_pylist()))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        first = np.zeros(len(keys), bool)
        columns: list[list] = [[] for _ in range(len(_TOLD) * grammar.states)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if keys[a] != split:
                split, now, counts = keys[a], [(h, 0) for h in range(grammar.states)], [{} for _ in range(grammar.states)]
                first[a] = keys[a][1] == 0
            values = batch.column("value").slice(a, b - a)
            of = {s: grammar.segment(values, s) for s in {s for s, _ in now}}
            for h, (state, depth) in enumerate(now):
                states, gained, opens = of[state]
                after = gained + depth
                n = np.zeros(b - a, np.int64)
                for level in np.unique(after[states == OUTSIDE]):
                    here = (after == level) & (states == OUTSIDE)
                    n[here] = np.cumsum(here)[here] + counts[h].get(int(level), 0)
                    counts[h][int(level)] = int(n[here][-1])
                told = (np.concatenate(([state], states[:-1])), states, np.concatenate(([depth], after[:-1])), after, n, opens)
                for i, column in enumerate(told):
                    columns[len(_TOLD) * h + i].append(column)
                now[h] = int(states[-1]), int(after[-1])
        arrays = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns]
        names = [f"_{name}{h}" for h in range(grammar.states) for name in _TOLD]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first), *arrays], names=[*batch.schema.names, "_first", *names])


def _scan(splits: pa.Table, grammar) -> pa.Table:
    """State, depth and number of elements at the start of each split of one file, and whether its last piece has no separator."""
    rows = sorted(splits.to_pylist(), key=lambda r: r["_block_start"])
    state, depth, elements, found = OUTSIDE, 0, 0, []
    base = next(r["_base"] for r in rows if r["_base"] is not None)
    for r in rows:
        found.append([r["source_file_path"], r["_block_start"], state, depth, elements, base, None])
        elements += sum(x["n"] for x in r["_levels"] or [] if x["h"] == state and x["d"] == base - depth)
        state, depth = r[f"_to{state}"], depth + r[f"_after{state}"]
    length = sum(r["_bytes"] + r["_pieces"] * len(grammar.sep) for r in rows)
    size = rows[-1]["file_size_bytes"]
    # of a compressed file the size does not tell: then a separator at the end is one that closes what is open
    bare = length - len(grammar.sep) == size or (length != size and (state != OUTSIDE or depth < 0 or rows[-1]["_blank"]))
    if bare:
        found[-1][-1] = rows[-1]["_last_line"]
    names = ["source_file_path", "_block_start", "_state", "_depth", "_earlier", "_base", "_bare_line"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)


def _opened(grammar):
    """Where the last element that a text ends begins; the text begins outside."""

    @F.arrow_udf("long")
    def opened(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else int(grammar.segment(pa.array([t]), OUTSIDE)[2][0]) for t in texts.to_pylist()], pa.int64())

    return opened


def _cut(grammar, start: Column, length: Column) -> Column:
    """Part of ``value``; places are characters in XML and bytes in JSON."""
    if isinstance(grammar, Json):
        return F.substring(F.col("value").cast("binary"), start, length).cast("string")
    return F.substring("value", start, length)


def _placed(lines: DataFrame, grammar, base: Column) -> DataFrame:
    """Pieces with true states and depths: ``_begins`` between elements, ``_ends`` an element, whose ``number`` in the file it is."""
    shape = StructType([*lines.schema.fields, StructField("_first", BooleanType()), *[StructField(f"_{n}{h}", LongType()) for h in range(grammar.states) for n in _TOLD]])
    # one scan, written once: what follows reads this table, so other splits of a second scan cannot disagree with it
    read = materialize(lines.mapInArrow(lambda b: _pieces(b, grammar), shape), "pieces")
    key, states = ["source_file_path", "_block_start"], range(grammar.states)
    ends = read.groupBy(*key).agg(
        *[F.max_by(f"_{n}{h}", "_line").alias(f"_{n}{h}") for h in states for n in ("to", "after")],
        F.sum("_octets").alias("_bytes"), F.count(F.lit(1)).alias("_pieces"), F.max("_line").alias("_last_line"),
        F.max_by(F.trim("value") == "", "_line").alias("_blank"), F.max("file_size_bytes").alias("file_size_bytes"), F.max(F.when(F.col("_first"), base)).alias("_base"),
    )
    outside = [F.when(F.col(f"_to{h}") == OUTSIDE, F.struct(F.lit(h).alias("h"), F.col(f"_after{h}").alias("d"), F.col(f"_n{h}").alias("n"))) for h in states]
    levels = read.select(*key, F.explode(F.array(*outside)).alias("l")).filter("l IS NOT NULL").groupBy(*key, F.col("l.h").alias("h"), F.col("l.d").alias("d"))
    levels = levels.agg(F.max("l.n").alias("n")).groupBy(*key).agg(F.collect_list(F.struct("h", "d", "n")).alias("_levels"))
    # a row per split; the splits of one file meet in one task
    splits = ends.join(levels, key, "left").groupBy("source_file_path").applyInArrow(
        lambda t: _scan(t, grammar), "source_file_path string, _block_start long, _state int, _depth long, _earlier long, _base int, _bare_line long"
    )
    known = materialize(splits, "piece-splits")
    of = lambda n: F.coalesce(*[F.when(F.col("_state") == h, F.col(f"_{n}{h}")) for h in states])
    told = read.join(known, key).withColumns({n: of(n) for n in _TOLD}).withColumn("_bare", F.coalesce(F.col("_line") == F.col("_bare_line"), F.lit(False)))
    at = lambda n: F.col("_depth") + F.col(n)
    begins = F.col("_first") | ((F.col("from") == OUTSIDE) & (at("before") == F.col("_base")))
    ended = (F.col("to") == OUTSIDE) & (at("after") == F.col("_base")) & ~F.col("_bare")
    return told.select(
        *[c for c in lines.columns if c != "_octets"], begins.alias("_begins"), ended.alias("_ends"), "_bare", F.when(ended, F.col("_earlier") + F.col("n")).alias("number"), F.col("open").alias("_open"),
    )


def split_elements(lines: DataFrame, grammar, base: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(elements, skeleton, files)`` of text pieces with file metadata (``value`` without its separator).

    ``elements``: ``text`` and ``number`` (from 1, among the elements of the file that end at depth ``base``).
    ``skeleton``: parts of files outside of elements in the order of ``_block_start`` and ``_line``, with the
    ``number`` of the element that follows (null: none); a null ``text`` stands for a part too long to be
    put together. ``base`` is evaluated on the first piece of a file. Empty files have no piece and no row.
    """
    lines = lines.withColumns({"_octets": F.octet_length("value"), "value": F.make_valid_utf8("value"), "_line": F.monotonically_increasing_id()})
    told = _placed(lines, grammar, base)
    files = told.groupBy("source_file_path").agg(F.max("source_file_name").alias("source_file_name"), F.max("file_size_bytes").alias("file_size_bytes"))
    whole = F.col("_begins") & F.col("_ends") & (F.col("_open") >= 0)
    end, place = F.lit(grammar.sep), ["source_file_path", "_block_start", "_line"]

    # the others go from a piece that begins between elements to the next that ends one, or to the end of the file
    rest = told.filter(~whole)
    run = F.sum(F.col("_begins").cast("int")).over(W.partitionBy("source_file_path").orderBy("_block_start", "_line"))
    runs = rest.select(*place, "_begins", F.length("value").alias("_size")).withColumn("_run", run)
    short = runs.groupBy("source_file_path", "_run").agg((F.sum(F.col("_size") + len(grammar.sep)) <= LONGEST_RECORD).alias("_short"))
    # a row per run, and one per piece: at rest they take a few bytes each, but broadcast they would be objects on the driver
    runs = materialize(runs.join(short.hint("merge"), ["source_file_path", "_run"]).select(*place, "_run", "_short"), "runs")
    rest = rest.join(runs.hint("merge"), place)
    line = F.struct("_block_start", "_line", "value", "number", "_ends", "_bare")
    put = rest.filter("_short").groupBy("source_file_path", "_run").agg(F.sort_array(F.collect_list(line)).alias("l"))
    first, last = F.col("l")[0], F.element_at("l", -1)
    put = put.select(
        "source_file_path", F.array_join(F.transform("l", lambda x: x["value"]), grammar.sep).alias("value"), last["number"].alias("number"), last["_ends"].alias("_ends"),
        last["_bare"].alias("_bare"), first["_block_start"].alias("_block_start"), first["_line"].alias("_line"),
    )
    put = materialize(put.withColumn("_open", _opened(grammar)(F.when(F.col("_ends"), F.col("value")))), "joined-pieces")

    made = told.filter(whole).select("value", "_open", "number", *place).unionByName(put.filter("_open >= 0").select("value", "_open", "number", *place))
    opened = F.col("_open").cast("int")
    elements = made.select(F.concat(_cut(grammar, opened + 1, F.lit(1 << 30)), end).alias("text"), "number", "source_file_path")
    before = made.select(_cut(grammar, F.lit(1), opened).alias("text"), "number", *place)
    none = F.lit(None).cast("bigint").alias("number")
    tails = put.filter("coalesce(_open, -1) < 0").select(F.concat("value", F.when(F.col("_bare"), "").otherwise(end)).alias("text"), none, *place)
    lost = rest.filter("NOT _short").groupBy("source_file_path").agg(F.min("_block_start").alias("_block_start"), F.min("_line").alias("_line"))
    skeleton = before.unionByName(tails).unionByName(lost.select(F.lit(None).cast("string").alias("text"), none, *place))
    return elements, skeleton, files


def arrange(elements: DataFrame, skeleton: DataFrame, files: DataFrame, between: str, stand_in, listed, valid: Column) -> tuple[DataFrame, DataFrame]:
    """``(elements, documents)``: ``text`` and ``element_index`` of all elements of well-formed files, and every file with ``well_formed``.

    A file's skeleton is put together with stand-ins for elements; of elements that only ``between`` (a
    pattern) separates from the one before, the first stands for all. ``stand_in(k)`` makes the k-th; ``listed(skeleton)``
    adds ``_ok`` and ``_list``, an array of ``(k, text)`` with k null for an element that the pieces did not show.
    ``valid`` is the verdict on an element's ``text``.
    """
    file = "source_file_path"
    elements = materialize(elements.withColumn("_valid", valid), "elements")
    parts = skeleton.filter(F.col("text").isNull() | (F.col("number").isNull()) | (F.col("number") == 1) | ~F.col("text").rlike(between))
    size = F.sum(F.length("text") + 1)
    short = parts.groupBy(file).agg((F.bool_and(F.col("text").isNotNull()) & (size <= LONGEST_RECORD)).alias("_short"), F.count(F.lit(1)).alias("_parts"))
    parts = materialize(parts.join(short, file).withColumn("text", F.when(F.col("_short"), F.col("text"))), "skeleton")
    put = parts.filter("_short").groupBy(file).agg(F.sort_array(F.collect_list(F.struct("_block_start", "_line", "text", "number"))).alias("p"))
    put = put.withColumn("numbers", F.filter(F.transform("p", lambda x: x["number"]), lambda x: x.isNotNull()))
    # the k-th part with an element is followed by the k-th stand-in
    fold = F.aggregate("p", F.struct(F.lit(0).alias("k"), F.array().cast("array<string>").alias("s")), lambda a, x: F.struct(
        (a["k"] + F.when(x["number"].isNotNull(), 1).otherwise(0)).alias("k"),
        F.concat(a["s"], F.array(F.concat(x["text"], F.when(x["number"].isNotNull(), stand_in(a["k"])).otherwise("")))).alias("s"),
    ))
    put = materialize(listed(put.select(file, "numbers", F.array_join(fold["s"], "").alias("skeleton"))).drop("skeleton"), "listed")
    broken = elements.filter("NOT _valid").select(file).distinct().withColumn("_broken", F.lit(True))
    verdict = short.select(file).join(put.select(file, "_ok"), file, "left").join(broken, file, "left")
    verdict = materialize(verdict.select(file, (F.coalesce("_ok", F.lit(False)) & F.col("_broken").isNull()).alias("well_formed")), "verdicts")

    totals = elements.groupBy(F.col(file).alias("f")).agg(F.max("number").alias("total"))
    seen = put.filter("_ok").select(file, "numbers", F.posexplode("_list").alias("pos", "x")).join(totals, F.col(file) == F.col("f"), "left").drop("f")
    number = lambda k: F.get("numbers", k)
    seen = seen.select(
        file, "pos", F.col("x.k").alias("k"), F.col("x.text").alias("text"), number(F.col("x.k")).alias("first"),
        F.when(F.col("x.k").isNotNull(), F.coalesce(number(F.col("x.k") + 1), F.col("total") + 1)).alias("next"),
    )
    # elements left out of the skeleton before a stand-in, of which those before the first of this list are others'
    left_out = seen.withColumn("skipped", F.col("first") - 1 - F.col("k"))
    along = W.partitionBy(file).orderBy("pos")
    left_out = left_out.withColumn("skipped", F.col("skipped") - F.first("skipped", ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    before = F.last(F.col("skipped") + F.col("next") - F.col("first") - 1, ignorenulls=True).over(along.rowsBetween(W.unboundedPreceding, -1))
    left_out = materialize(left_out.withColumn("at", F.col("pos") + F.coalesce("skipped", before, F.lit(0))), "ranges")
    good = verdict.filter("well_formed").select(file)
    ranges = left_out.filter("k IS NOT NULL").join(good, file).select(F.col(file).alias("f"), "first", "next", "at")
    inside = (F.col(file) == F.col("f")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("next"))
    index = (F.col("at") + F.col("number") - F.col("first")).cast("int").alias("element_index")
    found = elements.join(ranges, inside).select(file, index, "text")
    # elements that only the skeleton shows
    extra = left_out.filter("k IS NULL").join(good, file).select(file, F.col("at").cast("int").alias("element_index"), "text")
    return found.unionByName(extra), materialize(files.join(verdict, file, "left").fillna({"well_formed": False}), "documents")


def xml_elements(lines: DataFrame, fragments: bool, wrap, check) -> tuple[DataFrame, DataFrame]:
    """``<Transaction>`` elements of XML documents, or of text files that hold root-less XML (``fragments``).

    ``wrap(text)`` makes a document of a text file's text; ``check(column, schema)`` parses with the readers' options.
    """
    elements, skeleton, files = split_elements(lines, Xml(), F.lit(0 if fragments else 1))

    @F.arrow_udf("array<struct<k:int,text:string>>")
    def children(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("k", pa.int32()), ("text", pa.string())]))
        return pa.array([None if t is None else Xml().children(t) for t in texts.to_pylist()], kind)

    def listed(df: DataFrame) -> DataFrame:
        whole = wrap(F.col("skeleton")) if fragments else F.col("skeleton")
        ok = check(whole, f"Transaction array<string>, {CORRUPT} string")[CORRUPT].isNull()
        return df.withColumns({"_ok": ok, "_list": children(whole)})

    stand_in = lambda k: F.concat(F.lit(f'<Transaction {STAND_IN}="'), k.cast("string"), F.lit('"/>'))
    valid = check(F.col("text"), f"TransactionID string, {CORRUPT} string")[CORRUPT].isNull()
    return arrange(elements, skeleton, files, r"^\s*$", stand_in, listed, valid)


def json_elements(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Elements of documents whose root is an array, or an object with an array ``transactions``; ``text`` is their JSON."""
    base = F.when(F.ltrim("value").startswith("["), 1).otherwise(2)
    elements, skeleton, files = split_elements(lines, Json(), base)
    name = "\x00stand-in"

    def listed(df: DataFrame) -> DataFrame:
        root = F.try_parse_json("skeleton")
        rows = F.coalesce(F.try_variant_get(root, "$.transactions", "array<variant>"), F.try_variant_get(root, "$", "array<variant>"))
        pairs = F.transform(rows, lambda v: F.struct(F.try_variant_get(v, f"$['{name}']", "int").alias("k"), F.to_json(v).alias("text")))
        return df.withColumns({"_ok": root.isNotNull(), "_list": pairs})

    stand_in = lambda k: F.concat(F.lit('{"\\u0000stand-in":'), k.cast("string"), F.lit("}"))
    return arrange(elements, skeleton, files, r"^\s*,\s*$", stand_in, listed, F.try_parse_json("text").isNotNull())
