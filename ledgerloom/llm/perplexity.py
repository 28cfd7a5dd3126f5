"""Quality rules with the perplexity of an n-gram model that the corpus itself gives.

The model is a modified Kneser-Ney model of the characters of words, one for each
language, of order five: a word is predicted character by character and then its
end, from the four characters before, with four marks before its first. Counts are
taken over every word of every document, so the model grows with the corpus.

1. One scan cuts the documents into blocks of one language and about two million
   words: for each document its figures and the words it holds (as places in the
   block's vocabulary), compressed. This table is all that later steps read.
2. Blocks count their distinct n-grams; Spark adds them up. Counts of lower orders
   are the numbers of distinct left extensions. Discounts, contexts and the
   interpolated probabilities are joins over the distinct n-grams.
3. The probabilities are stored as arrays sorted by 64-bit hash, in shards of
   bounded size by leading bits. Blocks send the sorted hashes of their n-grams to
   the shards and get back the logarithms; no task holds the model.
4. A language's bands lie around the median of its documents' perplexity.

Logarithms are whole numbers of 2^-24, so sums do not depend on blocks or order.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, LongType, StringType, StructField, StructType

from . import textkit
from .common import Scratch, small

ORDER = 5
# words of a block; documents taken into blocks at once; n-grams of a shard of the model, about
BLOCK_WORDS, ROWS, SHARD = 2 << 20, 1000, 1 << 12
FRACTION = 1 << 24
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
# a band reaches this many median deviations of its side, at least LEAST nats per character, from the median;
# deviations of short texts count by the square root of n / (n + STEADY) words
REACH, LEAST, STEADY = 5.0, 0.05, 200
# bins of a nat in which medians are taken
BINS = 4096

# fixed values: the characters counted as symbols
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACES = b" \t\n\r\x0b\x0c"
_STEP = np.uint64(0x9E3779B97F4A7C15)
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _sums(per_item: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over the items of [bounds[i], bounds[i + 1])."""
    total = np.concatenate(([0], np.cumsum(per_item, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]
    return len(lines) - len(set(lines))


def _repeated_words(hashes: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text in windows of five words that the text holds twice or more."""
    last = max(0, len(hashes) - WINDOW + 1)
    at = np.flatnonzero(doc[:last] == doc[len(doc) - last :])
    if not len(at):
        return np.zeros(len(bounds) - 1, np.int64)
    window = np.zeros(last, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WINDOW):
            window = textkit.mix(window * _STEP + hashes[i : last + i])
    order = at[np.lexsort((window[at], doc[at]))]
    same = (window[order][1:] == window[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    found = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    edges = np.bincount(found, minlength=len(hashes) + 1) - np.bincount(found + WINDOW, minlength=len(hashes) + 1)
    return _sums(np.cumsum(edges)[: len(hashes)] > 0, bounds)


def _squeeze(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte, compressed."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unsqueeze(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


class _Block:
    """Documents of one language on their way into one row."""

    def __init__(self, lang: str):
        self.lang, self.ids, self.parts, self.n_docs, self.n_words = lang, [], [], 0, 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        for first, part in textkit.pieces(texts):
            words = textkit.Words(part, lower=False)
            hashes, bounds = words.hashes(), words.bounds
            n = np.diff(bounds)
            doc = np.repeat(np.arange(len(n)), n)
            letters = words.offsets[bounds]
            lines = [_repeated_lines(t) if t else 0 for t in part.cast(pa.large_binary()).to_pylist()]
            with np.errstate(over="ignore"):
                told = textkit.mix(hashes + (np.arange(len(hashes)) - bounds[:-1][doc]).astype(np.uint64) * _STEP)
                told = np.concatenate((np.zeros(1, np.uint64), np.cumsum(told, dtype=np.uint64)))
                told = (told[bounds[1:]] - told[bounds[:-1]]).view(np.int64)
            figures = [n, _sums((words.bytes & 0xC0) != 0x80, letters), _sums(_SYMBOL[words.bytes], letters), np.array(lines), _repeated_words(hashes, doc, bounds)]
            # distinct words of each document, and those of all with their bytes
            order = np.lexsort((hashes, doc))
            new = np.concatenate(([True], (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])))[: len(order)]
            starts = np.flatnonzero(new)
            pairs = order[starts]
            times = np.diff(np.concatenate((starts, [len(order)])))
            known, where = np.unique(hashes, return_index=True)
            spelled = words.arrow().cast(pa.large_binary()).take(pa.array(where))
            self.parts.append((figures, told, (self.n_docs + doc[pairs]).astype(np.int32), hashes[pairs], times.astype(np.int32), known, spelled))
            self.ids.append(ids.slice(first, len(part)))
            self.n_docs, self.n_words = self.n_docs + len(part), self.n_words + len(hashes)

    def row(self, shape: pa.Schema) -> pa.RecordBatch:
        figures = [np.concatenate([p[0][i] for p in self.parts]) for i in range(len(FIGURES))]
        told = np.concatenate([p[1] for p in self.parts])
        doc, word, times, known = (np.concatenate([p[i] for p in self.parts]) for i in (2, 3, 4, 5))
        spelled = pa.concat_arrays([p[6] for p in self.parts])
        self.parts.clear()
        distinct, where = np.unique(known, return_index=True)
        place = np.searchsorted(distinct, word)
        # frequent words get small numbers
        by_count = np.argsort(-np.bincount(place, times, minlength=len(distinct)), kind="stable")
        rank = np.empty(len(distinct), np.int64)
        rank[by_count] = np.arange(len(distinct))
        place = rank[place]
        order = np.lexsort((place, doc))
        place, doc, times = place[order], doc[order], times[order]
        step = np.diff(place, prepend=0)
        first = np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)]
        step[first] = place[first]
        vocabulary = b"\n".join(spelled.take(pa.array(where[by_count])).to_pylist())
        ids = pa.concat_arrays(self.ids)
        one = lambda values: pa.array([values])
        columns = [
            pa.array([uuid.uuid4().hex]), pa.array([self.lang]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(told), *map(one, figures),
            one(np.bincount(doc, minlength=self.n_docs)), pa.array([_squeeze(step)]), pa.array([_squeeze(times)]),
            pa.array([pa.compress(vocabulary, "zstd", asbytes=True)]), pa.array([len(vocabulary)]),
        ]
        return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, shape.types)], schema=shape)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_shape``: blocks of one language each."""
    open_: dict[str, _Block] = {}
    shape = None
    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        ids, langs, texts = batch.columns
        shape = shape or _arrow_shape(ids.type)
        for lang in langs.unique().to_pylist():
            rows = pa.array(np.flatnonzero([x == lang for x in langs.to_pylist()]))
            block = open_.setdefault(lang, _Block(lang))
            block.add(ids.take(rows), texts.take(rows).cast(pa.large_string()))
        if sum(b.n_words for b in open_.values()) >= BLOCK_WORDS:
            for lang in [x for x, b in open_.items() if b.n_words >= BLOCK_WORDS // 4]:
                yield open_.pop(lang).row(shape)
    for block in open_.values():
        yield block.row(shape)


def _arrow_shape(id_type: pa.DataType) -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([
        ("block", pa.string()), ("lang", pa.string()), ("ids", pa.list_(id_type)), ("told", longs), *[(f, longs) for f in FIGURES], ("n_pairs", longs),
        ("steps", pa.binary()), ("times", pa.binary()), ("vocabulary", pa.binary()), ("vocabulary_bytes", pa.int64()),
    ])


def _shape(id_type: DataType) -> StructType:
    longs = ArrayType(LongType())
    return StructType([
        StructField("block", StringType()), StructField("lang", StringType()), StructField("ids", ArrayType(id_type)), StructField("told", longs),
        *[StructField(f, longs) for f in FIGURES], StructField("n_pairs", longs), StructField("steps", BinaryType()), StructField("times", BinaryType()),
        StructField("vocabulary", BinaryType()), StructField("vocabulary_bytes", LongType()),
    ])


class _Read:
    """A block's row read back: which document holds which word how often, and the n-grams of its words."""

    def __init__(self, row: dict):
        n_pairs = np.array(row["n_pairs"], np.int64)
        n = int(n_pairs.sum())
        step, self.times = _unsqueeze(row["steps"], n), _unsqueeze(row["times"], n)
        self.n_docs, self.doc = len(n_pairs), np.repeat(np.arange(len(n_pairs)), n_pairs)
        starts = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
        run = np.cumsum(step)
        self.word = run - np.repeat((run - step)[starts], n_pairs[n_pairs > 0])
        vocabulary = pa.decompress(row["vocabulary"], row["vocabulary_bytes"], "zstd", asbytes=True)
        # white space is no part of a word: four spaces open one, a line feed ends it
        marked = (b" " * (ORDER - 1) + vocabulary.replace(b"\n", b"\n" + b" " * (ORDER - 1)) + b"\n") if n else b""
        del vocabulary
        self.points = np.frombuffer(marked.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        del marked
        self.ends = np.flatnonzero(self.points != 32).astype(np.int32)
        self.word_starts = np.concatenate(([0], np.flatnonzero(self.points[self.ends] == 10)[:-1] + 1)) if n else np.empty(0, np.int64)
        key = int.from_bytes(hashlib.blake2b(row["lang"].encode(), digest_size=8).digest(), "little")
        hashes = np.full(len(self.ends), key, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(ORDER):
                hashes = textkit.mix(hashes * _STEP + self.points[self.ends - (ORDER - 1) + i])
        # distinct hashes in order, a place of each, and the number of each predicted character's n-gram
        order = np.argsort(hashes, kind="stable").astype(np.int32)
        hashes = hashes[order]
        first = np.concatenate(([True], hashes[1:] != hashes[:-1]))[: len(hashes)]
        self.hashes, self.places = hashes[first], order[first]
        self.gram = np.empty(len(order), np.int32)
        self.gram[order] = np.cumsum(first, dtype=np.int32) - 1

    def counts(self) -> np.ndarray:
        """How often the block's documents hold each n-gram."""
        of_word = np.zeros(len(self.word_starts), np.int64)
        np.add.at(of_word, self.word, self.times)
        lengths = np.diff(np.concatenate((self.word_starts, [len(self.ends)])))
        found = np.zeros(len(self.hashes), np.int64)
        np.add.at(found, self.gram, np.repeat(of_word, lengths))
        return found

    def spelled(self) -> list[str]:
        at = self.ends[self.places][:, None] + np.arange(1 - ORDER, 1)
        text = self.points[at].astype("<u4").tobytes().decode("utf-32-le")
        return [text[i : i + ORDER] for i in range(0, len(text), ORDER)]

    def totals(self, logs: np.ndarray) -> np.ndarray:
        """The logarithms of all characters of each document, summed."""
        found = np.zeros(self.n_docs, np.int64)
        if len(self.word_starts):
            np.add.at(found, self.doc, self.times * np.add.reduceat(logs[self.gram], self.word_starts)[self.word])
        return found


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, gram, hash, n)`` of all blocks of a task, each distinct n-gram once for every few blocks."""
    kept: dict[str, list] = {}

    def merged(lang: str) -> pa.RecordBatch:
        hashes, counts = (np.concatenate([x[i] for x in kept[lang]]) for i in (0, 1))
        spelled = [g for x in kept[lang] for g in x[2]]
        distinct, where, number = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, number, counts)
        grams = [spelled[i] for i in where]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams, pa.string()), pa.array(distinct.view(np.int64)), pa.array(total)], names=["lang", "gram", "hash", "n"])

    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("lang", "n_pairs", "steps", "times", "vocabulary", "vocabulary_bytes")}
            block = _Read(row)
            kept.setdefault(row["lang"], []).append((block.hashes, block.counts(), block.spelled()))
            if sum(len(x[0]) for x in kept[row["lang"]]) > 4 << 20:
                yield merged(row["lang"])
                del kept[row["lang"]]
    for lang in kept:
        yield merged(lang)


def _requests(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """``(shard, block, hashes)``: each block's sorted hashes, cut by their leading bits."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("block", "lang", "n_pairs", "steps", "times", "vocabulary", "vocabulary_bytes")}
            hashes = _Read(row).hashes
            shard = _shard(hashes, bits)
            some, starts = np.unique(shard, return_index=True)
            pieces = np.split(hashes, starts[1:]) if len(hashes) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int64)), pa.array([row["block"]] * len(some), pa.string()), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["shard", "block", "hashes"]
            )


def _shard(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logarithms for each request; a shard's array comes before its requests and is the only one held."""
    known = logs = None
    for batch in batches:
        shards, blocks, replies = [], [], []
        for shard, block, data, log in zip(*(c.to_pylist() for c in batch.columns)):
            if block is None:
                known, logs = np.frombuffer(data, np.uint64), np.frombuffer(log, np.int32)
            else:
                shards.append(shard)
                blocks.append(block)
                replies.append(logs[np.searchsorted(known, np.frombuffer(data, np.uint64))].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(blocks, pa.string()), pa.array(replies, pa.binary())], names=["shard", "block", "logs"])


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(doc_id, lang, told, figures, log)`` of each document; a block comes before its replies, which come in order."""
    row, logs = None, []

    def scored() -> pa.RecordBatch:
        total = _Read({c: row[c][0].as_py() for c in ("lang", "n_pairs", "steps", "times", "vocabulary", "vocabulary_bytes")}).totals(
            np.frombuffer(b"".join(logs), np.int32).astype(np.int64)
        )
        flat = [row[c].combine_chunks().flatten() if isinstance(row[c], pa.ChunkedArray) else row[c].flatten() for c in ("ids", "told", *FIGURES)]
        lang = pa.array([row["lang"][0].as_py()] * len(total), pa.string())
        return pa.RecordBatch.from_arrays([flat[0], lang, *flat[1:], pa.array(total)], names=["doc_id", "lang", "told", *FIGURES, "log"])

    for batch in batches:
        shard = batch.column("shard").to_pylist()
        for i in range(batch.num_rows):
            if shard[i] is None:
                if row is not None:
                    yield scored()
                row, logs = {c: batch.column(c).slice(i, 1) for c in batch.schema.names if c != "logs"}, []
            else:
                logs.append(batch.column("logs")[i].as_py())
    if row is not None:
        yield scored()


def _model(grams: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """``(hash, log)`` of every distinct n-gram and their number: interpolated modified Kneser-Ney."""
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.max("hash").alias("hash"))
    grams, seen = scratch.save_counted(grams, "order-5")
    orders = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):
        # an n-gram's count below the highest order is its number of distinct left extensions
        shorter = orders[k + 1].groupBy("lang", F.substr("gram", F.lit(2)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        orders[k] = scratch.save(shorter, f"order-{k}")
    below = None
    for k in range(1, ORDER + 1):
        below = _probabilities(orders[k], below, k, scratch)
    log = F.round(F.greatest(F.log("p"), F.lit(-127.0)) * FRACTION).cast("int")
    return below.join(grams.select("lang", "gram", "hash"), ["lang", "gram"]).select("hash", log.alias("log")), seen["n"]


def _discounts(counted: DataFrame) -> DataFrame:
    """``(lang, d1, d2, d3, symbols)``: what counts of one, two, and three or more give away; ``symbols`` n-grams."""
    n = {i: F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)}
    found = counted.groupBy("lang").agg(*n.values(), F.count(F.lit(1)).alias("symbols"))
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1))

    def discount(i: int):
        raw = i - (i + 1) * y * F.col(f"n{i + 1}") / F.greatest(F.col(f"n{i}"), F.lit(1))
        return F.when(F.col(f"n{i}") > 0, F.greatest(F.lit(0.0), F.least(F.lit(float(i)), raw))).otherwise(0.0).alias(f"d{i}")

    return found.select("lang", *[discount(i) for i in (1, 2, 3)], "symbols")


def _probabilities(counted: DataFrame, below: DataFrame | None, k: int, scratch: Scratch) -> DataFrame:
    """``(lang, gram, p)`` of one order: discounted counts plus what the context gives away times the order below."""
    found, seen = scratch.save_counted(_discounts(counted), f"discounts-{k}")
    context = F.substr("gram", F.lit(1), F.lit(k - 1))
    rows = counted.select("lang", "gram", "n", context.alias("context"))
    of = [F.count_if(F.col("n") == 1).alias("c1"), F.count_if(F.col("n") == 2).alias("c2"), F.count_if(F.col("n") > 2).alias("c3")]
    contexts = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), *of)
    rows = rows.join(contexts, ["lang", "context"]).join(small(found, seen["n"], 64), "lang")
    if below is None:
        rows = rows.withColumn("below", 1 / F.col("symbols"))
    else:
        rows = rows.withColumn("suffix", F.substr("gram", F.lit(2)))
        rows = rows.join(below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below")), ["lang", "suffix"])
    taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    given = F.col("d1") * F.col("c1") + F.col("d2") * F.col("c2") + F.col("d3") * F.col("c3")
    p = (F.greatest(F.col("n") - taken, F.lit(0.0)) + given * F.col("below")) / F.col("total")
    return rows.select("lang", "gram", p.alias("p"))


def score_perplexity(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, lang, told, n_words, ..., log)`` per document: its figures, and its logarithm in 2^-24 nats.

    ``log`` is summed over the characters of all words and the ends of words, so the
    perplexity per character is ``exp(-log / 2^24 / (word_chars + n_words))``.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text")
    shape = _shape(texts.schema["doc_id"].dataType)
    blocks = scratch.save(texts.mapInArrow(_blocks, shape), "blocks")
    wordy = blocks.select("block", "lang", "n_pairs", "steps", "times", "vocabulary", "vocabulary_bytes")
    counted = wordy.mapInArrow(_grams, "lang string, gram string, hash long, n long")
    model, n = _model(counted, scratch)
    bits = max(0, n // SHARD).bit_length()
    shard = F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("bigint")
    # hashes in unsigned order; a shard holds about SHARD of them whatever the corpus
    pair = F.struct((F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))).alias("order"), "hash", "log")
    arrays = model.groupBy(shard.alias("shard")).agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
    arrays = arrays.select("shard", F.col("pairs.hash").alias("hashes"), F.col("pairs.log").alias("logs"))
    arrays = scratch.save(arrays.mapInArrow(_packed, "shard long, block string, hashes binary, logs binary"), "model")
    asked = wordy.mapInArrow(lambda b: _requests(b, bits), "shard long, block string, hashes binary")
    dealt = arrays.union(asked.withColumn("logs", F.lit(None).cast("binary"))).repartition("shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
    answered = dealt.mapInArrow(_replies, "shard long, block string, logs binary")
    met = blocks.withColumn("shard", F.lit(None).cast("bigint")).unionByName(answered, allowMissingColumns=True)
    met = met.repartition("block").sortWithinPartitions("block", F.col("shard").asc_nulls_first())
    out = StructType([StructField("doc_id", texts.schema["doc_id"].dataType), StructField("lang", StringType()), *[StructField(f, LongType()) for f in ("told", *FIGURES, "log")]])
    return met.mapInArrow(_scores, out)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model's arrays as bytes."""
    for batch in batches:
        data = [[np.array(x, kind).tobytes() for x in batch.column(c).to_pylist()] for c, kind in (("hashes", np.int64), ("logs", np.int32))]
        none = pa.array([None] * batch.num_rows, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("shard"), none, pa.array(data[0], pa.binary()), pa.array(data[1], pa.binary())], names=["shard", "block", "hashes", "logs"])


def _medians(values: DataFrame, names: list[str], scratch: Scratch, label: str) -> DataFrame:
    """The median of each column by language, in bins of 1 / BINS; the bins of a language are what meets in one task."""
    binned = None
    for name in names:
        one = values.filter(F.col(name).isNotNull()).groupBy("lang", F.floor(F.col(name) * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        one = one.groupBy(F.col("lang").alias("of")).agg(((F.percentile("bin", 0.5, F.col("n")) + 0.5) / BINS).alias(f"median_{name}"))
        binned = one if binned is None else binned.join(one, "of", "full")
    found, seen = scratch.save_counted(binned, label)
    return small(found, seen["n"], 64)


def rate_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, perplexity)``, one row per document.

    A document fails the base rules with under ten words, or with over 20 % of its
    words in repeated five-word windows. Of the others those are kept whose
    perplexity lies within the bands of their language: five times the median
    deviation of the side (at least 0.05 nats a character) around the median, where
    the deviations of short texts count less. Equal texts count once in the medians,
    so a large group of copies does not set the bands; every document that passes
    the base rules takes part.

    A null text has no words; a null language is the empty one; text without words
    has no perplexity (null) and fails. Repeated rows are rows each; a null id stays;
    other columns are ignored; an empty table gives no rows. Invalid UTF-8 counts as
    replacement characters in the model.
    """
    scratch = Scratch(docs.sparkSession, "perplexity")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    nats = -F.col("log") / FRACTION / (F.col("word_chars") + F.col("n_words"))
    scored = score_perplexity(docs, scratch, id_col).withColumn("base_failed", failed).withColumn("nats", F.when(F.col("n_words") > 0, nats))
    scored = scratch.save(scored.drop("log"), "scored")
    heard = scored.filter("NOT base_failed").select("lang", "told", "n_words", "nats").distinct()
    centre = _medians(heard, ["nats"], scratch, "centre")
    off = (F.col("nats") - F.col("median_nats")) * F.sqrt(F.col("n_words") / (F.col("n_words") + STEADY))
    sides = heard.join(centre, F.col("lang") == F.col("of")).withColumn("off", off)
    sides = sides.select("lang", F.when(F.col("off") >= 0, F.col("off")).alias("high"), F.when(F.col("off") < 0, -F.col("off")).alias("low"))
    reach = _medians(sides, ["high", "low"], scratch, "reach")
    bands = scored.join(centre, F.col("lang") == F.col("of"), "left").drop("of").withColumn("off", off)
    bands = bands.join(reach, F.col("lang") == F.col("of"), "left")
    limit = lambda side: F.greatest(F.lit(LEAST), REACH * F.coalesce(f"median_{side}", F.lit(0.0)))
    within = (F.col("off") <= limit("high")) & (-F.col("off") <= limit("low"))
    return bands.select("doc_id", *FIGURES, "base_failed", (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"), F.exp("nats").alias("perplexity"))
